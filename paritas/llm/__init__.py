"""Operators of a training-data pipeline, each a Spark job over whole tables.

sharding · decontamination · neighbours · chat · packing · html_template ·
ngram_join · line_quality · url_reputation · token_files; queries.py registers one query
per operator and oracle.py holds the SQL of those that SQL can express. Nothing outside
this package imports it.
"""
