"""Streaming: intentionally empty.

nothing is built here. Every check in this package is a batch DataFrame plan and can be
run per micro-batch from a caller's own ``foreachBatch`` if that is ever wanted.
"""
