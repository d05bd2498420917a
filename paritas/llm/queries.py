"""One registered query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.llm import alignment, chat, decontamination, html_template, licences, line_quality, neighbours, ngram_join, packing, repair, sharding, token_files, url_reputation
from paritas.llm.common import read, scratch
from paritas.llm.tokens import default_piece_vocabulary, default_vocabulary

SHARDS = {f"shard-{k:03d}": 1 + (k % 8 == 0) for k in range(96)}  # every eighth has twice the room
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
QUALITY_BOUND = 0.7


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return sharding.place(docs, "doc_id", SHARDS).select("doc_id", "source", "slot", "shard")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.format_log(chat.log_of(turns)))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(read(spark, sf_dir, "documents"), default_vocabulary())
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op6_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(read(spark, sf_dir, "pages"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, documents = ngram_join.join(read(spark, sf_dir, "documents"), words=3, percent=90)
    return documents.select("doc_id", "n_shingles", "component_id")


def learnable(labels: DataFrame) -> DataFrame:
    """``doc_id, label`` of the quality labels that are not held out."""
    return labels.select("doc_id", F.col("quality").alias("label")).filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    field = line_quality.train(docs, learnable(read(spark, sf_dir, "labels")))
    return line_quality.score(docs, field, ["doc_id"]).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "score", (F.col("score") >= QUALITY_BOUND).cast("int").alias("predicted"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, bad`` of the pages whose path names a labelled document (``/language/doc_id``)."""
    named = pages.select(url_reputation.host_of(F.col("url")).alias("host"),
                         F.regexp_extract(url_reputation.path_of(F.col("url")), r"^/[^/]*/(\d{1,18})", 1).try_cast("long").alias("doc_id"))
    return named.join(labels.select("doc_id", (1 - F.col("quality")).alias("bad")), "doc_id")


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = page_outcomes(pages, read(spark, sf_dir, "labels"))
    return url_reputation.judge(pages, "page_id", outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    token_files.write_tokens(read(spark, sf_dir, "documents"), path, default_vocabulary())
    return token_files.checksums(spark, path)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair(repair.damage(turns), turns.select("conv_id"))


def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read(spark, sf_dir, "documents"), default_vocabulary(), default_piece_vocabulary())


QUERIES = {
    "op1_sharding": op1_sharding, "op2_decontamination": op2_decontamination, "op3_neighbours": op3_neighbours, "op4_chat": op4_chat,
    "op5_packing": op5_packing, "op6_html_template": op6_html_template, "op7_ngram_join": op7_ngram_join, "op8_line_quality": op8_line_quality,
    "op9_url_reputation": op9_url_reputation, "op10_token_files": op10_token_files,
    "op11_conversation_repair": op11_conversation_repair, "op12_licence_scan": op12_licence_scan, "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
