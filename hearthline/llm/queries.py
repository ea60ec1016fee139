"""One query per operator over the whole given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthline.llm import decontaminate, jaccard_join, langid, license_scan, line_dedup, mixing, passages, prefix_trie
from hearthline.llm import quality, spelling, topk, url_filter, warc
from hearthline.llm.oracles import ORACLES
from hearthline.sources.stages import stage


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies; on a cluster, ``--py-files`` does."""
    root = str(Path(__file__).resolve().parents[2])
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (given, root)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, ~langid.held_out("doc_id"))
    out = quality.score(docs, model, keep=["doc_id"])
    return out.select("doc_id", langid.held_out("doc_id").alias("held_out"), "score", "predicted")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "rate", "copies", "taken")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


URL_RULES = [
    url_filter.host_rule("org", "/", "allow"),
    url_filter.host_rule("example.org", "/es/", "block"),
    url_filter.host_rule("example.org", "/en/1", "block"),
    url_filter.host_rule("com", "/fr/", "allow"),
    url_filter.host_rule("com", "/de/", "block"),
]


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"])


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = topk.top_k(vectors, F.col("vec_id") % 100 == 0, "vec_id", topk.quantised("embedding"))
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out("doc_id")))
    out = langid.identify(docs, model, keep=["doc_id"])
    return out.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.join(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    records = warc.read_records(warc.write_archives(pages))
    return records.select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"), F.col("owner").alias("other_id"), F.col("first").alias("first_word"),
        F.col("past").alias("past_word"), F.col("owner_first").alias("other_first"),
        F.col("owner_past").alias("other_past"), "similarity",
    )


HEAD_TURNS = 3  # a rebuilt conversation takes so many turns of another one at most


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = stage(prefix_trie.sequences(table(spark, sf_dir, "conversations")), "conversations")
    source = F.col("conv_id") - F.col("conv_id") % 20
    length = F.crc32(F.col("conv_id").cast("string")) % (HEAD_TURNS + 1)
    rebuilt = stage(prefix_trie.with_heads(convs, source, length, HEAD_TURNS), "rebuilt-conversations")
    return prefix_trie.trie(rebuilt)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))
    return words.select("word", "form", "root", "n", "n_near", "form_n")


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_licenses": op3_licenses,
    "op4_urls": op4_urls,
    "op5_topk": op5_topk,
    "op6_decontaminate": op6_decontaminate,
    "op7_language": op7_language,
    "op8_jaccard": op8_jaccard,
    "op9_warc": op9_warc,
    "op10_passages": op10_passages,
    "op11_trie": op11_trie,
    "op12_spelling": op12_spelling,
    "op13_lines": op13_lines,
}

__all__ = ["ORACLES", "QUERIES", "importable", "table"]
