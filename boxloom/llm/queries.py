"""One query per operator of this folder, over whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxloom.llm import (
    bloom_lm,
    contamination,
    hard_negatives,
    jaccard_join,
    license_rules,
    line_runs,
    link_trust,
    multi_index,
    packing,
    page_text,
    piece_codec,
    quality,
    spelling,
)
from boxloom.llm.sqltext import ORACLES as ORACLES

QUERIES = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_link_trust(spark, folder):
    return link_trust.judge(table(spark, folder, "pages"))


@query
def op2_multi_index(spark, folder):
    return multi_index.near_duplicates(table(spark, folder, "embeddings"))


@query
def op3_jaccard_join(spark, folder):
    return jaccard_join.join(table(spark, folder, "documents"))


@query
def op4_line_runs(spark, folder):
    out = line_runs.dedup_lines(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_deleted", "text")


@query
def op5_license_rules(spark, folder):
    return license_rules.scan(table(spark, folder, "documents")).drop("spans")


@query
def op6_packing(spark, folder):
    return packing.pack(packing.pieces(table(spark, folder, "documents")))


@query
def op7_page_text(spark, folder):
    return page_text.extract(table(spark, folder, "pages"))


@query
def op8_quality(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    weights = quality.fit(docs, labels.where(~quality.held_out("doc_id")))
    return quality.score(docs, weights).select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op9_contamination(spark, folder):
    return contamination.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_bloom_lm(spark, folder):
    return bloom_lm.score(table(spark, folder, "documents"))


@query
def op11_hard_negatives(spark, folder):
    return hard_negatives.mine(table(spark, folder, "embeddings"))


@query
def op12_spelling(spark, folder):
    return spelling.group(table(spark, folder, "documents"))


@query
def op13_piece_codec(spark, folder):
    return piece_codec.digests(table(spark, folder, "documents"))
