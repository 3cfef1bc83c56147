"""From raw documents to packed sequences: quality, line dedup, near duplicates, decontamination, packing."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxloom.llm import contamination, jaccard_join, line_runs, packing, quality
from boxloom.llm.common import stored

ORACLE_SQL = None      # a trained classifier and a tokenizer stand in the way of SQL


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, scores 0.7 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out("doc_id"))
    return quality.keep_good(docs, quality.fit(docs, labels))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that came earlier; those that lose every line go."""
    out = line_runs.dedup_lines(docs, lines="_lines_before", deleted="_lines_gone")
    left = out.where("_lines_gone = 0 or trim(text) <> ''")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", line_runs.counted(left, deleted="_lines_gone"))
    return left.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return jaccard_join.one_of_each(docs, size=5, share=80)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 1024 tokens."""
    return packing.pack(packing.pieces(docs))


STAGES = [("quality classifier", good_documents), ("line dedup", fresh_lines), ("n-gram Jaccard join", one_of_each_group),
          ("benchmark decontamination", clean_of_benchmark), ("best-fit packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's documents written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
