"""The corpus pipeline: documents through five operators, each working on all its predecessor kept."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimflow.llm import decontaminate, mixing, ngram_join, quality_rules, surrogates
from dimflow.llm.queries import SURROGATE_KEY, read
from dimflow.session import scratch_path, tune

#: No stage can be said in SQL: hashed features, surrogates and edit distances have no DuckDB form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Five words a shingle, a similarity of 0.8. Of rows that share that doc_id the one
    with the smallest hash of its text stays. Rows without a doc_id belong to no group
    that could be named and stay as they are.
    """
    groups = ngram_join.similar_documents(docs, width=5, percent=80)
    keep = groups.filter("doc_id = component_id").select("doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy("h", "row.text")
    kept = docs.join(keep, "doc_id", "left_semi").select(
        F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("h")
    )
    kept = kept.withColumn("at", F.row_number().over(order)).filter(F.col("at") == 1)
    return kept.select("row.*").unionByName(docs.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars follows the text."""
    done = surrogates.replace_entities(docs, SURROGATE_KEY)
    new = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text").cast("bigint"), F.col("row.n_chars"))}
    return done.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mixed stream."""
    return mixing.mixed_stream(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("privacy", privacy),
    ("mixture", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again."""
    docs = read(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = os.path.join(scratch_path(spark, "pipeline"), name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
