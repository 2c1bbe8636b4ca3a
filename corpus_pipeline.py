"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. ``quality``: documents that the classifier rejects go.
2. ``near_duplicates``: of each group of linked documents the one with the smallest id stays.
3. ``substrings``: words under repeated windows go, the documents stay.
4. ``mixture``: documents are chosen to fit the target weights of domains, languages and sources.
5. ``tokens``: texts become piece ids.

Every stage works on all that the one before kept. Null texts count as empty, repeated rows share
their fate, and an empty table passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import mixing, ngram_join, pieces, quality, substrings
from millrace.llm.queries import MIX, table, tokenizer
from millrace.llm.shared import scratch, stage

#: Repeats were removed two stages before, so no document is taken twice.
PIPELINE_MIX = mixing.Mix(**{**vars(MIX), "epochs": 1, "percent": 80})
#: The stage links by shingles of five words and a similarity of 0.8; op6 has a contract of its own.
NEAR = {"size": 5, "percent": 80}


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(stage(quality.measured(docs, "doc_id", "text"), "statistics"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = ngram_join.ngram_join(docs, **NEAR)
    gone = groups.where("id <> component_id").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cleaned = substrings.substring_dedup(docs, carry=others, keep_layout=True)
    back = {"doc_id": F.col("id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cleaned.select(*[back.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chosen = mixing.mixed(docs, PIPELINE_MIX).select(F.col("id").alias("doc_id"))
    return docs.join(chosen, "doc_id", "left_semi").select(docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(docs, tokenizer(), carry=["lang", "source"])
    return encoded.select(
        F.col("id").alias("doc_id"),
        F.col("row")["lang"].alias("lang"),
        F.col("row")["source"].alias("source"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_repeated_passages),
    ("mixture", mix_sources),
    ("tokens", encode_texts),
]

#: SQL cannot express the classifier, the similarity join or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, step) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
