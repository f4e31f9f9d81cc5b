"""Corpus pipeline: toxic documents go, repeated lines go, one document of each
near-duplicate group stays, sources are mixed to target weights, and the mix is
encoded. Each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import byte_bpe, line_dedup, mixing, signature_tree, toxicity
from lodestar.llm.staging import stage

STAGES = [
    ("toxicity", toxicity.drop_toxic),
    ("line_dedup", line_dedup.drop_repeated_lines),
    ("jaccard_join", signature_tree.keep_one_of_each),
    ("mixing", mixing.take_mix),
    ("byte_bpe", byte_bpe.encode_documents),
]

#: Training, a trained vocabulary and whole-corpus joins by hash: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
