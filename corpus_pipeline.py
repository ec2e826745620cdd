"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Toxic documents go; one document of each group of near duplicates stays (that with the least id,
and one row of it); documents with a benchmark passage go; secrets in the rest are replaced by a
sign; what is left is packed into sequences. Every stage's rows are written as a table and read
back before the next one, so a lost executor costs at most a stage; the tables that a stage makes
for itself are deleted then. All stages but the last keep the columns of their input.

Defined results: empty tables give empty results; null texts pass the filters and are
packed as empty ones; of rows with equal id and text one stays; of ties the stages' operators
tell (a document at exactly the toxicity threshold goes); very long texts are taken whole by all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, near_dedup, packing, secret_scan, toxicity
from tidemark.llm.common import settled


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject. It is trained on labelled documents of
    the whole table, outside the held-out third."""
    every = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(every, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by five words and a similarity of 0.8;
    documents without a word are no duplicates of each other."""
    return near_dedup.keep_one(docs, 5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of any benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced and ``n_chars`` brought up to date."""
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind)
    return clean.withColumn("n_chars", changed)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# Trained scores, MinHash and packing have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
