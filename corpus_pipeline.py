"""The corpus pipeline: STAGES, each (name, function of (spark, docs, sf_dir)), applied in turn to ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewarden.llm import decontaminate, exact_dedup, ngram_join, packing, toxicity
from pagewarden.llm.blocks import discard, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents scored 0.5 or more go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("tox_score < 0.5").select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7 on five-word shingles at 0.8: of each group of near copies the row with the smallest doc_id stays."""
    groups = ngram_join.join(docs, n=5, percent=80)
    gone = groups.where(F.col("component_id") < F.col("doc_id")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents with ten consecutive words of a benchmark item (or a whole shorter item) go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: a batch and a place in it for every document that is left."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Toxicity is a fitted model and packing a dynamic programme; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written in the shared folder and read again by the next."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
