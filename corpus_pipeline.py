"""The corpus pipeline: quality rules, near-duplicates, benchmark passages, secrets, then the mix of sources.

Every stage takes (spark, docs, sf_dir) and reads docs, the table that the stage before has written. All but the last
return the columns of documents; the last returns the mixed blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transect.llm import decontaminate, mixing, quality, secret_scan, simhash
from transect.llm.common import delete, made, release, stored, workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go. The forest is fit on labelled documents of docs."""
    return quality.filtered(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go."""
    return decontaminate.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secret_scan.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The blocks of the mix: shard, slot, source, block, n_words, doc_ids, text."""
    return mixing.Mix(docs).blocks()


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("source mix", source_mix),
]

#: SQL can express neither the forest nor the fingerprints; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over documents; what a stage returns is written to the shared folder and read again.

    Once it is written, the stage's own workspaces and what it has read go. The last stage's stay, as its result is read
    from them; transect.llm.common.release() deletes them when that has been written.
    """
    docs, at = spark.read.parquet(f"{sf_dir}/documents.parquet"), workspace(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        before = made()
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"{at}/{k}")
            release(spark, before)
            if k:
                delete(spark, f"{at}/{k - 1}")
    return docs
