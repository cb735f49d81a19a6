"""Profiles, index rows and tracks made from the driver's relational tables, to drive the survey operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Inches of pavement over which an embedding's values are laid.
WIDTH = 162.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profiles(spark: SparkSession, sf_dir: str, scale: float = 1.0, holes: bool = False) -> DataFrame:
    """(profile, file, x, y): an embedding as a profile, its label as its file. holes: nulls where (7 profile + 13 i) mod 11 is 0."""
    raw = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("profile"), F.col("label").cast("string").alias("file"), F.transform("embedding", lambda v: v.cast("double") * scale).alias("y"))
    if holes:
        raw = raw.withColumn("y", F.transform("y", lambda v, i: F.when((F.col("profile") * 7 + i * 13) % 11 != 0, v)))
    return raw.withColumn("x", F.transform(F.sequence(F.lit(0), F.size("y") - 1), lambda i: i * (F.lit(WIDTH) / F.size("y"))))


def sample_sql(scale: float = 1.0, holes: bool = False) -> str:
    """DuckDB: sample(profile, file, n, i, x, y), what profiles() holds, one row for each sample."""
    value = f"CAST(embedding[i + 1] AS DOUBLE) * {scale}"
    if holes:
        value = f"CASE WHEN (vec_id * 7 + i * 13) % 11 <> 0 THEN {value} END"
    return f"sample AS (SELECT vec_id AS profile, CAST(label AS VARCHAR) AS file, n, i, i * ({WIDTH} / n) AS x, {value} AS y FROM (SELECT *, len(embedding) AS n, unnest(range(0, len(embedding))) AS i FROM embeddings))"
