"""Source ledger: what a growing table of text sources holds, entry by entry as it arrives.

    python -m jobs.source_ledger --table /data/documents.parquet --out /work/ledger --checkpoint /work/ledger.checkpoint --config jobs/source_ledger.json

Logs, notes and calibration texts of a survey are delivered again and again, and only what is new or has changed may
be worked on once more. This stream takes the files that its checkpoint doesn't know yet, in micro-batches, and appends
one entry for each of their rows: the identity by which a checkpointed export knows a source (size, and a hash of its first,
middle and last 4 KiB) and counts that show a broken delivery at once (lines, words, numbers). Entries lie under
batch=<n>/bucket=<k>/ as Parquet; a bucket is a hash of group and key, so no group, however large, is a partition.

Rerunning is safe: with nothing new no batch runs, and a batch that died is run again under its number and replaces its own
partitions. current() tells the newest entry of each source, how often it came, and whether it ever changed.
"""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transect.plans.checkpoint import probe_of
from transect.sources.survey import file_pattern

log = logging.getLogger(__name__)

#: Words are what ASCII white space divides; a number has no unit and no thousands separator. Lines count that hold a word.
WORD = r"[^\x20\x09-\x0D]+"
LINE = r"[^\x20\x09-\x0D][^\n]*"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
COUNTS = ("n_bytes", "n_lines", "n_words", "n_numbers")


@dataclass(frozen=True)
class Config:
    """Columns of a source's key within its group, of the group and of the text; the key's type; buckets of a batch; files of a micro-batch at most."""

    key: str
    group: str
    text: str
    key_type: str = "bigint"
    buckets: int = 8
    files_per_batch: int = 1000

    def __post_init__(self):
        if self.buckets <= 0 or self.files_per_batch <= 0:
            raise ValueError("buckets and files_per_batch must be positive")

    @staticmethod
    def load(path: str) -> Config:
        with open(path, encoding="utf-8") as f:
            return Config(**json.load(f))


def entries(rows: DataFrame, config: Config) -> DataFrame:
    """(source, key, n_bytes, n_lines, n_words, n_numbers, probe, delivered, bucket) of rows with file metadata; of a null text everything but key and source is null."""
    text, group, key = (F.col(f"`{c}`") for c in (config.text, config.group, config.key))
    numbers = F.size(F.filter(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: w.rlike(NUMBER)))
    return rows.select(
        group.cast("string").alias("source"), key.cast(config.key_type).alias("key"), F.octet_length(text).cast("bigint").alias("n_bytes"), F.regexp_count(text, F.lit(LINE)).cast("bigint").alias("n_lines"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words"), F.when(text.isNotNull(), numbers).cast("bigint").alias("n_numbers"), probe_of(text.cast("binary")).alias("probe"),
        F.col("_metadata.file_modification_time").alias("delivered"), F.pmod(F.xxhash64(group.cast("string"), key.cast(config.key_type)), F.lit(config.buckets)).cast("int").alias("bucket"),
    )


def run(spark: SparkSession, table: str, out: str, checkpoint: str, config: Config) -> dict[str, int]:
    """Enter what is new in the table and wait for the end; how many batches ran and rows they read and wrote."""
    done = {"batches": 0, "rows": 0, "missing": 0}

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.repartition(config.buckets, "bucket").withColumn("batch", F.lit(number).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket").parquet(out)
        n, missing = ledger_of(spark, out, config).filter(F.col("batch") == number).agg(F.count("*"), F.count_if(F.col("probe").isNull())).first()
        done.update(batches=done["batches"] + 1, rows=done["rows"] + n, missing=done["missing"] + missing)
        log.info("batch %d: read %d rows of %s, wrote as many entries to %s; %d without a text", number, n, table, out, missing)

    # A stream has no schema of its own: the table's is read from the footers of the files that are there.
    source = spark.readStream.schema(spark.read.parquet(table).schema).option("maxFilesPerTrigger", config.files_per_batch).parquet(file_pattern(table))
    query = entries(source, config).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    log.info("%s: %d new rows in %d batches", table, done["rows"], done["batches"])
    return done


def ledger_of(spark: SparkSession, out: str, config: Config) -> DataFrame:
    """All entries."""
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return spark.read.schema(f"source string, key {config.key_type}, {counts}, probe string, delivered timestamp, batch bigint, bucket int").parquet(out)


def current(ledger: DataFrame) -> DataFrame:
    """(source, key, counts, probe, n_entries, changed): the newest entry of each source by its file's time, then by batch; changed if its entries have different probes or its text was missing once."""
    newest = F.max_by(F.struct(*COUNTS, "probe"), F.struct("delivered", "batch", "probe"))
    known = F.coalesce("probe", F.lit(""))
    got = ledger.groupBy("source", "key").agg(newest.alias("e"), F.count("*").alias("n_entries"), (F.min(known) != F.max(known)).alias("changed"))
    return got.select("source", "key", "e.*", "n_entries", "changed")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("table", "out", "checkpoint", "config"):
        parser.add_argument(f"--{name}", required=True)
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("source ledger").getOrCreate()
    try:
        run(spark, given.table, given.out, given.checkpoint, Config.load(given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
