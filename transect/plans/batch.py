"""Many sets in one run, and roll-ups of file results."""

from __future__ import annotations

import csv
import io
import json
import time
import traceback
from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transect.config import ExportConfig, safe_stem
from transect.plans.export import export_set
from transect.plans.files import write_text
from transect.sources.survey import discover_sets

COLUMNS = ["set", "status", "records_exported", "files_partial", "files_failed", "elapsed_seconds", "geojson", "csv", "metadata_json", "error"]


def set_rollup(results: DataFrame) -> DataFrame:
    """(set_id, files, files_ok, files_partial, files_failed, status): counts of file results and the status a single export has (ok or partial)."""
    out = results.groupBy("set_id").agg(F.count("*").alias("files"), *[F.count_if(F.col("status") == s).alias(f"files_{s}") for s in ("ok", "partial", "failed")])
    return out.withColumn("status", F.when(F.col("files_ok") == F.col("files"), "ok").otherwise("partial"))


def batch_rollup(sets: DataFrame) -> DataFrame:
    """One row of totals over sets; a set that isn't ok counts as failed."""
    return sets.agg(
        F.count("*").alias("sets_total"), F.count_if(F.col("status") == "ok").alias("sets_ok"), F.count_if(F.col("status") != "ok").alias("sets_failed"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("records_exported"), F.coalesce(F.sum("files_partial"), F.lit(0)).alias("files_partial"), F.coalesce(F.sum("files_failed"), F.lit(0)).alias("files_failed"),
    )


def severity_histogram(results: DataFrame) -> DataFrame:
    """(set_id, severity, files)."""
    return results.groupBy("set_id", "severity").agg(F.count("*").alias("files"))


def condition_totals(ratings: DataFrame) -> DataFrame:
    """(level, set_id, severity, n, n_ok, depth) of ratings (set_id, severity, state, depth): rows and mean depth over all of them, by set, and by set and severity, from one pass of grouping sets."""
    sets = ratings.groupingSets([[], ["set_id"], ["set_id", "severity"]], "set_id", "severity")
    got = sets.agg(F.grouping_id("set_id", "severity").alias("g"), F.count("*").alias("n"), F.count_if(F.col("state") == "ok").alias("n_ok"), F.avg("depth").alias("depth"))
    level = F.when(F.col("g") == 3, "all").when(F.col("g") == 1, "set").otherwise("severity")
    return got.select(level.alias("level"), "set_id", "severity", "n", "n_ok", "depth")


def missing_sets(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Requested set labels that aren't available."""
    return requested.select("set_id").distinct().join(available.select("set_id"), "set_id", "left_anti")


def repeated_sets(requested: DataFrame) -> DataFrame:
    """Set labels that are requested more than once."""
    return requested.groupBy("set_id").count().filter("count > 1").select("set_id")


def in_set_order(rows: DataFrame, column: str = "set_id") -> DataFrame:
    """Rows by the number of their set, then its label."""
    number: Column = F.col(column).cast("decimal(38,0)")
    return rows.orderBy(number, column)


def run_batch(spark: SparkSession, data_root: str, config: ExportConfig, sets: list[str] | None = None, index_dir: str | None = None) -> dict:
    """Export each set under data_root and write a summary as CSV and JSON; an error ends its set only. A set that is partial counts as failed."""
    began, results = time.time(), []
    root, out = data_root.rstrip("/"), config.out_dir.rstrip("/")
    for set_id in discover_sets(spark, root, sets):
        index = f"{index_dir.rstrip('/')}/set_{safe_stem(set_id)}_index.json" if index_dir else None
        row: dict = dict.fromkeys(COLUMNS) | {"set": set_id, "records_exported": 0, "files_partial": 0, "files_failed": 0, "traceback": None}
        try:
            done = export_set(spark, replace(config, set_dir=f"{root}/{set_id}", out_dir=f"{out}/set_{set_id}", index_json=index))
            row |= {k: done[k] for k in ("records_exported", "files_partial", "files_failed", "elapsed_seconds")} | done["outputs"] | {"status": "ok" if done["status"] == "ok" else "failed"}
        except Exception as e:  # noqa: BLE001  one set's failure is a row of the summary
            row |= {"status": "failed", "error": f"{type(e).__name__}: {e}", "traceback": traceback.format_exc()}
        results.append(row)
    stamp = f"{datetime.now(UTC):%Y%m%d_%H%M%S_%f}"
    text = io.StringIO(newline="")
    writer = csv.DictWriter(text, COLUMNS, extrasaction="ignore")
    writer.writeheader()
    writer.writerows(results)
    write_text(f"{out}/batch_summary_{stamp}.csv", text.getvalue())
    summary = {
        "schema_version": 1, "created_at": datetime.now(UTC).isoformat(timespec="seconds"), "elapsed_seconds": time.time() - began, "data_root": root, "out_dir": out, "sets_total": len(results),
        "sets_ok": sum(r["status"] == "ok" for r in results), "sets_failed": sum(r["status"] != "ok" for r in results), **{k: sum(r[k] for r in results) for k in ("records_exported", "files_partial", "files_failed")},
        "results": results, "outputs": {"csv": f"{out}/batch_summary_{stamp}.csv", "json": f"{out}/batch_summary_{stamp}.json"},
    }
    write_text(summary["outputs"]["json"], json.dumps(summary, indent=2, allow_nan=False))
    return summary
