"""Condition report: every transverse profile of a survey rated, placed on the track, and summed up by set and severity.

    python -m jobs.condition_report --profiles /data/embeddings.parquet --track /data/events.parquet --out /work/report --config jobs/condition_report.json

Under the output folder it writes

* ratings/set_id=<set>/: Parquet, one row for each profile: frame, the track's values at that frame, cross slope, rut depth
  by side and their mean, severity, state (ok, error, skipped);
* totals/: JSON, rows and mean depth over all, by set, and by set and severity, from one pass of grouping sets.

A run over all sets replaces ratings as a whole. With `sets` in the config, or --sets, only these sets' profiles are
read, and only their partitions are replaced; totals are then summed again over what ratings holds. Either way a run that
is repeated, or that died and is started again, leaves the same rows. Nothing passes through the driver but counts.
"""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transect.config import Lane, Options
from transect.functions.scalars import finite, severity
from transect.operators.arrays import grid
from transect.operators.measure import measure_profiles, overall_of
from transect.plans.batch import condition_totals
from transect.sources.survey import interpolated

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Config:
    """SQL expressions over the profile table (profile, set, heights, frame) and the track table, the width of pavement in inches that the heights span, their scale to inches, the lane (left, right, offset of its centre), and the sets to report on; none means all."""

    profile: str
    set: str
    heights: str
    frame: str
    width: float
    scale: float
    lane: tuple[float, ...]
    track_set: str
    track_frame: str
    track_values: dict[str, str] = field(default_factory=dict)
    sets: tuple[str, ...] | None = None

    @staticmethod
    def load(path: str) -> Config:
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        return Config(**given | {"lane": tuple(given["lane"]), "sets": None if given.get("sets") is None else tuple(map(str, given["sets"]))})


def placed(profiles: DataFrame, track: DataFrame, config: Config) -> DataFrame:
    """(set_id, profile, frame, h, track values) of the profile table: heights h, and what the track says at the frame."""
    rows = profiles.select(F.expr(config.set).alias("set_id"), F.expr(config.profile).cast("bigint").alias("profile"), F.expr(config.frame).cast("double").alias("frame"), F.expr(config.heights).alias("h"))
    marks = track.select(F.expr(config.track_set).alias("set_id"), F.expr(config.track_frame).alias("frame"), *[F.expr(e).cast("double").alias(n) for n, e in config.track_values.items()])
    return interpolated(rows, "frame", marks, list(config.track_values), key="set_id")


def rated(rows: DataFrame, config: Config) -> DataFrame:
    """(set_id, profile, frame, track values, state, cs_percent, left_depth, right_depth, depth, severity) of placed profiles."""
    # Measuring costs far more than moving a profile, so rows are dealt out evenly, whatever a file or a set holds.
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    none = F.array().cast("array<double>")
    heights = F.coalesce(F.transform("h", lambda v: v.cast("double") * config.scale), none)
    x = F.when(F.size("h") > 0, grid(F.size("h"), F.lit(config.width) / F.size("h"))).otherwise(none)
    names, options = ["profile", "frame", *config.track_values], Options()
    got = measure_profiles(rows.select("set_id", F.to_json(F.struct(*names)).alias("relative_path"), F.lit(0).alias("row_index"), x.alias("x"), heights.alias("y")), Lane(*config.lane), options.reduction(), options)
    left, right = finite(F.col("left.depth")), finite(F.col("right.depth"))
    of = F.from_json("relative_path", "profile bigint, " + ", ".join(f"`{n}` double" for n in names[1:]))
    out = got.select("set_id", of.alias("k"), "state", "cs_percent", left.alias("left_depth"), right.alias("right_depth"), overall_of(left, right).alias("depth"))
    return out.select("set_id", "k.*", "state", "cs_percent", "left_depth", "right_depth", "depth", severity(F.col("depth")).alias("severity"))


def run(spark: SparkSession, profiles: str, track: str, out: str, config: Config) -> dict[str, int]:
    """Write the report and return what was read and what there is now: profiles, track_rows, ratings, totals."""
    out, table, points = out.rstrip("/"), spark.read.parquet(profiles), spark.read.parquet(track)
    chosen = table if config.sets is None else table.filter(F.expr(config.set).isin(*config.sets))
    done = {"profiles": chosen.count(), "track_rows": points.count()}  # from the files' footers, or one column
    log.info("reading %d profiles of %s and %d track rows of %s", done["profiles"], profiles, done["track_rows"], track)
    writer = rated(placed(chosen, points, config), config).hint("rebalance", "set_id").write.mode("overwrite").partitionBy("set_id")
    if config.sets is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(f"{out}/ratings")
    condition_totals(ratings_of(spark, out, config)).write.mode("overwrite").json(f"{out}/totals")
    totals = totals_of(spark, out)
    done |= {"ratings": sum(r.n for r in totals.filter("level = 'all'").collect()), "totals": totals.count()}
    log.info("%s/ratings now holds %d rows, %s/totals %d", out, done["ratings"], out, done["totals"])
    return done


def ratings_of(spark: SparkSession, out: str, config: Config) -> DataFrame:
    """The ratings as they stand; set labels are text."""
    numbers = ["frame", *config.track_values]
    schema = "profile bigint, " + ", ".join(f"`{n}` double" for n in numbers) + ", state string, cs_percent double, left_depth double, right_depth double, depth double, severity int, set_id string"
    return spark.read.schema(schema).parquet(f"{out.rstrip('/')}/ratings")


def totals_of(spark: SparkSession, out: str) -> DataFrame:
    """The totals as they stand."""
    return spark.read.schema("level string, set_id string, severity int, n bigint, n_ok bigint, depth double").json(f"{out.rstrip('/')}/totals")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("profiles", "track", "out", "config"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--sets", nargs="*", help="report on these sets only")
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    config = Config.load(given.config)
    if given.sets is not None:
        config = replace(config, sets=tuple(given.sets))
    spark = SparkSession.builder.appName("condition report").getOrCreate()
    try:
        run(spark, given.profiles, given.track, given.out, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
