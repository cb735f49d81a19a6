"""All sets of a survey in one job: profiles of every set from one scan, each with its own set's calibration and lane.

Files of all sets are cut into tasks by their bytes (transect.sources.datasource), so a hundred small sets keep a cluster as
busy as one large one. Calibrations are a table, one row a set, joined by set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transect import schemas
from transect.config import COLUMNS, Options
from transect.functions.scalars import frame_of, stem_of
from transect.operators.arrays import grid
from transect.operators.measure import aggregate_files, measure_profiles
from transect.plans.batch import condition_totals
from transect.sources.calibration import calibrated, calibrations
from transect.sources.datasource import read_survey
from transect.sources.records import image_files
from transect.sources.survey import below, end_frames

CALIBRATION_NAME = "3D_Camera.cal"
#: Calibrations that are broadcast, 12 KB each; more of them are joined by a shuffle.
MOST_BROADCAST = 1_000


def set_calibrations(spark: SparkSession, root: str, columns: int = COLUMNS, name: str = CALIBRATION_NAME) -> DataFrame:
    """calibrations() of root/<set>/<name>, with set_id; a set whose file is missing or doesn't parse has no row."""
    found = calibrations(spark, f"{root.rstrip('/')}/*/{name}", columns)
    return found.select(F.element_at(F.split("path", "/"), -2).alias("set_id"), "*").filter(F.col("set_id").rlike("^[0-9]+$"))


def calibrated_profiles(profiles: DataFrame, cameras: DataFrame) -> DataFrame:
    """(set_id, relative_path, row_index, x, y, pavement_width, error) of profiles (set_id, relative_path, row_index, raw_heights, error): heights in inches by the calibration of the profile's set. Without one, or with one for another number of columns, an error."""
    few = cameras.select("set_id", "offsets", "resolution", "pavement_width")
    small = few.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    both = profiles.join(F.broadcast(few) if small else few, "set_id", "left")
    n = F.size("offsets")
    error = F.coalesce(
        F.col("error"),
        F.when(F.col("offsets").isNull(), F.concat(F.lit("no usable calibration of set "), F.coalesce("set_id", F.lit("(none)")))),
        F.when(F.col("resolution").isNull() | (F.col("resolution") <= 0), F.lit("the calibration's geometry has no height resolution")),
        F.when(F.size("raw_heights") != n, F.format_string("%d columns where the calibration has %d", F.size("raw_heights"), n)),
    )
    told = both.withColumn("error", error)
    good = F.col("error").isNull()
    return told.select(
        "set_id", "relative_path", "row_index", F.when(good, grid(n, F.col("pavement_width") / n)).alias("x"), F.when(good, calibrated(F.col("raw_heights"), F.col("offsets"), F.col("resolution"))).alias("y"), "pavement_width", "error"
    )


def survey_index(spark: SparkSession, root: str, fps: int = 30) -> DataFrame:
    """(set_id, relative_path, start_frame, end_frame) of the image files of all sets, from their names; those without a time code are left out."""
    rest = below(F.col("path"), root)
    files = image_files(spark, root, content=False).select(rest.alias("rest"), frame_of(stem_of(F.col("path")), fps).alias("start_frame"))
    parts = files.select(F.regexp_extract("rest", "^([0-9]+)/", 1).alias("set_id"), F.regexp_extract("rest", "^[0-9]+/(.*)$", 1).alias("relative_path"), "start_frame")
    return end_frames(parts.filter("set_id <> '' AND start_frame IS NOT NULL"))


def survey_results(spark: SparkSession, root: str, options: Options, sets: list[str] | None = None, columns: int = COLUMNS, fps: int = 30, **reading) -> DataFrame:
    """FILE_RESULT of the indexed files of all sets under root, or of some sets and start frames."""
    images = read_survey(spark, root, sets, columns=columns, fps=fps, **reading).filter("set_id IS NOT NULL AND start_frame IS NOT NULL")
    index = survey_index(spark, root, fps)
    rows = measure_profiles(calibrated_profiles(images, set_calibrations(spark, root, columns)), None, options.reduction(), options)
    got = aggregate_files(rows, options.skip_noisy).join(index, ["set_id", "relative_path"])
    return got.withColumn("file_name", F.element_at(F.split("relative_path", "/"), -1)).select(*[f.split(" ")[0] for f in schemas.FILE_RESULT.split(", ")])


def write_survey(spark: SparkSession, root: str, out: str, options: Options, sets: list[str] | None = None, **reading) -> DataFrame:
    """Write file results to out/files/set_id=<set>/ as Parquet in one job, then their totals to out/totals; the totals.

    A run over some sets replaces their partitions only; totals are summed again over all that is there.
    """
    out = out.rstrip("/")
    writer = survey_results(spark, root, options, sets, **reading).write.mode("overwrite").partitionBy("set_id")
    if sets is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(f"{out}/files")
    files = spark.read.schema(schemas.FILE_RESULT).parquet(f"{out}/files")
    totals = condition_totals(files.select("set_id", "severity", F.col("status").alias("state"), F.col("overall_average").alias("depth")))
    totals.write.mode("overwrite").parquet(f"{out}/totals")
    return spark.read.parquet(f"{out}/totals")
