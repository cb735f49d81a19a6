"""Running numbers without a task for each class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transect.plans.files import ensure_shared_folder

#: Rows of the small sums that are broadcast; more of them are joined by a shuffle.
MOST_BROADCAST = 100_000
#: Tasks for each core, so that what one of them holds is a small part of the memory that cores share.
TASKS_A_CORE = 8


def tasks_of(spark: SparkSession) -> int:
    """Tasks for rows of which each task holds its own sorted: those of a shuffle, but TASKS_A_CORE for each core at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_A_CORE * spark.sparkContext.defaultParallelism)


def running_number(rows: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """rows with a column `name`: 1, 2, ... within each value of `by`, in the given order.

    Rows are sorted into ranges of (by, order...), so a large class is spread over many ranges. A class lies in one run of
    a range's rows: a row's number is its distance from the run's begin, and the rows before it, which are added from one
    small count for each range and class. Rows are moved and sorted once. Order columns must tell rows apart.
    """
    spark = rows.sparkSession
    ensure_shared_folder(spark)
    sorted_rows = rows.repartitionByRange(tasks_of(spark), by, *order).sortWithinPartitions(by, *order)
    ranged = sorted_rows.withColumns({"__range": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}).checkpoint()
    before = F.sum("__c").over(Window.partitionBy(by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    runs = ranged.groupBy("__range", by).agg(F.count("*").alias("__c"), F.min("__at").alias("__first"))
    shifts = runs.select("__range", by, (F.coalesce(before, F.lit(0)) - F.col("__first") + 1).alias("__shift")).checkpoint()
    same = [F.col("l.__range") == F.col("r.__range"), F.col(f"l.{by}").eqNullSafe(F.col(f"r.{by}"))]
    # Rows are in order of class, so shifts has at most one row more for each range than there are classes.
    small = shifts.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    joined = ranged.alias("l").join((F.broadcast(shifts) if small else shifts).alias("r"), same)
    return joined.select("l.*", "r.__shift").withColumn(name, F.col("__at") + F.col("__shift")).drop("__range", "__at", "__shift")
