"""New image files as a stream: the same measurements, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transect.config import Options
from transect.operators.measure import aggregate_files, measure_files
from transect.sources.calibration import Calibration

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def measure_stream(spark: SparkSession, root: str, calibration: Calibration, options: Options, out: str, checkpoint: str, files_per_trigger: int = 64, available_now: bool = True) -> StreamingQuery:
    """Append the file results of image files that appear under root/<set>/... to the Parquet table `out`.

    A file is one batch's and whole, so its profiles are aggregated inside its batch and no state is kept; the checkpoint
    remembers which files are done. With available_now the query ends when it has caught up. Index columns are not part of
    a stream (end frames look ahead), they join later.
    """
    files = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.3dc").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).load(root)
    named = files.select(F.regexp_extract("path", "/([0-9]+)/(?:[^/]+/)*[^/]+$", 1).alias("set_id"), F.regexp_extract("path", "/[0-9]+/((?:[^/]+/)*[^/]+)$", 1).alias("relative_path"), "content")

    def write(batch: DataFrame, batch_id: int) -> None:
        done = aggregate_files(measure_files(batch, calibration, options), options.skip_noisy)
        # A batch that runs again replaces its own folder, so nothing is there twice.
        done.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = named.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
