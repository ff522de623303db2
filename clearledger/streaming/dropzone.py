"""The drop zone of edit files as a stream: each call loads the files that are new since the last one.

Every micro-batch is a batch of sources.loads, named with its number, so a batch that the stream repeats after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from ..sources import loads
from ..sources.editfiles import classify, read_lines


def new_files(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of (path, length, sha256) with the classification of each new file."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.txt").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return classify(raw.select("path", "length", F.sha2("content", 256).alias("sha256")))


def load_new_files(spark: SparkSession, folder: str, target: str, checkpoint: str, overwrite: bool = False, files_per_batch: int = 100) -> None:
    """Load what is new and stop; a repeated call finds nothing new. The log is that of sources.loads."""

    def load(files: DataFrame, number: int) -> None:
        held = materialise(files, "files")
        loads.load_lines(held, read_lines(held.sparkSession, held.where("kind = 'edit'")), target, f"stream-{number:08d}", overwrite)

    q = new_files(spark, folder, files_per_batch).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
