"""Landing CSV drops as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallystone.sources.bronze import land_bronze

_LISTING = "path string, modificationTime timestamp, length long, content binary"


def land_arrivals(
    spark: SparkSession, drop_folder: str, bronze: str, checkpoint: str, max_files: int = 1000
) -> StreamingQuery:
    """Land every file not landed before, whatever its suffix, then stop.

    As for any Spark reader, names that begin with ``_`` or ``.`` are not data. The stream only
    discovers files: its checkpoint remembers which ones were taken, contents are
    read by ``land_bronze``, which resolves each file's header. A batch repeated after a failure
    rewrites the same snapshots. ``checkpoint`` must be on shared storage. Run it as often as
    files arrive.
    """

    def land(batch: DataFrame, _batch_id: int) -> None:
        paths = [row.path for row in batch.collect()]  # file names, at most max_files of them
        if paths:
            land_bronze(batch.sparkSession, paths, bronze)

    return (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("maxFilesPerTrigger", max_files)
        .load(drop_folder)
        .select("path")
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
