"""Continuous landing: new files are picked up and loaded as controlled runs.

The stream's checkpoint remembers which files were seen; the run registry
remembers which contents succeeded, so a batch that is replayed after a failure
skips finished content and resumes the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plumbline.plans.controlled_load import ControlledLoad

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def load_new_files(load: ControlledLoad, path: str, checkpoint: str, glob: str = "*.csv") -> StreamingQuery:
    """Start a query that loads all files landed so far and not yet seen, then stops."""
    files = (
        load.spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .load(path)
    )

    def load_batch(batch: DataFrame, _: int) -> None:
        # The names alone come here; Spark reads the files by blocks.
        paths = [r["path"] for r in batch.select("path").collect()]
        if paths:
            load.load(paths)

    return (
        files.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
