"""New page files since the last run, by a file stream that stops when it has caught up.

The stream's checkpoint remembers which files were read. A batch may be handed over again after a
failure, so the handler must be repeatable: a window replace is, and so is a batch folder written
with overwrite.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.pages import envelope


def new_pages(
    spark: SparkSession,
    path: str,
    record: StructType,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    files_per_batch: int = 1000,
) -> None:
    """Give the rows of all page files not seen before to ``handle``, in batches, then return."""
    pages = (
        spark.readStream.schema(envelope(record)).option("maxFilesPerTrigger", files_per_batch).json(path)
    )
    rows = pages.select(F.explode("results").alias("r")).select("r.*")
    query = (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()


def land_batches(folder: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes each batch to its own sub-folder; a repeated batch replaces itself."""

    def handle(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return handle
