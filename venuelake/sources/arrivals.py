"""Landing folders of which every file is read once: what was read is recorded by Spark's file source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelake.sources.tables import KEY_PATTERN, _raw_schema


def read_arrivals(
    spark: SparkSession, folder: str, record: str, ddl: str, handle: Callable[[DataFrame, int], None],
    nested: dict[str, str] | None = None, key: str | None = None,
    key_pattern: str = KEY_PATTERN, files_per_batch: int | None = None,
) -> int:
    """Call ``handle(rows, batch)`` with the rows of the files that came since the last call; returns the batches.

    ``record`` is a folder of this reader alone, in shared storage: the file source keeps the list of
    files already read in it. All files there are read (``availableNow``), in batches of ``files_per_batch`` if given, then
    the call returns. A batch whose handling failed comes again with the same files and number,
    so ``handle`` should be an upsert or an append of unknown keys. Columns, nested names and keys are
    as in ``read_landing``.
    """
    nested = nested or {}
    raw = _raw_schema(ddl, nested, spark)
    reader = spark.readStream.schema(raw).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    columns = [F.col(f"`{field.name}`").alias(nested.get(field.name, field.name)) for field in raw]
    if key:
        columns.insert(0, F.regexp_extract(F.col("_metadata.file_path"), key_pattern, 1).alias(key))
    handled = []

    def once(rows: DataFrame, batch: int) -> None:
        handle(rows, batch)
        handled.append(batch)

    stream = (
        reader.parquet(folder).select(*columns).writeStream.foreachBatch(once)
        .option("checkpointLocation", record).trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    return len(handled)
