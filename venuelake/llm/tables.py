"""Small helpers the operators share: tables written between stages, row ids, batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake.session import release, written  # noqa: F401

#: Text bytes handled at once inside a task, so that its arrays stay small.
CHUNK_BYTES = 1 << 20


def numbered(df: DataFrame, name: str, column: str) -> DataFrame:
    """``df`` with a unique number per row, written so that the numbers hold for good."""
    return written(df.withColumn(column, F.monotonically_increasing_id()), name)


def id_remainder(column: str | Column, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus``; null ids count as the empty text."""
    text = F.coalesce(F.col(column).cast("string") if isinstance(column, str) else column, F.lit(""))
    return F.crc32(text) % modulus


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold at most ``limit`` bytes, or one row."""
    column = batch.column(text)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = total = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > limit:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def partitions_for(df: DataFrame) -> int:
    """Shuffle partitions of the session, for the rare explicit repartition."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
