"""Places and running sums in a global order, without any task that sees more than a slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelake.llm.tables import written

_WITHIN = (1 << 33) - 1


def sliced(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` range-sorted and written, with its slice and its place ``at`` there.

    ``order`` must tell rows apart, or as many equal rows as there are meet in one slice.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(
        ranged.select(
            "*", F.spark_partition_id().alias("slice"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN)).alias("at"),
        ),
        name,
    )


def with_place(df: DataFrame, place: str) -> DataFrame:
    """Rows of ``sliced`` with their place in the whole order, from 0; the slices' sizes are one row a partition."""
    sizes = df.groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    return df.join(F.broadcast(offsets), "slice").select("*", (F.col("offset") + F.col("at")).alias(place)).drop(
        "slice", "at", "offset"
    )


def with_sum_before(df: DataFrame, key: str, value: str, total: str) -> DataFrame:
    """Rows of ``sliced``, ordered by ``key`` first, with the sum of ``value`` over the key's earlier rows.

    A key of any size is spread over its slices; what is summed across slices is one row per
    key and slice. Null keys are one key.
    """
    hashed = df.withColumn("_key", F.struct(key))
    inner = Window.partitionBy("slice", "_key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    running = hashed.withColumn("_own", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    parts = hashed.groupBy("slice", "_key").agg(F.sum(value).alias("_part"))
    outer = Window.partitionBy("_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("slice", "_key", F.coalesce(F.sum("_part").over(outer), F.lit(0)).alias("_before"))
    return running.join(offsets, ["slice", "_key"]).withColumn(total, F.col("_own") + F.col("_before")).drop(
        "_key", "_own", "_part", "_before"
    )
