"""Ranks within groups, also for groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelake.session import durable, written


def sort_columns(order: list[str]) -> list[Column]:
    """``"-x"`` sorts by x descending, ``"x"`` ascending."""
    return [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in order]


def top_n(df: DataFrame, group: list[str], order: list[str], n: int, rank: str = "_rank") -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in column ``rank``.

    Spark cuts each group to ``n`` rows in every map task before the shuffle, so a
    large group never reaches one task whole.
    """
    window = Window.partitionBy(*group).orderBy(*sort_columns(order))
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def rank_rows(
    df: DataFrame,
    group: list[str],
    order: list[str],
    tie: list[str],
    row_number: str | None = None,
    dense_rank: str | None = None,
) -> DataFrame:
    """``row_number`` (by order and tie) and ``dense_rank`` (by order) within each group.

    Groups of any size are range partitioned by group, order and tie, which together should tell
    rows apart. The slices are written, ranked each for itself and shifted by what the group's
    earlier slices hold.
    """
    if not group and not dense_rank and row_number:
        return _numbered(df, sort_columns([*order, *tie]), row_number)
    key = F.struct(*group) if group else F.struct(F.lit(0).alias("_all"))
    ranked = _rank_slices(df.withColumn("_group", key), order, sort_columns(order), sort_columns([*order, *tie]))
    ranks = {row_number: "_row", dense_rank: "_dense"}
    return ranked.select(
        *df.columns, *[F.col(rank).cast("bigint").alias(name) for name, rank in ranks.items() if name]
    )


def _numbered(rows: DataFrame, by_row: list[Column], name: str) -> DataFrame:
    """Row numbers of a whole table: the rows are shuffled once, to sorted slices, and keep their place there."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    slices = rows.repartitionByRange(*by_row).sortWithinPartitions(*by_row).withColumns(
        {"_slice": F.spark_partition_id(), "_place": place}
    )
    slices = written(slices, "slices")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slices.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    # One row a slice, so no more than there are shuffle partitions.
    return slices.join(F.broadcast(offsets), "_slice").select(
        *rows.columns, (F.col("_place") + F.col("_before") + 1).cast("bigint").alias(name)
    )


def _rank_slices(
    rows: DataFrame, order: list[str], by_value: list[Column], by_row: list[Column]
) -> DataFrame:
    """Add ``_row`` and ``_dense``. The slices are written, so both passes see the same ones."""
    value = F.struct(*[name.lstrip("-") for name in order])
    slices = durable(
        rows.repartitionByRange(F.asc("_group"), *by_row).withColumn("_slice", F.spark_partition_id())
    )
    in_slice = Window.partitionBy("_group", "_slice")
    local = slices.withColumns(
        {
            "_row": F.row_number().over(in_slice.orderBy(*by_row)),
            "_dense": F.dense_rank().over(in_slice.orderBy(*by_value)),
            "_value": value,
        }
    )
    # One row per group and slice, so a group has at most as many rows here as there are slices.
    summary = local.groupBy("_group", "_slice").agg(
        F.max("_row").alias("_rows"),
        F.max("_dense").alias("_values"),
        F.min_by("_value", "_row").alias("_head"),
        F.max_by("_value", "_row").alias("_tail"),
    )
    across = Window.partitionBy("_group").orderBy("_slice")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    until = across.rowsBetween(Window.unboundedPreceding, 0)
    shared = F.coalesce((F.col("_head") == F.lag("_tail").over(across)).cast("int"), F.lit(0))
    offsets = summary.withColumn("_shared", shared).select(
        "_group",
        "_slice",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        (F.coalesce(F.sum("_values").over(before), F.lit(0)) - F.sum("_shared").over(until)).alias(
            "_values_before"
        ),
    )
    return local.join(offsets, ["_group", "_slice"]).withColumns(
        {
            "_row": F.col("_row") + F.col("_rows_before"),
            "_dense": F.col("_dense") + F.col("_values_before"),
        }
    )


def dense_keys(values: DataFrame, column: str, key: str, start: int = 0) -> DataFrame:
    """Distinct values of a column with keys ``start, start + 1, …`` in value order.

    The keys depend on the values alone, so a repeated run gives the same ones.
    """
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    ranked = rank_rows(distinct, [], [column], [], row_number=key)
    return ranked.withColumn(key, F.col(key) - 1 + start)
