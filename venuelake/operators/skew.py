"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from venuelake.session import durable

# A key with more than HOT_ROWS rows is hot and is cut into parts of about TASK_ROWS rows.
# The hot keys are collected and broadcast, so they are the HOT_SHARE largest at most; any
# other key holds less than 1/HOT_SHARE of the rows.
HOT_ROWS = 1_000_000
TASK_ROWS = 1_000_000
HOT_SHARE = 100_000
# Pairs of rows of one key that a task makes.
TASK_PAIRS = 100_000_000
# Pairs of rows, of all its keys, that a task of a join on both sides makes on average.
PART_PAIRS = 10_000_000
MOST_TASKS = 10_000
# Parts for rows without a key, which meet no row of the other side.
NULL_PARTS = 1 << 16


def hot_keys(df: DataFrame, keys: list[str]) -> list[Row]:
    """The (at most ``HOT_SHARE``) largest key values, nulls too, with more than ``HOT_ROWS`` rows, and their parts.

    Only the key columns are read, and they are counted in the map tasks first.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = counts.where(F.col("_rows") > HOT_ROWS).orderBy(F.desc("_rows")).limit(HOT_SHARE)
    return large.select(*keys, F.ceil(F.col("_rows") / TASK_ROWS).alias("_parts")).collect()


def _spread(df: DataFrame) -> DataFrame:
    """Add ``_at``, a number that spreads rows over parts.

    Rows are numbered in an order of their content within a task, so equal rows get different
    numbers, and a task that runs again gives the same rows the same numbers.
    """
    return df.sortWithinPartitions(F.xxhash64(*df.columns)).withColumn(
        "_at", F.monotonically_increasing_id() + F.spark_partition_id()
    )


def _part(parts: Column) -> Column:
    return F.pmod(F.col("_at"), parts).cast("int")


def _every_part(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)).cast("int") - 1))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    counted: DataFrame | None = None,
    hot: list[Row] | None = None,
) -> DataFrame:
    """Equi-join that spreads the hot keys of ``left`` over as many tasks as their rows ask for.

    Rows of ``left`` with a hot key are dealt into the key's parts; the matching rows of
    ``right`` are repeated once per part. All other rows join as usual, and no row is lost or
    repeated in the result. ``how`` may be inner, left, left_semi or left_anti, which all keep
    the rows of ``left`` apart. Rows of ``left`` with a null key match nothing and are spread as
    well. Without hot keys this is a plain join. A small ``right`` is broadcast by Spark after
    its own size check.

    ``counted`` is a cheaper frame to count the keys in than ``left``, such as the table
    that ``left`` comes from; ``hot`` is a list found before.
    """
    if hot is None:
        seen = left if counted is None else counted
        # Joins that keep unmatched rows keep those without a key; the others drop them unseen.
        hot = hot_keys(seen if how in ("left", "left_anti") else seen.dropna(subset=keys), keys)
    if not hot:
        return left.join(right, keys, how)
    schema = StructType([StructField(f.name, f.dataType) for f in left.select(*keys).schema]).add("_parts", "long")
    parts = F.broadcast(left.sparkSession.createDataFrame(hot, schema))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    own = F.when(no_key, _part(F.lit(NULL_PARTS))).when(F.col("_parts").isNotNull(), _part(F.col("_parts"))).otherwise(0)
    salted = _spread(left).join(parts, keys, "left").withColumn("_salt", own).drop("_parts", "_at")
    repeated = right.join(parts, keys, "left").withColumn("_salt", _every_part("_parts")).drop("_parts")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def _pair_counts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of both sides with their rows there, and whether they are hot on a side or by the pairs they make."""
    count = lambda df, name: df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    pairs = F.col("_l").cast("double") * F.col("_r")
    large = (F.greatest("_l", "_r") > HOT_ROWS) | (pairs > TASK_PAIRS)
    both = count(left, "_l").join(count(right, "_r"), keys)
    return both.withColumns({"_pairs": pairs, "_large": large})


def pair_parts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are hot on a side or by the pairs they make, with the parts of both sides."""
    rows, columns = (F.ceil(F.col(c) / TASK_ROWS) for c in ("_l", "_r"))
    more = F.greatest(F.lit(1.0), F.sqrt(F.col("_l") / rows * (F.col("_r") / columns) / TASK_PAIRS))
    return durable(
        _pair_counts(left, right, keys).where("_large").select(
            *keys, F.least(F.col("_l"), F.ceil(rows * more)).alias("_rows"),
            F.least(F.col("_r"), F.ceil(columns * more)).alias("_columns"),
        )
    )


def skew_join_both(left: DataFrame, right: DataFrame, keys: list[str], hint: str | None = None) -> DataFrame:
    """Inner equi-join for keys that may be hot on both sides, or make too many pairs for a task.

    Such a key is cut into a grid: every pair of rows meets in exactly one cell of it. The list of
    these keys grows with the data, so Spark's own size check decides how it is joined. A join of many pairs
    runs in as many tasks as its pairs ask for; by the size of its rows alone Spark may give them to one.
    ``hint`` is for the right side, of which Spark may not know how much it has grown.
    """
    sizes = _pair_counts(left, right, keys).agg(F.sum("_pairs").alias("pairs"), F.max("_large").alias("large")).first()

    def met(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        if (sizes.pairs or 0) > PART_PAIRS:
            few = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            tasks = min(MOST_TASKS, max(few, ceil(sizes.pairs / PART_PAIRS)))
            a, b = a.repartition(tasks, *on), b.repartition(tasks, *on)
        return a.join(b.hint(hint) if hint else b, on)

    if not sizes.large:
        return met(left, right, keys)
    parts = pair_parts(left, right, keys)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        known = _spread(df).join(parts, keys, "left")
        place = _part(F.coalesce(F.col(own), F.lit(1)))
        return known.withColumn(f"{own}_at", place).withColumn(f"{other}_at", _every_part(other)).drop(
            "_rows", "_columns", "_at"
        )

    cells = dealt(left, "_rows", "_columns"), dealt(right, "_columns", "_rows")
    joined = met(*cells, [*keys, "_rows_at", "_columns_at"])
    return joined.drop("_rows_at", "_columns_at")
