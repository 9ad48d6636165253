"""Split multi-valued columns off into value and bridge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake.operators.ranking import dense_keys
from venuelake.operators.skew import skew_join
from venuelake.session import durable


def explode_values(df: DataFrame, values: Column, keep: list[str], name: str) -> DataFrame:
    """One row per element of an array; rows with a null or empty array give none."""
    return df.select(*keep, F.explode(values).alias(name))


def keyed_values(rows: DataFrame, column: str, key: str) -> DataFrame:
    """Add to each row the dense key (from 0, in value order) of its value.

    The distinct values are ranked, not the rows.
    """
    return skew_join(rows, dense_keys(rows, column, key), [column], "inner")


def normalize(
    df: DataFrame, array_column: str, value: str, parent: str, index: str = "id"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(parent table without the array, value table, bridge table)``.

    Values get ids from 1 in value order; the bridge holds each (parent, value) once.
    """
    # Repeats within a row go before it is exploded, those between rows of one index after.
    once = F.array_distinct(F.col(array_column))
    pairs = durable(explode_values(df, once, [index], value).distinct())
    values = dense_keys(pairs, value, "id", start=1)
    bridge = skew_join(
        pairs.withColumnRenamed(index, f"{parent}Id"),
        values.withColumnRenamed("id", f"{value}Id"),
        [value],
    ).select(f"{parent}Id", f"{value}Id")
    return df.drop(array_column), values.select(value, "id"), bridge
