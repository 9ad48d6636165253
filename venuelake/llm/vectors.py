"""Vectors as packed matrices: rows dealt into groups of bounded size, one row per group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty, and all of its components are finite numbers."""
    finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(finite(x) & ~F.isnan(x), F.lit(False))), F.lit(False))


def packed(rows: DataFrame, group: Column, columns: list[str], name: str = "group") -> DataFrame:
    """One row per group, with an array of structs of ``columns``; the caller bounds the groups."""
    return rows.select(group.alias(name), F.struct(*columns).alias("item")).groupBy(name).agg(
        F.collect_list("item").alias("items")
    )


def matrix(lists: pa.Array, dims: int, kind: type = np.float64) -> np.ndarray:
    """A list column as a matrix of ``dims`` columns; shorter lists are filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), kind)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes] or [[]]).astype(int)] = flat
    return out
