"""Exact top-k inner products by no-random-access aggregation over sorted lists.

The candidates are dealt into tiles. In a tile every dimension is a list sorted by value; a
query with a positive weight reads it from the top, with a negative one from the bottom.
After a number of entries from each list, what was read is exact and what was not is at most
the last value read: a candidate's upper bound. A query's lower bound is the k-th best score
it has so far, first over a sample of rows, then over the tiles already done. Reading stops
when few candidates have an upper bound that reaches the lower one; their scores are resolved.
A tile reads its lists for a block of queries at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venuelake.llm.tables import written
from venuelake.llm.vectors import matrix, packed, usable

K = 20
SCALE = 64
#: Rows of a tile, queries of a group and of a block within it.
TILE_ROWS, QUERY_GROUP, QUERY_BLOCK = 4096, 2048, 256
#: Rows whose scores give the first lower bounds; a larger sample only saves time.
SEED_ROWS = 8192
#: Parts of the lists read before bounds are compared, and the part of open candidates that ends reading.
DEPTHS = (0.5, 0.65, 0.8)
RESOLVE_SHARE = 0.1


def _kind(limit: float) -> type:
    """The fastest type that holds all partial sums exactly."""
    return np.float32 if limit < 2**24 else np.float64 if limit < 2**53 else np.int64


class Tile:
    """Candidates with their sorted lists."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.order = np.argsort(values, axis=0, kind="stable")

    def read(self, depth: float) -> tuple[np.ndarray, np.ndarray]:
        """Upper limits of all components after reading a part of each list from the top, lower ones from the bottom."""
        n, dims = self.values.shape
        count = min(n, max(1, int(np.ceil(n * depth))))
        columns = np.arange(dims)
        top, bottom = self.order[n - count :], self.order[:count]
        upper = np.repeat(self.values[top[0], columns][None], n, 0)
        lower = np.repeat(self.values[bottom[-1], columns][None], n, 0)
        upper[top, columns] = self.values[top, columns]
        lower[bottom, columns] = self.values[bottom, columns]
        return upper, lower


def nra(tile: Tile, queries: np.ndarray, least: np.ndarray, reads: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, candidate place, score) of all candidates that reach the query's lower bound ``least``."""
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    open_share = 1.0
    for depth in (*DEPTHS, 1.0):
        if depth not in reads:
            reads[depth] = tile.read(depth)
        upper, lower = reads[depth]
        bounds = positive @ upper.T + negative @ lower.T
        hits = bounds >= least[:, None]
        open_share = hits.mean() if hits.size else 0.0
        if open_share <= RESOLVE_SHARE or depth == 1.0:
            break
    at, candidate = np.nonzero(hits)
    if depth == 1.0:
        return at, candidate, bounds[at, candidate]
    scores = np.empty(len(at), queries.dtype)
    for start in range(0, len(at), 1 << 15):
        part = slice(start, start + (1 << 15))
        scores[part] = np.einsum("ij,ij->i", queries[at[part]], tile.values[candidate[part]])
    keep = scores >= least[at]
    return at[keep], candidate[keep], scores[keep]


def _best(at: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best, ties to the smaller id."""
    order = np.lexsort((ids, -scores, at))
    first = np.searchsorted(at[order], at[order], "left")
    return order[np.arange(len(order)) - first < k]


def _lower_bounds(queries: np.ndarray, own: np.ndarray, seed: np.ndarray, seed_rows: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best score among the seed rows, its own left out; minus infinity if they are fewer."""
    if len(seed) < k + 1:
        return np.full(len(queries), -np.inf)
    scores = (queries @ seed.T).astype(np.float64)
    scores[own[:, None] == seed_rows[None]] = -np.inf
    return np.partition(scores, len(seed) - k, axis=1)[:, len(seed) - k]


def top_k(
    table: DataFrame, queries: str, id_column: str = "vec_id", vector: str = "embedding", k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """The ``k`` best other rows of every row that fulfils the SQL condition ``queries``: query_id, rank, vec_id, score.

    Vectors are turned into floor(scale * x). Null vectors and such with null or non-finite
    components take no part; shorter vectors count as filled up with zeros. A query leaves out
    its own row only, so rows with equal ids find each other. Ties go to the smaller id, null
    last. With fewer candidates than ``k`` all are returned; an empty table gives no rows.
    Scores must fit into 64 bits. Other columns are read only by the condition.
    """
    rows = written(
        table.where(usable(F.col(vector))).select(
            F.col(id_column).cast("long").alias("vec_id"), F.coalesce(F.expr(queries), F.lit(False)).alias("asks"),
            F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "topk-rows",
    )
    count, asking, dims, largest = rows.agg(
        F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("v")),
        F.max(F.array_max(F.transform("v", F.abs))),
    ).first()
    tiles, groups = max(1, -(-count // TILE_ROWS)), max(1, -(-asking // QUERY_GROUP))
    kind = _kind(float(largest or 0) ** 2 * (dims or 0))
    seed = rows.where(F.pmod(F.xxhash64("row"), F.lit(max(1, count // SEED_ROWS))) == 0).limit(2 * SEED_ROWS)
    seed = seed.select("row", "v").toArrow()
    seed_values, seed_rows = matrix(seed.column("v"), dims or 0, kind), seed.column("row").to_numpy()
    shared = table.sparkSession.sparkContext.broadcast((seed_values, seed_rows))
    spread = F.xxhash64("row")
    tile_rows = packed(rows, F.pmod(spread, F.lit(tiles)), ["row", "vec_id", "v"], "tile")
    query_rows = packed(rows.where("asks"), F.pmod(spread, F.lit(groups)), ["row", "vec_id", "v"], "query_group")
    cells = tile_rows.withColumn("query_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>"))).join(
        query_rows.withColumnRenamed("items", "queries"), "query_group"
    ).repartition(F.col("tile"), F.col("query_group")).select("items", "queries")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                items, asked = (batch.column(c)[at].values for c in ("items", "queries"))
                tile = Tile(matrix(items.field("v"), dims, kind))
                ids = items.field("vec_id").to_numpy(zero_copy_only=False)
                order = np.where(np.isnan(ids.astype(float)), np.inf, ids) if items.field("vec_id").null_count else ids
                rows_at, reads = items.field("row").to_numpy(), {}
                q, q_rows = matrix(asked.field("v"), dims, kind), asked.field("row").to_numpy()
                for start in range(0, len(q), QUERY_BLOCK):
                    part = slice(start, start + QUERY_BLOCK)
                    least = _lower_bounds(q[part], q_rows[part], *shared.value, k)
                    place, found, scores = nra(tile, q[part], least, reads)
                    other = q_rows[part][place] != rows_at[found]
                    place, found, scores = place[other], found[other], scores[other]
                    keep = _best(place, order[found], scores, k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            asked.field("row").take(pa.array(start + place[keep])),
                            asked.field("vec_id").take(pa.array(start + place[keep])),
                            items.field("vec_id").take(pa.array(found[keep])), pa.array(scores[keep].astype(np.int64)),
                        ],
                        ["query_row", "query_id", "vec_id", "score"],
                    )

    found = cells.mapInArrow(search, "query_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
