"""Node embeddings by fast random projection over a weighted graph."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.operators.skew import skew_join
from venuelake.session import durable, release, written

# One digest gives two hex digits for each of 16 dimensions.
DIMENSIONS_PER_DIGEST = 16
# Pairs below the first mean +1, pairs from the second on -1: 43 of 256 each, about a sixth.
PLUS_BELOW, MINUS_FROM = "2b", "d5"
# Edges into a block on average, and at most into one part of it: a task holds a vector for each at most.
BLOCK_EDGES = 16_384
PART_EDGES = 2 * BLOCK_EDGES
EDGES_AT_ONCE = 8_192


def random_row(node: Column, dimensions: int, seed: int) -> Column:
    """Sparse random vector of a node: +1, 0 or -1 per dimension, from digests of its name."""
    blocks = -(-dimensions // DIMENSIONS_PER_DIGEST)
    digests = F.transform(
        F.sequence(F.lit(0), F.lit(blocks - 1)),
        lambda block: F.md5(F.concat_ws(":", node, block.cast("string"), F.lit(str(seed)))),
    )

    def signs(digest: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(DIMENSIONS_PER_DIGEST - 1)),
            lambda i: _sign(F.substr(digest, 2 * i + 1, F.lit(2))),
        )

    return F.slice(F.flatten(F.transform(digests, signs)), 1, dimensions)


def _sign(pair: Column) -> Column:
    return F.when(pair < PLUS_BELOW, 1.0).when(pair >= MINUS_FROM, -1.0).otherwise(0.0)


def _blocked(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The adjacency in blocks of targets, and where each node's vector is needed.

    Edges (src, dst, weight, block, part): all edges of a target lie in its ``block``, so it gets one
    sum. A block with too many edges, such as those of a much-linked node, is cut into parts by the
    sources, and only there a target gets several. The needs are (src, block, part), each once.
    """
    blocks = max(1, -(-links.count() // BLOCK_EDGES))
    own = links.withColumn("block", F.pmod(F.xxhash64("dst"), F.lit(blocks)).cast("int"))
    counts = written(
        own.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PART_EDGES).cast("int").alias("cuts")), "cuts"
    )
    cut = F.pmod(F.xxhash64("src", F.lit(1)), "cuts").cast("int")
    edges = written(skew_join(own, counts, ["block"]).select("src", "dst", "weight", "block", cut.alias("part")), "edges")
    return edges, written(edges.select("src", "block", "part").distinct(), "needs")


def _multiplied(vectors: pa.Table, edges: pa.Table) -> pa.Table:
    """Rows (dst, sum, weight) of a block: the weighted sum of the vectors of each target's sources."""
    place = {name: at for at, name in enumerate(vectors["src"].to_pylist())}
    known = np.fromiter((place.get(name, -1) for name in edges["src"].to_pylist()), np.int64, len(edges))
    edges = edges.append_column("at", pa.array(known)).filter(pa.array(known >= 0))
    if not len(edges):
        empty = {"sum": pa.array([], pa.list_(pa.float64())), "weight": pa.array([], pa.float64())}
        return pa.table({"dst": edges["dst"], **empty})
    flat = vectors["vector"].combine_chunks()
    matrix = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)
    edges = edges.sort_by("dst")
    source = edges["at"].to_numpy()
    weight = edges["weight"].to_numpy().astype(np.float64)
    targets = edges["dst"].combine_chunks().dictionary_encode()
    code = targets.indices.to_numpy()
    sums = np.zeros((len(targets.dictionary), matrix.shape[1]))
    for start in range(0, len(code), EDGES_AT_ONCE):
        own = slice(start, start + EDGES_AT_ONCE)
        first = np.flatnonzero(np.concatenate([[True], np.diff(code[own]) != 0]))
        sums[code[own][first]] += np.add.reduceat(matrix[source[own]] * weight[own, None], first)
    bounds = pa.array(np.arange(len(sums) + 1, dtype=np.int32) * matrix.shape[1])
    return pa.table({
        "dst": targets.dictionary, "sum": pa.ListArray.from_arrays(bounds, pa.array(sums.ravel())),
        "weight": np.bincount(code, weight, len(sums)),
    })


def embed(
    nodes: DataFrame,
    edges: DataFrame,
    dimensions: int = schemas.EMBEDDING_DIMENSIONS,
    round_weights: tuple[float, ...] = (0.0, 1.0, 1.0),
    seed: int = schemas.EMBEDDING_SEED,
) -> DataFrame:
    """``(node, embedding)`` for every node; nodes without edges get a zero vector.

    Each round a node takes the weighted mean of its neighbours' vectors; the result is
    the weighted sum of the unit vectors of all rounds. Parallel edges are summed first. A round
    is a product of blocks: a vector goes once to each block its node has edges into, not along
    every edge, and all edges of a target meet there. The sums of a round are written down, then the round, so neither a node
    with very many edges nor a lost executor holds it up; what was shuffled for either and the round
    before go then, so the disk holds half a round at a time. Only nodes with edges take part.
    """
    links = written(edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "links")
    to_unit = Normalizer(p=2.0, inputCol="mean", outputCol="unit")
    zero = F.array_repeat(F.lit(0.0), dimensions)
    # Node names are short and vectors long: partitions sized for the names would be too few.
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = written(nodes.select("node").distinct(), "nodes")
    linked = links.select(F.col("src").alias("node")).union(links.select("dst")).distinct()
    names = durable(every.join(linked, "node", "left_semi").repartition(parts, "node"))
    cells, needs = _blocked(links)
    # The random rows are signs: a byte each on their way to the first round.
    signs = random_row(F.col("node"), dimensions, seed).cast("array<tinyint>")
    start = names.select("node", signs.alias("vector"), zero.alias("total"))
    state = start
    place, kind = ["block", "part"], links.schema["dst"].dataType.simpleString()
    for weight in round_weights:
        sent = skew_join(needs, state.select(F.col("node").alias("src"), "vector"), ["src"])
        partial = written(
            sent.groupBy(*place).cogroup(cells.toDF(*cells.columns).groupBy(*place)).applyInArrow(
                _multiplied, f"dst {kind}, sum array<double>, weight double"
            ),
            "sums",
        )
        means = partial.groupBy("dst").agg(
            Summarizer.sum(array_to_vector("sum")).alias("sum"), F.sum("weight").alias("weight")
        ).select(
            F.col("dst").alias("node"),
            F.when(F.col("weight") != 0, F.transform(vector_to_array("sum"), lambda x: x / F.col("weight"))).alias("mean"),
        )
        moved = state.select("node", "total").join(means, "node", "left").select(
            "node", "total", F.coalesce("mean", zero).alias("vector")
        )
        units = to_unit.transform(moved.withColumn("mean", array_to_vector("vector")))
        total = F.zip_with("total", vector_to_array("unit"), lambda a, b: a + weight * b)
        before, state = state, written(units.select("node", "vector", total.alias("total")), "embedding")
        release(*[table for table in (partial, before) if table is not start])
    alone = every.join(names, "node", "left_anti").select("node", zero.alias("total"))
    return state.select("node", "total").unionByName(alone).select("node", F.col("total").cast("array<float>").alias("embedding"))
