"""Near-duplicate vectors by a forest of random-projection trees.

A node of a tree splits its vectors by their projection on a random direction, where fewest
lie near the split; those within a margin of it go to both sides. Nodes that a split would
cut through most of their vectors stay whole. The upper part of each tree is fitted on a
bounded sample, then leaves that are still large are split level by level over all rows.
Pairs are compared within leaves, leaves with many vectors block against block, and a pair is
counted in the first leaf it shares. Equal vectors are one class with a weight throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelake.llm.components import components
from venuelake.llm.tables import written
from venuelake.llm.vectors import matrix, usable

COSINE = 0.95
TREES = 4
#: Half the width of the overlap of two sides, for unit vectors; a third or so of the distance at the threshold.
MARGIN = 0.03
#: Vectors the upper trees are fitted on; leaves they aim at; leaves that are split further.
SAMPLE_ROWS, LEAF_ROWS, SPLIT_ROWS = 16_384, 512, 4096
#: Most vectors of one block of a leaf.
BLOCK_ROWS = 512
#: A node is left whole if every split has this part of it in its margin.
DENSE = 0.6
_SIDES = np.linspace(0.2, 0.8, 13)


def units(values: np.ndarray) -> np.ndarray:
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def direction(seed: int, dims: int) -> np.ndarray:
    x = np.random.default_rng(seed & 0xFFFFFFFFFFFF).standard_normal(dims)
    return x / np.linalg.norm(x)


def split_at(places: np.ndarray) -> float | None:
    """Where fewest of the projections lie within the margin; none if that would be most of them."""
    best = min(np.quantile(places, _SIDES), key=lambda t: np.count_nonzero(np.abs(places - t) < MARGIN))
    return None if np.count_nonzero(np.abs(places - best) < MARGIN) > DENSE * len(places) else float(best)


def fit_tree(sample: np.ndarray, leaf_rows: int, seed: int) -> tuple:
    """Nested (seed, split, left, right); a leaf is its number."""
    numbers = iter(range(1 << 31))

    def grow(rows: np.ndarray, seed: int, tries: int = 3) -> tuple | int:
        if len(rows) <= leaf_rows:
            return next(numbers)
        for k in range(tries):
            places = sample[rows] @ direction(seed + k, sample.shape[1])
            at = split_at(places)
            if at is not None:
                left, right = rows[places < at + MARGIN], rows[places > at - MARGIN]
                if max(len(left), len(right)) < len(rows):
                    return (seed + k, at, grow(left, 10 * seed + 11), grow(right, 10 * seed + 17))
        return next(numbers)

    return grow(np.arange(len(sample)), seed)


def leaves_of(tree: tuple | int, values: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(rows, leaf) for all leaves that the vectors reach."""
    if not len(rows):
        return
    if isinstance(tree, int):
        yield rows, tree
        return
    seed, at, left, right = tree
    places = values[rows] @ direction(seed, values.shape[1])
    yield from leaves_of(left, values, rows[places < at + MARGIN])
    yield from leaves_of(right, values, rows[places > at - MARGIN])


def _entries(classes: DataFrame, dims: int) -> DataFrame:
    """Rows (cls, leaf) of all classes in all trees, from trees fitted on a sample."""
    count = classes.count()
    part = F.pmod(F.xxhash64("cls"), F.lit(1 << 20)) < int(min(1.0, SAMPLE_ROWS / max(1, count)) * (1 << 20))
    # About SAMPLE_ROWS rows.
    sample = units(matrix(classes.where(part).select("v").toArrow().column("v"), dims)) if count else np.zeros((0, dims))
    leaf_rows = max(16, LEAF_ROWS * len(sample) // max(1, count))
    forest = [fit_tree(sample, leaf_rows, 1000 + t) for t in range(TREES)] if len(sample) else [0] * TREES
    shared = classes.sparkSession.sparkContext.broadcast(forest)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, ids = units(matrix(batch.column(1), dims)), batch.column(0).to_numpy()
            for number, tree in enumerate(shared.value):
                for rows, leaf in leaves_of(tree, values, np.arange(len(values))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[rows]), pa.array(np.full(len(rows), (number << 32) + leaf, np.int64))], ["cls", "leaf"]
                    )

    return classes.select("cls", "v").mapInArrow(assign, "cls long, leaf long")


def _split_large(entries: DataFrame, classes: DataFrame, dims: int, split_rows: int) -> DataFrame:
    """Leaves over ``split_rows`` split level by level, all at once, until they are small or dense."""
    done, todo, level = [], entries, 0
    while True:
        sizes = todo.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
        large = written(sizes.where(F.col("n") > split_rows), "vectors-large")
        if large.isEmpty():
            done.append(todo)
            break
        done.append(todo.join(large, "leaf", "left_anti"))

        def project(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values, leaf = units(matrix(batch.column(2), dims)), batch.column(1).to_numpy()
                places = np.empty(len(leaf))
                for one in np.unique(leaf):
                    own = leaf == one
                    places[own] = values[own] @ direction(int(one) * 31 + level, dims)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places)], ["cls", "leaf", "p"])

        own = todo.join(large.select("leaf"), "leaf").join(classes.select("cls", "v"), "cls")
        placed = written(own.select("cls", "leaf", "v").mapInArrow(project, "cls long, leaf long, p double"), "vectors-placed")
        cuts = placed.groupBy("leaf").agg(
            F.percentile_approx("p", [float(x) for x in np.linspace(0.15, 0.85, 15)], 1000).alias("q")
        )
        # The middle of the widest tenth of the rows; its width tells how many lie in the margin.
        widths = F.transform(F.sequence(F.lit(3), F.lit(13)), lambda k: F.struct(
            (F.element_at("q", k + 1) - F.element_at("q", k - 1)).alias("width"), F.element_at("q", k).alias("at")
        ))
        widest = F.array_max(widths)
        dense = 0.1 * 2 * MARGIN > DENSE * widest.width
        cuts = written(cuts.select("leaf", F.when(~dense, widest.at).alias("at")), "vectors-cuts")
        cut = placed.join(cuts, "leaf")
        done.append(cut.where("at is null").select("cls", "leaf"))
        sides = F.explode(F.array_compact(F.array(
            F.when(F.col("p") < F.col("at") + MARGIN, F.lit(0)), F.when(F.col("p") > F.col("at") - MARGIN, F.lit(1))
        ))).alias("side")
        todo = written(
            cut.where("at is not null").select("cls", "leaf", sides).select("cls", F.xxhash64("leaf", "side").alias("leaf")),
            "vectors-entries",
        )
        level += 1
    out = done[0].select("cls", "leaf")
    for more in done[1:]:
        out = out.union(more.select("cls", "leaf"))
    return out


def _linked(cell: pa.Table, dims: int, cosine: float) -> pa.Table:
    """Of one block pair of a leaf: links of each class that no earlier leaf has, and the class it hangs on."""
    leaf, low, high = (cell.column(c)[0].as_py() for c in ("leaf", "low", "high"))
    values = matrix(cell.column("v"), dims)
    ids, weights, block = (cell.column(c).to_numpy() for c in ("cls", "weight", "block"))
    norms = np.linalg.norm(values, axis=1)
    close = values @ values.T / (norms[:, None] * norms[None]) >= cosine
    np.fill_diagonal(close, False)
    if low != high:
        close &= block[:, None] != block[None]
    lists = cell.column("leaves").combine_chunks()
    owner = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
    earlier = lists.flatten().to_numpy()
    known, place = np.unique(earlier, return_inverse=True)
    member = np.zeros((len(ids), len(known)), np.float32)
    member[owner, place] = 1
    member = member[:, known < leaf]
    counted = close & (member @ member.T < 0.5)
    label = ids.copy()
    while True:
        best = np.minimum(label, np.where(close, label[None], np.iinfo(np.int64).max).min(axis=1))
        if (best == label).all():
            break
        label = best
    keep = (counted.any(axis=1)) | (label != ids)
    return pa.table(
        {"cls": ids[keep], "links": (counted @ weights)[keep].astype(np.int64), "root": label[keep]}
    )


def near_duplicates(
    table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
    block_rows: int = BLOCK_ROWS, split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """For every row: vec_id, n_links, component_id and kept.

    ``n_links`` counts the other rows found with a cosine of at least ``cosine``; none below it
    counts. ``component_id`` is the least id that links lead to, and the row that has it is kept.
    Null vectors and such that are zero or hold null or non-finite components link with nothing.
    Shorter vectors count as filled up with zeros. Equal rows, and rows with equal ids, are
    linked like any others; null ids are never the least. Other columns are not read; an empty
    table gives no rows.
    """
    size = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    good = usable(F.col(vector)) & (size > 0)
    rows = written(
        table.select(
            F.col(id_column).cast("long").alias("vec_id"), F.when(good, F.col(vector)).alias("v"),
        ).withColumns({"k1": F.xxhash64("v"), "k2": F.hash("v"), "row": F.monotonically_increasing_id()}),
        "vectors-rows",
    )
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    dims = max(dims, 0)
    there = rows.where("v is not null")
    classes = written(
        there.groupBy("k1", "k2").agg(
            F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.any_value("v").alias("v")
        ).withColumn("cls", F.monotonically_increasing_id()),
        "vectors-classes",
    )
    entries = written(
        _split_large(written(_entries(classes, dims), "vectors-leaves"), classes, dims, split_rows), "vectors-entries"
    )
    blocks = written(
        entries.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks")), "vectors-blocks"
    )
    lists = entries.groupBy("cls").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    whole = written(classes.select("cls", "v", "weight").join(lists, "cls"), "vectors-whole")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    cells = (
        whole.withColumn("leaf", F.explode("leaves")).join(blocks, "leaf")
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks"))).select("*", other)
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .select("leaf", "low", "high", "cls", "v", "weight", "leaves", "block")
    )
    linked = written(
        cells.groupBy("leaf", "low", "high").applyInArrow(
            lambda cell: _linked(cell, dims, cosine), "cls long, links long, root long"
        ),
        "vectors-linked",
    )
    found = components(linked.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    told = classes.select("k1", "k2", "cls", "least", "weight").join(found, F.col("cls") == F.col("node"), "left").join(
        links, "cls", "left"
    ).withColumn("component", F.coalesce("component", "cls"))
    told = written(told.drop("node"), "vectors-told")
    least = written(told.groupBy("component").agg(F.min("least").alias("component_id")), "vectors-least")
    by_class = written(told.join(least, "component"), "vectors-components")
    result = rows.join(by_class, ["k1", "k2"], "left")
    alone = F.col("v").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        "vec_id",
        F.when(alone, 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )
