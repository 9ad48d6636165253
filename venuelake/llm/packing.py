"""Best-fit packing of documents into token sequences by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` ids. Whole pieces are sequences of their
own; the others are dealt into blocks of about ``BLOCK_ITEMS`` pieces by a hash, and each
block is evolved by several islands. A genome is a list of bins; crossover injects well
filled bins of one parent into the other, removes the bins they overlap and best-fits the
displaced pieces. Between epochs each island takes the elite of its neighbour. Only piece
lengths travel; the ids stay where they were written.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelake.llm.tables import written
from venuelake.llm.tokens import encoder

CAPACITY = 1024
END_ID = 2
#: Pieces evolved together; memory and time of a task follow from it, not from the corpus.
BLOCK_ITEMS = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 4
PIECES = "doc_id {id}, piece int, start long, length long, ids binary, ids_crc32 long"


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: the first takes what does not fill a piece."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)] if n else []


def token_pieces(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """The pieces of every document: ids (little-endian, 32 bits), their place in it and their CRC."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, end = encoder(tokenizer), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            keys, columns = [], {"piece": [], "start": [], "length": [], "ids": [], "ids_crc32": []}
            size = 0
            for at, value in enumerate(batch.column(1)):
                ids = model.encode(value.as_py() or "") + end
                for number, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    keys.append(at)
                    for name, item in zip(columns, (number, start, length, part, zlib.crc32(part)), strict=True):
                        columns[name].append(item)
                size += len(ids)
                if size > 8 << 20 or at + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(keys, pa.int64())), pa.array(columns["piece"], pa.int32()),
                            pa.array(columns["start"], pa.int64()), pa.array(columns["length"], pa.int64()),
                            pa.array(columns["ids"], pa.binary()), pa.array(columns["ids_crc32"], pa.int64()),
                        ],
                        ["doc_id", *columns],
                    )
                    keys, columns, size = [], {name: [] for name in columns}, 0

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        cut, PIECES.format(id=kind)
    )


Bins = list[list[int]]


def best_fit(items: list[int], sizes: list[int], bins: Bins, capacity: int) -> Bins:
    """Put each item into the fullest bin that still takes it, opening bins as needed."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for number, content in enumerate(bins):
        room = capacity - sum(sizes[i] for i in content)
        if room:
            by_room[room].append(number)
            rooms |= 1 << room
    for item in items:
        size = sizes[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[number].append(item)
        else:
            room, number = capacity, len(bins)
            bins.append([item])
        left = room - size
        if left:
            by_room[left].append(number)
            rooms |= 1 << left
    return bins


def fitness(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller full bins."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(a: Bins, b: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Whole well-filled bins of ``b`` in ``a``; what they displace is best-fitted, largest first."""
    filled = [x for x in b if sum(sizes[i] for i in x) >= 0.995 * capacity and rng.random() < 0.5]
    taken = {i for x in filled for i in x}
    child, displaced = [list(x) for x in filled], []
    for x in a:
        kept = [i for i in x if i not in taken]
        if len(kept) == len(x) and (sum(sizes[i] for i in x) >= 0.9 * capacity or rng.random() < 0.5):
            child.append(list(x))
        else:
            displaced += kept
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, child, capacity)


def evolve(sizes: list[int], elites: list[Bins], capacity: int, seed: int) -> Bins:
    """One island's epoch; ``sizes`` fall. The result is no worse than any elite it was given."""
    rng = random.Random(seed)
    order = range(len(sizes))
    population = list(elites) or [best_fit(list(order), sizes, [], capacity)]
    while len(population) < POPULATION:
        noisy = sorted(order, key=lambda i: -sizes[i] * rng.uniform(0.85, 1.15))
        population.append(best_fit(noisy, sizes, [], capacity))
    floor = -(-sum(sizes) // capacity)
    for _ in range(GENERATIONS):
        population.sort(key=lambda x: fitness(x, sizes, capacity), reverse=True)
        if len(population[0]) == floor:
            break
        parents = population[: max(2, POPULATION // 2)]
        children = [crossover(*rng.sample(parents, 2), sizes, capacity, rng) for _ in range(POPULATION // 2)]
        population = parents + children
    return max(population, key=lambda x: fitness(x, sizes, capacity))


def _genes(bins: Bins, n: int) -> bytes:
    genes = np.zeros(n, "<i4")
    for number, content in enumerate(bins):
        genes[content] = number
    return genes.tobytes()


def _bins(genes: bytes) -> Bins:
    bins: Bins = []
    for item, number in enumerate(np.frombuffer(genes, "<i4").tolist()):
        while len(bins) <= number:
            bins.append([])
        bins[number].append(item)
    return bins


def _epoch(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Rows (block, island, lengths, elites) to (block, island, genes, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                sizes = row["lengths"]
                seed = (row["block"] * ISLANDS + row["island"]) * EPOCHS + epoch
                best = evolve(sizes, [_bins(x) for x in row["elites"]], capacity, seed)
                count, fill = fitness(best, sizes, capacity)
                rows.append((row["block"], row["island"], _genes(best, len(sizes)), [float(count), fill]))
            block, island, genes, score = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block, pa.int64()), pa.array(island, pa.int32()), pa.array(genes, pa.binary()),
                    pa.array(score, pa.list_(pa.float64())),
                ],
                ["block", "island", "genes", "score"],
            )

    return islands.mapInArrow(run, "block long, island int, genes binary, score array<double>")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Bins for items (key long, length long, 1 to ``capacity``): key, sequence_id, offset.

    Keys are unique. Equal lengths are told apart by key, so reruns agree. No items give no
    rows. Offsets are gapless from 0 in every sequence.
    """
    count = items.count()
    blocks = max(1, -(-count // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")
    grouped = items.select(block, F.struct("length", "key").alias("item")).groupBy("block")
    dealt = written(
        grouped.agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
        .select("block", F.col("items.key").alias("keys"), F.col("items.length").alias("lengths")),
        "packing-blocks",
    )
    islands = dealt.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "lengths"
    )
    none = F.array().cast("array<binary>")
    elites = written(_epoch(islands.withColumn("elites", none), capacity, 0), "packing-elites")
    for epoch in range(1, EPOCHS):
        after = F.explode(F.array(F.col("island"), F.pmod(F.col("island") + 1, F.lit(ISLANDS)))).alias("island")
        moved = elites.select("block", after, "genes").groupBy("block", "island").agg(
            F.sort_array(F.collect_list("genes")).alias("elites")
        )
        elites = written(_epoch(islands.join(moved, ["block", "island"]), capacity, epoch), "packing-elites")
    best = elites.groupBy("block").agg(F.max_by("genes", F.struct("score", "island")).alias("genes"))
    return dealt.join(best, "block").mapInArrow(_placed, "key long, sequence_id long, offset long")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            keys, lengths = np.asarray(row["keys"]), np.asarray(row["lengths"])
            bins = np.frombuffer(row["genes"], "<i4")
            order = np.argsort(bins, kind="stable")
            before = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
            first = np.concatenate([[True], np.diff(bins[order]) > 0])
            offsets = before - before[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[order], pa.int64()),
                    pa.array(row["block"] * (1 << 32) + bins[order].astype(np.int64)),
                    pa.array(offsets.astype(np.int64)),
                ],
                ["key", "sequence_id", "offset"],
            )


def pack_documents(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Every document's pieces with the sequence and place they go to, and their ids.

    A null or empty text is one piece of the end id alone. Equal rows are packed each for
    itself; a null ``doc_id`` is carried along; other columns are not read. An empty table
    gives no rows. A text of any length is cut into pieces, the shorter one first.
    """
    pieces = written(
        token_pieces(docs, tokenizer, doc_id, text, capacity, end_id).withColumn(
            "key", F.monotonically_increasing_id()
        ),
        "packing-pieces",
    )
    whole = F.col("length") == capacity
    places = pack(pieces.where(~whole).select("key", "length"), capacity)
    own = pieces.where(whole).withColumns({"sequence_id": -1 - F.col("key"), "offset": F.lit(0).cast("long")})
    return pieces.where(~whole).join(places, "key").unionByName(own).drop("key")
