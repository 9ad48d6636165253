"""How filters interact: what each order of them removes, from words that say which subsets a document survives.

Bit S of a document's word (S a set of filters, as bits) says that it fails no filter of S. All
figures follow from the number of documents alive after each of the 32 subsets, so the words of
a part and label are added up place by place: carry-save adders turn three words into a sum and a
carry plane, until a few planes are left whose bits are counted. No order is run over documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import combinations, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from venuelake.llm.tables import chunks, written
from venuelake.operators.skew import skew_join

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ORDERS = ["".join(order) for order in permutations(FILTERS)]
_UPPER = bytes(range(65, 91))
_INNER = bytes(range(0x80, 0xC0))
_SYMBOL = re.compile(rb"[#$%&*|]")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text split into words at once.
BLOCK = 1 << 22
_BITS = np.arange(SUBSETS, dtype=np.uint32)


def word_stats(text: bytes) -> tuple[int, int]:
    """Number of words and of distinct words, block by block."""
    total, distinct, start = 0, set(), 0
    while start < len(text):
        cut = _SPACE.search(text, start + BLOCK)
        end = cut.start() if cut else len(text)
        own = text[start:end].split()
        total += len(own)
        distinct.update(own)
        start = end
    return total, len(distinct)


def own_failures(text: bytes) -> int:
    """The filters A to D that a text fails, as bits 0 to 3."""
    total, distinct = word_stats(text)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _INNER))
    failed = (total < 100, 100 * distinct < 80 * total, 100 * upper > 10 * points, bool(_SYMBOL.search(text)))
    return sum(1 << k for k, bad in enumerate(failed) if bad)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in chunks(batch, "text"):
            texts = piece.column("text").cast(pa.binary()).to_pylist()
            failed = pa.array([own_failures(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("part"), failed, digests], ["doc_id", "part", "failed", "digest"]
            )


def document_marks(docs: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """Rows (doc_id, part, failed, digest): the filters A to D failed, and 128 bits that stand for the text."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    schema = StructType([
        StructField("doc_id", rows.schema["doc_id"].dataType), StructField("part", StringType()),
        StructField("failed", IntegerType()), StructField("digest", BinaryType()),
    ])
    return written(rows.mapInArrow(_marks, schema), "audit-marks")


def with_copies(marks: DataFrame) -> DataFrame:
    """``marks`` with bit 4 of ``failed`` set where a smaller doc_id has the same text."""
    shared = marks.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    known = skew_join(marks, written(shared.drop("n"), "audit-shared"), ["digest"], "left")
    copied = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return known.select("doc_id", "part", (F.col("failed") + F.when(copied, 16).otherwise(0)).alias("failed"))


def label_bits(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, label): 1 if a row says quality 1, plus 2 if a row says toxic 1."""
    good, toxic = (F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)) for c in ("quality", "toxic"))
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), "quality", "toxic").dropna(subset=["doc_id"])
    return known.groupBy("doc_id").agg((good + 2 * toxic).alias("label"))


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit ``words`` have each bit set, by carry-save addition."""
    totals, weight = np.zeros(SUBSETS, np.int64), 1
    while len(words):
        carries = [np.zeros(0, np.uint32)]
        while len(words) >= 3:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * third :]])
        totals += weight * ((words[:, None] >> _BITS) & 1).sum(0, dtype=np.int64)
        words, weight = np.concatenate(carries), 2 * weight
    return totals


def _popcounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part and label of every batch."""
    for batch in batches:
        words = batch.column("word").to_numpy(zero_copy_only=False).astype(np.uint32)
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        parts = batch.column("part").dictionary_encode()
        group = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + labels
        order = np.argsort(group, kind="stable")
        groups, starts = np.unique(group[order], return_index=True)
        counts = [positional_popcounts(own).tolist() for own in np.split(words[order], starts[1:])] if len(groups) else []
        names = parts.dictionary.take(pa.array(groups // 4))
        yield pa.RecordBatch.from_arrays(
            [names.cast(pa.string()), pa.array(groups % 4, pa.int32()), pa.array(counts, pa.list_(pa.int64()))],
            ["part", "label", "counts"],
        )


def survivors(marks: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, alive): for each subset of filters the documents that survive it, of them good and toxic ones.

    ``alive`` is an array by subset of structs (n, good, toxic).
    """
    word_of = F.array(*[F.lit(sum(1 << s for s in range(SUBSETS) if not s & failed)) for failed in range(SUBSETS)])
    known = skew_join(marks, labels, ["doc_id"], "left").select(
        "part", F.coalesce("label", F.lit(0)).alias("label"), F.element_at(word_of, F.col("failed") + 1).alias("word")
    )
    counted = known.mapInArrow(_popcounts, "part string, label int, counts array<long>")
    flat = counted.select("part", "label", F.posexplode("counts").alias("subset", "n"))
    of = lambda bit: F.sum(F.when(F.col("label").bitwiseAND(bit) > 0, F.col("n")).otherwise(0))
    sums = flat.groupBy("part", "subset").agg(F.sum("n").alias("n"), of(1).alias("good"), of(2).alias("toxic"))
    alive = F.transform(
        F.array_sort(F.collect_list(F.struct("subset", "n", "good", "toxic"))),
        lambda x: F.struct(x.n.alias("n"), x.good.alias("good"), x.toxic.alias("toxic")),
    )
    return sums.groupBy("part").agg(alive.alias("alive"))


def _at(subset: Column | int, field: str) -> Column:
    return F.get("alive", subset if isinstance(subset, Column) else F.lit(subset))[field]


def _summed_removals(bit: int) -> Column:
    """What a filter removes, summed over all orders: each set before it stands in |S|! (4 - |S|)! of them."""
    others = [1 << k for k in range(len(FILTERS)) if 1 << k != bit]
    terms = [
        (_at(sum(before), "n") - _at(sum(before) + bit, "n")) * (factorial(size) * factorial(len(others) - size))
        for size in range(len(others) + 1) for before in combinations(others, size)
    ]
    return sum(terms[1:], terms[0])


def audit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """For each part, order of the five filters and step, what the filter does there.

    Rows (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley). A null part is the empty one, a null text the empty text, and equals it in filter E.
    Rows with equal ids are documents of their own; none of them is a copy of another by E, as
    neither id is smaller; a null id is no copy and has none, and no label. Of several labels of an id each counts
    that is 1; labels of other ids are left out. Very long texts are read block by block. Other
    columns are not read. No documents give no rows.
    """
    marks = written(with_copies(document_marks(docs, doc_id, text, part)), "audit-failed")
    alive = written(survivors(marks, label_bits(labels)), "audit-survivors")
    summed = F.array(*[_summed_removals(1 << k) for k in range(len(FILTERS))])
    letter = F.expr("substring(filter_order, step, 1)")
    before = sum(
        (F.when(F.instr("filter_order", name) < F.col("step"), 1 << k).otherwise(0) for k, name in enumerate(FILTERS)),
        F.lit(0),
    )
    steps = (
        alive.withColumn("summed", summed)
        .withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS))))
        .withColumn("step", F.explode(F.array(*map(F.lit, range(1, len(FILTERS) + 1)))))
        .withColumn("k", F.instr(F.lit(FILTERS), letter) - 1)
        .withColumn("own", F.element_at(F.array(*[F.lit(1 << k) for k in range(len(FILTERS))]), F.col("k") + 1))
        .withColumn("before", before)
        .withColumn("after", F.col("before") + F.col("own"))
    )
    own, early, late, rest = F.col("own"), F.col("before"), F.col("after"), F.lit(SUBSETS - 1) - F.col("own")
    removed = _at(early, "n") - _at(late, "n")
    return steps.select(
        "part", "filter_order", "step", _at(late, "n").alias("kept"), removed.alias("removed"),
        (_at(0, "n") - _at(own, "n") - removed).alias("redundant"),
        (_at(rest, "n") - _at(SUBSETS - 1, "n")).alias("unique_fails"),
        (_at(early, "good") - _at(late, "good")).alias("good_lost"),
        (_at(early, "toxic") - _at(late, "toxic")).alias("toxic_lost"), F.get("summed", F.col("k")).alias("shapley"),
    )
