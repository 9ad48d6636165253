"""Texts scored by a probabilistic suffix tree over words.

Counts cover every word of every training text. The root gives each word its discounted
relative frequency and keeps the rest for words never seen; the rest is divided among as many of
them as leave each the probability of a word seen once. A context of one or two words
becomes a state if its next-symbol distribution diverges from that of its suffix. A state
has smoothed probabilities of the symbols counted at least ``MIN_COUNT`` times after it, and leaves
the rest to its suffix. A word is scored in the longest suffix of its past that is a state.

The tree is a Spark table of all sequences counted so often, whatever the size of the corpus. The log
probability of a text is a sum over its sequences, so the tree meets the texts in one join: a sequence
brings what its entry adds to that of its suffix, and the back-off weight it has as a context of the next word.
Tasks only hold a cache of frequent words (``LOOKUP_SHARE`` of all tokens, at most a million) and
sequences (``STATE_SHARE``, at most 100,000 of each length), which are left out of the joins, and a sketch of
fixed size of the tree's other sequences, so that most sequences it lacks never leave their task; results do
not depend on either. Words and sequences are 64-bit hashes throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelake.llm.tables import chunks, id_remainder, partitions_for, release, written
from venuelake.llm.words import mix, word_hashes

LOOKUP_SHARE = 1e-6
STATE_SHARE = 1e-5
#: Times a sequence is counted to be an entry.
MIN_COUNT = 2
#: Divergence in nats from which a context is a state; pseudo-counts of the suffix's distribution.
MIN_DIVERGENCE = 0.01
PRIOR = 10.0
FOLDS, HELD_OUT = 7, 2
#: The end of a text as a word.
END = np.uint64(1)
#: Entries a task sums up before it passes them on.
HELD_ENTRIES = 2_000_000
#: Shares of the sequences, by key, that meet the tree one after the other: the disk holds the shuffle of one.
ROUNDS = 3
#: Slots, as a power of two, of the sketch of the tree's sequences: 16 MB at any size of the corpus.
SKETCH_BITS = 27
_CODE_BITS = np.int64(20)
_SEQUENCE = np.uint64(0xA0761D6478BD642F)


class Tree(NamedTuple):
    """The frequent part: words by hash, entries and contexts by packed symbol codes; logs to base 10.

    ``alphas`` are the weights of the words as contexts, 0 for symbols, which have theirs in ``state_logs``. All frequent
    contexts and sequences are listed; those that are no states have weight 1 and the probability of their suffix.
    """

    words: np.ndarray
    counts: np.ndarray
    alphas: np.ndarray
    symbols: np.ndarray
    entries: np.ndarray
    entry_logs: np.ndarray
    states: np.ndarray
    state_logs: np.ndarray
    tokens: int
    types: int
    discount: float


class Tables(NamedTuple):
    """The whole model: (key, count, alpha) of all words, and (key, value) of all longer sequences that add to a score."""

    words: DataFrame
    nodes: DataFrame


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words and ends of all texts, and the n + 1 bounds of each text's tokens."""
    hashes, bounds = word_hashes(texts)
    return np.insert(hashes, bounds[1:], END), bounds + np.arange(len(bounds))


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of ``keys`` among ``sorted_keys``, -1 where absent."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _summed(docs: DataFrame, keys: Callable[[pa.Array], tuple[np.ndarray, ...]], names: list[str]) -> DataFrame:
    """How often each combination of 64-bit keys that ``keys`` gives for the texts occurs in all: (*names, count).

    Tasks sum up what they hold and pass it on as arrays, sorted and dealt by a mix of the keys into as many parts as the
    session shuffles into: a repeated first key then costs next to nothing, and rows have no headers of their own.
    """
    parts = np.uint64(partitions_for(docs))
    columns = [*names, "count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def merged(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
            joined = [np.concatenate(c) for c in zip(*rows, strict=True)]
            order = np.lexsort(joined[-2::-1])
            joined = [c[order] for c in joined]
            new = np.ones(len(order), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in joined[:-1]], axis=0)
            first = np.flatnonzero(new)
            if not len(first):
                return tuple(joined)
            return *(c[first] for c in joined[:-1]), np.add.reduceat(joined[-1], first)

        def passed() -> pa.RecordBatch:
            spread = held[0][0]
            for column in held[0][1:-1]:
                spread = _follow(spread, column)
            part = (mix(spread) % parts).astype(np.int64)
            order = np.argsort(part, kind="stable")
            found, sizes = np.unique(part, return_counts=True)
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(c[order].view(np.int64))) for c in held[0]]
            return pa.RecordBatch.from_arrays([pa.array(found), *lists], ["part", *columns])

        for batch in batches:
            for part in chunks(batch, "text"):
                own = keys(part.column("text"))
                held.append(merged([(*own, np.ones(len(own[0]), np.int64))]))
                size += len(held[-1][0])
                if size > HELD_ENTRIES:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > HELD_ENTRIES // 2:
                        yield passed()
                        held, size = [], 0
        if size:
            held = [merged(held)]
            yield passed()

    fields = ", ".join(f"{n} array<long>" for n in columns)
    dealt = docs.select("text").mapInArrow(run, f"part long, {fields}").repartition("part")
    # Equal keys are in one part, so the parts they lie in are dealt out once.
    rows = dealt.select("part", F.inline(F.arrays_zip(*columns)))
    return rows.groupBy("part", *names).agg(F.sum("count").alias("count")).drop("part")


def _follow(context: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Key of each sequence followed by a token."""
    return mix(mix(context ^ _SEQUENCE) + tokens)


def _sequences(tokens: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Of two words, then of three: (place of the last token, key, key without the last token, key without the first).

    A sequence's key follows from the other two.
    """
    start = np.repeat(bounds[:-1], np.diff(bounds))
    keys, length = tokens, 1
    while length < 3:
        last = np.flatnonzero(np.arange(len(tokens)) - start >= length)
        longer = np.zeros(len(tokens), np.uint64)
        longer[last] = _follow(keys[last - 1], keys[last])
        yield last, longer[last], keys[last - 1], keys[last]
        keys, length = longer, length + 1


def _pack(*codes: np.ndarray) -> np.ndarray:
    key = codes[0].astype(np.int64) + 1
    for code in codes[1:]:
        key = (key << _CODE_BITS) | (code.astype(np.int64) + 1)
    return key


def _coded(symbols: np.ndarray, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of each token and of the two before it in its text; -1 is no symbol."""
    code = find(symbols, tokens)
    before, second = np.full(len(code), -1, np.int64), np.full(len(code), -1, np.int64)
    before[1:], second[2:] = code[:-1], code[:-2]
    starts = bounds[:-1]
    before[starts] = -1
    second[starts] = -1
    second[np.minimum(starts + 1, len(code) - 1)] = -1
    return code, before, second


def learn(docs: DataFrame) -> tuple[Tree, Tables]:
    """The frequent part of the tree of the training texts, and the tables of the whole."""
    counts = written(_summed(docs, lambda texts: tokens_of(texts)[:1], ["key"]), "model-words")
    total = counts.agg(
        F.sum("count"), F.count(F.lit(1)), F.count_if(F.col("count") == 1), F.count_if(F.col("count") == 2)
    ).first()
    tokens, types, once, twice = (int(x or 0) for x in total)
    discount = once / (once + 2 * twice) if twice else 0.5
    least = max(float(MIN_COUNT), STATE_SHARE * tokens)
    root = counts.where(F.col("count") >= MIN_COUNT).select(
        "key", "count", ((F.col("count") - discount) / max(1, tokens)).alias("p")
    )
    pairs, first = _level(docs, 0, root)
    triples, second = _level(docs, 1, pairs)
    words = written(_weighed(counts, first), "model-weights")
    grown, pairs = pairs, written(_weighed(pairs, second), "model-pairs")
    release(counts, grown, first, second)
    nodes = written(
        pairs.select("key", (F.col("gain") + F.col("alpha")).alias("value")).union(
            triples.select("key", F.col("gain").alias("value"))
        ).where("value <> 0"),
        "model-nodes",
    )

    # At most 1 / LOOKUP_SHARE rows.
    known = words.where(F.col("count") >= max(1.0, LOOKUP_SHARE * tokens)).toPandas()
    order = np.argsort(known["key"].to_numpy(np.int64).view(np.uint64))
    held = known["key"].to_numpy(np.int64).view(np.uint64)[order]
    times, alphas = known["count"].to_numpy(np.int64)[order], known["alpha"].to_numpy(float)[order]
    symbols = held[times >= least]
    # At most 1 / STATE_SHARE pairs and as many triples.
    two, three = (t.where(F.col("count") >= least).toPandas() for t in (pairs, triples))
    # Scores need no more of them than the nodes.
    release(pairs, triples)
    hashes = lambda frame, name: frame[name].to_numpy(np.int64).view(np.uint64)
    packed = _pack(find(symbols, hashes(two, "context")), find(symbols, hashes(two, "lower")))
    by_key = np.argsort(hashes(two, "key"))
    of = lambda keys: packed[by_key][find(hashes(two, "key")[by_key], keys)]
    ends = (of(hashes(three, "context")), of(hashes(three, "lower"))) if len(three) else (np.zeros(0, np.int64),) * 2
    mask = (np.int64(1) << _CODE_BITS) - 1
    entries = np.concatenate([packed, (ends[0] << _CODE_BITS) | (ends[1] & mask)])
    entry_logs = np.log10(np.concatenate([two["p"].to_numpy(float), three["p"].to_numpy(float)]))
    states = np.concatenate([_pack(np.arange(len(symbols))), packed])
    state_logs = np.concatenate([alphas[times >= least], two["alpha"].to_numpy(float)])
    by_entry, by_state = np.argsort(entries), np.argsort(states)
    tree = Tree(
        held, times, np.where(times >= least, 0.0, alphas), symbols, entries[by_entry], entry_logs[by_entry],
        states[by_state], state_logs[by_state], tokens, types, discount,
    )
    return tree, Tables(words, nodes)


def _level(docs: DataFrame, level: int, below: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences one longer than those of ``below`` (key, count, p), and the weights (key, alpha) of those that are states.

    Sequences are (key, context, lower, count, p, gain): ``p`` is the probability of the last word in the longest
    suffix of the context that is a state, ``gain`` its log less those of ``p`` of ``lower`` and of the context's weight.
    """

    # A sequence is counted twice only if both that are one shorter are.
    sketch = docs.sparkSession.sparkContext.broadcast(node_sketch(below))

    def sequences(texts: pa.Array) -> tuple[np.ndarray, ...]:
        _, _, context, lower = next(islice(_sequences(*tokens_of(texts)), level, None))
        kept = _maybe(sketch.value, SKETCH_BITS, context) & _maybe(sketch.value, SKETCH_BITS, lower)
        return context[kept], lower[kept]

    counted = written(
        _summed(docs, sequences, ["context", "lower"]).where(F.col("count") >= MIN_COUNT), "model-counted"
    )
    here = (F.col("count") + PRIOR * F.col("below")) / (F.col("n") + PRIOR)
    met = written(
        counted.join(below.select(F.col("key").alias("lower"), F.col("p").alias("below")), "lower")
        .join(below.select(F.col("key").alias("context"), F.col("count").alias("n")), "context")
        .withColumn("here", here).drop("n"),
        "model-met",
    )
    release(counted)
    rest = lambda name: F.greatest(F.lit(1e-9), 1 - F.sum(name))
    sums = met.groupBy("context").agg(
        F.sum(F.col("here") * F.log(F.col("here") / F.col("below"))).alias("part"),
        rest("here").alias("rest_here"), rest("below").alias("rest_below"),
    )
    ratio = F.col("rest_here") / F.col("rest_below")
    states = written(
        sums.where(F.col("part") + F.col("rest_here") * F.log(ratio) >= MIN_DIVERGENCE).select(
            F.col("context").alias("key"), F.log10(ratio).alias("alpha")
        ),
        "model-states",
    )
    grown = met.join(states.withColumnRenamed("key", "context"), "context", "left").select(
        "context", "lower", "count",
        F.when(F.col("alpha").isNull(), F.col("below")).otherwise(F.col("here")).alias("p"),
        F.when(F.col("alpha").isNull(), F.lit(0.0))
        .otherwise(F.log10(F.col("here") / F.col("below")) - F.col("alpha")).alias("gain"),
    )
    kept = written(grown.mapInArrow(_keyed, "key long, context long, lower long, count long, p double, gain double"), "model-level")
    release(met)
    return kept, states


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the key that follows from their context and lower sequence."""
    for batch in batches:
        context, lower = (batch.column(n).to_numpy().view(np.uint64) for n in ("context", "lower"))
        key = pa.array(_follow(context, lower).view(np.int64))
        yield pa.RecordBatch.from_arrays([key, *batch.columns], ["key", *batch.schema.names])


def _weighed(sequences: DataFrame, states: DataFrame) -> DataFrame:
    """Sequences with the log of the weight they have as contexts, 0 for those that are no states."""
    return sequences.join(states, "key", "left").withColumn("alpha", F.coalesce("alpha", F.lit(0.0)))


def _in_place(tree: Tree, tokens: np.ndarray, codes: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Per token: place among the looked-up words (or -1), log probability by the frequent part of the tree."""
    code, before, second = codes
    place = find(tree.words, tokens)
    log = np.where(place >= 0, np.log10(np.maximum(tree.counts[place] - tree.discount, 1e-9) / max(1, tree.tokens)), 0.0) \
        if len(tree.words) else np.zeros(len(tokens))
    for context, whole in ((_pack(before), before >= 0), (_pack(second, before), (second >= 0) & (before >= 0))):
        # Without its first word a context packs to that of its suffix, which has been counted.
        state = np.where(whole, find(tree.states, context), -1)
        hit = find(tree.entries, (context << _CODE_BITS) | (code + 1))
        if len(tree.states):
            log = np.where(state >= 0, log + tree.state_logs[state], log)
        if len(tree.entries):
            log = np.where((state >= 0) & (code >= 0) & (hit >= 0), tree.entry_logs[hit], log)
    if len(tree.words):
        # The weight of a word as the next one's context, unless it is a symbol, whose weight is among the states.
        log[1:] += np.where((place[:-1] >= 0) & (tokens[:-1] != END), tree.alphas[place[:-1]], 0.0)
    return place, log


def node_sketch(nodes: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """One bit per slot of the keys of ``nodes``: 2^bits of them, as bytes.

    Spark's bitmaps of 32,768 bits, at most 2^(bits - 15) of them, are put side by side.
    """
    slot = F.pmod("key", F.lit(1 << bits)) + 1
    rows = nodes.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    sketch = np.zeros(max(1, 1 << (bits - 15)) * 4096, np.uint8)
    for row in rows.toLocalIterator():
        sketch[(row["bucket"] - 1) * 4096 : row["bucket"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    return sketch


def _maybe(sketch: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """False where the sketch says that a key is no node."""
    slot = (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (sketch[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def _apart(
    tree: Tree, tokens: np.ndarray, bounds: np.ndarray, codes: tuple[np.ndarray, ...], sketch: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The sequences that are not among the frequent ones, and may be nodes by the sketch: number of the text, key."""
    code, before, second = codes
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pair = np.where((before >= 0) & (code >= 0), find(tree.entries, _pack(before, code)), -1)
    triple = np.where((second >= 0) & (pair >= 0), find(tree.entries, _pack(second, before, code)), -1)
    rows, keys = [], []
    for (last, key, _, _), held in zip(_sequences(tokens, bounds), (pair, triple), strict=True):
        rest = (held[last] < 0) & _maybe(sketch, SKETCH_BITS, key)
        rows.append(row[last[rest]])
        keys.append(key[rest])
    return np.concatenate(rows), np.concatenate(keys)


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Log10 probability of every whole text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose id's crc32 modulo 7 is 2 are held out of the training. A null or empty text is
    its end alone. Equal rows are trained on and scored each for itself; null ids count as empty text.
    ``base_score`` is that of single words with one added to each count. A word never seen counts as
    one of discount * types / (1 - discount) such words, which share what the discount leaves: it is
    as likely as a word seen once, and no more. If nothing was trained on, they have probability 1. Other columns
    are not read; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        (id_remainder(doc_id, FOLDS) == HELD_OUT).alias("held_out"),
    )
    tree, tables = learn(rows.where("not held_out"))
    context = docs.sparkSession.sparkContext
    shared, sketch = context.broadcast(tree), context.broadcast(node_sketch(tables.nodes))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                tokens, bounds = tokens_of(part.column("text"))
                codes = _coded(model.symbols, tokens, bounds)
                place, log = _in_place(model, tokens, codes)
                starts, ends = bounds[:-1], bounds[1:]
                known = place >= 0
                base = np.where(known, np.log10(model.counts[place] + 1.0), 0.0) if len(model.words) else np.zeros(len(tokens))
                other = np.concatenate([[0], np.cumsum(~known)])
                text_of, keys = _apart(model, tokens, bounds, codes, sketch.value)
                keys = keys[np.argsort(text_of, kind="stable")]
                apart = np.concatenate([[0], np.cumsum(np.bincount(text_of, minlength=len(ends)))])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(ends - starts),
                        pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                        pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(log, starts)),
                        pa.ListArray.from_arrays(
                            pa.array(other[bounds].astype(np.int32)), pa.array(tokens[~known].view(np.int64))
                        ),
                        pa.ListArray.from_arrays(pa.array(apart.astype(np.int32)), pa.array(keys.view(np.int64))),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "base", "log", "others", "apart"],
                )

    columns = (
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, log double,"
        " others array<long>, apart array<long>"
    )
    scanned = written(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(scan, columns), "model-scan")
    apart = scanned.select("row", F.explode("apart").alias("key"))
    of = lambda df, k: df.where(F.pmod("key", F.lit(ROUNDS)) == k)
    sums = [
        written(of(apart, k).join(of(tables.nodes, k), "key").groupBy("row").agg(F.sum("value").alias("met")), "model-sums")
        for k in range(ROUNDS)
    ]
    met = reduce(DataFrame.union, sums).groupBy("row").agg(F.sum("met").alias("met"))
    n, v = tree.tokens, tree.types
    unseen = np.log10((1 - tree.discount) / n) if n else 0.0
    others = scanned.select("row", F.explode("others").alias("key"))
    found = others.join(tables.words, "key", "left")
    logs = found.groupBy("row").agg(
        F.count("count").alias("more"), F.coalesce(F.sum(F.log10(F.col("count") + 1)), F.lit(0.0)).alias("more_base"),
        F.sum(
            F.when(F.col("count").isNull(), F.lit(float(unseen))).otherwise(
                F.log10((F.col("count") - tree.discount) / max(1, n)) + F.col("alpha")
            )
        ).alias("more_log"),
    )
    zero = F.lit(0.0)
    return scanned.drop("others", "apart").join(logs, "row", "left").join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("log") + F.coalesce("more_log", zero) + F.coalesce("met", zero)).alias("score"),
    )
