"""Prefix trie of conversations, its subtree sums by the Euler-tour technique.

A node is a distinct sequence of first turns, known by its smallest member and its depth. Each
node has an enter and an exit arc; the tour goes down to the first child, from sibling to
sibling and back up. The arcs, sorted by conversation and depth, follow each other in the tour
for most of the way, so runs of them are taken together and the list of runs is ranked by pointer
jumping. That gives every arc its position; sums over a subtree are differences of prefix sums
at the positions of its exit and its enter arc. Long conversations and nodes with any number of
children or members are spread over slices; no window or group holds more than a slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelake.llm.mixing import word_count
from venuelake.llm.tables import id_remainder, written
from venuelake.operators.skew import skew_join

#: A conversation takes its first turns from the first one of its block of ids.
BLOCK = 20
#: Number of turns taken: the id's checksum modulo this.
SHARED = 4
#: Member ids put into one text before it is hashed.
CHUNK_IDS = 10_000
_WITHIN = (1 << 33) - 1
_SUMS = ["s0", "s1", "s2", "s3"]
ARC = ["conv", "kind", "depth"]


def _in_slices(df: DataFrame, order: list[Column], keep: list[str], name: str) -> DataFrame:
    """The columns ``keep`` of ``df``, range-sorted and written, with ``slice`` and the place ``at`` there."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN))
    return written(ranged.select(*keep, F.spark_partition_id().alias("slice"), place.alias("at")), name)


def _sums_before(df: DataFrame, values: list[str], key: str | None = None) -> DataFrame:
    """Rows of ``_in_slices`` with ``<value>_before``: sums over the earlier rows, of the same ``key`` if given.

    Across slices one row per slice (and key) is summed.
    """
    keys = [key] if key else []
    inner = Window.partitionBy("slice", *keys).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    own = df.select("*", *[F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(f"{v}_own") for v in values])
    parts = df.groupBy("slice", *keys).agg(*[F.sum(v).alias(v) for v in values])
    outer = (Window.partitionBy(key) if key else Window).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "slice", *keys, *[F.coalesce(F.sum(v).over(outer), F.lit(0)).alias(f"{v}_offset") for v in values]
    )
    joined = own.join(offsets if key else F.broadcast(offsets), ["slice", *keys])
    return joined.select(*df.columns, *[(F.col(f"{v}_own") + F.col(f"{v}_offset")).alias(f"{v}_before") for v in values])


def _with_next(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows of ``_in_slices`` with ``next``: a struct of ``fields`` of the following row, null at the end."""
    own = F.struct(*fields)
    heads = df.where("at = 0").select("slice", own.alias("head"))
    following = df.select("slice").distinct().join(heads, "slice", "left").select(
        "slice", F.lead("head").over(Window.orderBy("slice")).alias("head")
    )
    inner = Window.partitionBy("slice").orderBy("at")
    return (
        df.withColumn("next", F.lead(own).over(inner)).join(F.broadcast(following), "slice")
        .select(*df.columns, F.coalesce("next", "head").alias("next"))
    )


def ordered_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (conv, place, content, words) of all turns with a conversation; places count from 0."""
    empty = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    rows = turns.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), empty(role).alias("role"),
        empty(text).alias("text"),
    ).withColumn("one", F.lit(1)).withColumn("words", word_count(F.col("text"))).withColumn(
        "content", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = _sums_before(_in_slices(rows, order, ["conv", "content", "words", "one"], "trie-turns"), ["one"], "conv")
    return written(placed.select("conv", F.col("one_before").alias("place"), "content", "words"), "trie-places")


def rebuilt(turns: DataFrame, convs: DataFrame, block: int, shared: int) -> DataFrame:
    """Rows (conv, depth, content, words): the first turns of the block's first conversation, then the own ones.

    ``turns`` are those of ``ordered_turns``, ``convs`` their (conv, n). A conversation takes less
    than ``shared`` turns, so a base turn is repeated for at most ``block`` conversations.
    """
    taken = id_remainder("conv", shared)
    known = convs.select("conv", taken.alias("taken"), (F.col("conv") - F.col("conv") % block).alias("base"))
    base = turns.where(F.col("place") < shared - 1).select(F.col("conv").alias("base"), "place", "content", "words")
    first = known.join(base, "base").where("place < taken").select(
        "conv", (F.col("place") + 1).alias("depth"), "content", "words"
    )
    sizes = convs.select(F.col("conv").alias("base"), "n")
    short = known.join(sizes, "base", "left").select(
        "conv", (F.col("taken") - F.coalesce("n", F.lit(0))).alias("lacking")
    ).where("lacking > 0")
    rest = skew_join(turns.where(F.col("place") >= taken), written(short, "trie-short"), ["conv"], "left").select(
        "conv", (F.col("place") + 1 - F.coalesce("lacking", F.lit(0))).alias("depth"), "content", "words"
    )
    return first.unionByName(rest)


def _prefix_id(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth, *sums)))


def prefixes(rows: DataFrame) -> DataFrame:
    """Rows (conv, depth, id, parent, words): every prefix of every rebuilt conversation.

    A prefix is known by the sum of the digests of its turns, each taken with its depth, as four
    sums of 32-bit numbers that never overflow.
    """
    digest = F.md5(F.concat(F.col("depth").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("content")))
    parts = [F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long").alias(name) for k, name in enumerate(_SUMS)]
    hashed = rows.withColumn("digest", digest).select("conv", "depth", "words", *parts)
    kept = ["conv", "depth", "words", *_SUMS]
    summed = _sums_before(_in_slices(hashed, [F.col("conv"), F.col("depth")], kept, "trie-turn-hashes"), _SUMS, "conv")
    before = [F.col(f"{s}_before") for s in _SUMS]
    own = _prefix_id(F.col("depth"), [F.col(s) + b for s, b in zip(_SUMS, before)])
    return written(
        summed.select("conv", "depth", own.alias("id"), _prefix_id(F.col("depth") - 1, before).alias("parent"), "words"),
        "trie-prefixes",
    )


def _root_id() -> Column:
    return _prefix_id(F.lit(0), [F.lit(0)] * len(_SUMS))


def trie_nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows (id, conv, depth, parent_conv, n_convs, saved, next_conv, n_children, first_child) of all nodes.

    ``next_conv`` is the next sibling, in order of the smallest member.
    """
    inner = rows.groupBy("id").agg(
        F.min("conv").alias("conv"), F.any_value("depth").alias("depth"), F.any_value("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"), F.any_value("words").alias("words"),
    )
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        _root_id().alias("id"), "conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"),
        "n_convs", F.lit(0).cast("long").alias("words"),
    )
    nodes = written(inner.unionByName(root), "trie-nodes")
    owners = nodes.select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv"))
    known = skew_join(nodes, owners, ["parent"], "left").withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    order = [F.col("parent_conv").asc_nulls_first(), F.col("depth"), F.col("conv")]
    kept = ["id", "conv", "depth", "parent_conv", "n_convs", "saved"]
    after = _with_next(_in_slices(known, order, kept, "trie-siblings"), ["parent_conv", "depth", "conv"])
    same = (F.col("next.parent_conv") == F.col("parent_conv")) & (F.col("next.depth") == F.col("depth"))
    siblings = written(after.select(*kept, F.when(same, F.col("next.conv")).alias("next_conv")), "trie-after")
    kids = siblings.where("depth > 0").groupBy(
        F.col("parent_conv").alias("conv"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count(F.lit(1)).alias("n_children"), F.min("conv").alias("first_child"))
    full = siblings.join(kids, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return written(full, "trie-full")


def tour_arcs(nodes: DataFrame) -> DataFrame:
    """Rows (conv, kind, depth, succ, leaf, saved, place, run): both arcs of every node and the next arc of the tour.

    ``kind`` is 0 to enter and 1 to leave. ``place`` is the one in the order of conversation,
    entering downwards, leaving upwards; ``run`` numbers the stretches in which each arc's next one comes next.
    """
    arc = lambda conv, depth, kind: F.struct(
        conv.alias("conv"), F.lit(kind).alias("kind"), depth.cast("long").alias("depth")
    )
    conv, depth = F.col("conv"), F.col("depth")
    enter = F.when(F.col("n_children") > 0, arc(F.col("first_child"), depth + 1, 0)).otherwise(arc(conv, depth, 1))
    leave = F.when(F.col("next_conv").isNotNull(), arc(F.col("next_conv"), depth, 0)).when(
        depth > 0, arc(F.col("parent_conv"), depth - 1, 1)
    )
    leaf = (F.col("n_children") == 0).cast("long")
    both = F.array(
        F.struct(F.lit(0).alias("kind"), enter.alias("succ"), leaf.alias("leaf"), F.col("saved").alias("saved")),
        F.struct(
            F.lit(1).alias("kind"), leave.alias("succ"), F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved")
        ),
    )
    arcs = nodes.select("conv", "depth", F.explode(both).alias("arc")).select("conv", "depth", "arc.*")
    order = [F.col("conv"), F.col("kind"), F.when(F.col("kind") == 0, depth).otherwise(-depth)]
    lined = _with_next(_in_slices(arcs, order, [*ARC, "succ", "leaf", "saved"], "trie-arcs"), ARC)
    ends = written(
        lined.withColumn("tail", (~F.col("succ").eqNullSafe(F.col("next"))).cast("long")).withColumn("one", F.lit(1)).drop("next"),
        "trie-tails",
    )
    counted = _sums_before(ends, ["tail", "one"])
    return written(
        counted.select(*ARC, "succ", "leaf", "saved", F.col("one_before").alias("place"), F.col("tail_before").alias("run")),
        "trie-runs",
    )


def list_ranked(runs: DataFrame) -> DataFrame:
    """Rows (run, start): how many arcs come before each run of (run, next, arcs), by pointer jumping.

    In each round a run takes over the pointer of the run it points to, and adds the arcs that
    this one reaches; the rounds grow with the logarithm of the number of runs.
    """
    total = runs.agg(F.sum("arcs")).first()[0] or 0
    ranks = written(runs.select("run", "next", F.col("arcs").alias("reach")), "trie-list")
    while not ranks.where("next is not null").isEmpty():
        ahead = ranks.select(F.col("run").alias("next"), F.col("next").alias("far"), F.col("reach").alias("more"))
        jumped = ranks.join(ahead, "next", "left")
        ranks = written(
            jumped.select("run", F.col("far").alias("next"), (F.col("reach") + F.coalesce("more", F.lit(0))).alias("reach")),
            "trie-list",
        )
    return ranks.select("run", (F.lit(total) - F.col("reach")).alias("start"))


def tour_positions(arcs: DataFrame) -> DataFrame:
    """The arcs with their ``position`` in the tour, from 0."""
    key = F.struct(*ARC)
    runs = written(
        arcs.groupBy("run").agg(
            F.min_by(key, "place").alias("head"), F.max_by("succ", "place").alias("succ"), F.count(F.lit(1)).alias("arcs"),
            F.min("place").alias("first"),
        ),
        "trie-run-ends",
    )
    heads = runs.select(F.col("head").alias("succ"), F.col("run").alias("next"))
    starts = list_ranked(runs.join(heads, "succ", "left").select("run", "next", "arcs")).join(runs.select("run", "first"), "run")
    shift = written(starts.select("run", (F.col("start") - F.col("first")).alias("shift")), "trie-starts")
    return skew_join(arcs, shift, ["run"]).select(
        "conv", "depth", "kind", "leaf", "saved", (F.col("place") + F.col("shift")).alias("position")
    )


def _subtree_sums(placed: DataFrame) -> DataFrame:
    """Rows (conv, depth, enter, n_leaves, saved_tokens) from prefix sums at the positions of both arcs."""
    line = _in_slices(placed, [F.col("position")], [*ARC, "leaf", "saved", "position"], "trie-tour")
    at = _sums_before(line, ["leaf", "saved"])
    sign = F.when(F.col("kind") == 1, 1).otherwise(-1)
    return at.groupBy("conv", "depth").agg(
        F.min("position").alias("enter"), F.sum(sign * F.col("leaf_before")).alias("n_leaves"),
        F.sum(sign * F.col("saved_before")).alias("saved_tokens"),
    )


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row (id, sha) per id of sorted rows (id, ids), fed into the hash text by text."""
    schema = pa.schema([("id", pa.binary()), ("sha", pa.string())])
    current = state = None
    for batch in batches:
        done = []
        for own, text in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
            if own != current:
                if state:
                    done.append((current, state.hexdigest()))
                current, state = own, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], f.type) for k, f in enumerate(schema)], schema=schema)
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([state.hexdigest()])], schema=schema)


def end_digests(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows (id, sha): the digest of the ascending ids of the conversations that end in a node.

    Ids are joined to texts of ``CHUNK_IDS`` in many tasks; a node's texts then stream through
    one hash, which holds its state only (about ten bytes an id pass through it).
    """
    last = rows.groupBy("conv").agg(F.max_by("id", "depth").alias("id"))
    ends = convs.join(last, "conv", "left").select("conv", F.coalesce("id", _root_id()).alias("id"))
    line = _in_slices(ends, [F.col("id"), F.col("conv")], ["id", "conv"], "trie-ends")
    texts = line.groupBy("slice", "id", F.floor(F.col("at") / CHUNK_IDS).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"), F.min("conv").alias("first")
    )
    streamed = texts.repartition("id").sortWithinPartitions("id", "first").select("id", "ids")
    return streamed.mapInArrow(_digest_runs, "id binary, sha string")


def conversation_trie(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block: int = BLOCK, shared: int = SHARED,
) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations.

    Columns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 and ``enter``, the position of the node's enter arc in the tour.
    Turns without a conversation id take no part. Null turns come first; equal turns are ordered by role and
    text, so repeated rows are turns of their own. A null role or text is empty. Whole texts count. Other
    columns are not read; no turns give no nodes. Two prefixes are taken as equal if 128-bit sums of
    turn digests are.
    """
    own = ordered_turns(turns, conv_id, turn, role, text)
    convs = written(own.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "trie-convs")
    rows = prefixes(rebuilt(own, convs, block, shared))
    nodes = trie_nodes(rows, convs)
    sums = written(_subtree_sums(tour_positions(tour_arcs(nodes))), "trie-sums")
    digests = written(end_digests(rows, convs), "trie-digests")
    empty = hashlib.sha256(b"").hexdigest()
    return nodes.join(sums, ["conv", "depth"]).join(digests, "id", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(empty)).alias("ends_sha256"), "enter",
    )
