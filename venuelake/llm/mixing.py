"""Sources mixed to target weights along a time-varying curriculum, in DataFrame functions.

Each source has a share of all words (its target) and a weight schedule over the training
time 0 to 1: target * (1 + slope * (2 t - 1)). The integral of the schedule is the source's
cumulative demand. Its documents, in a fixed pseudo-random order and pass after pass, fill
that demand; the time at which a document's middle word falls due is found by inverting the
integral, and a range sort by that time gives the training positions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake.llm.ordered import sliced, with_place, with_sum_before
from venuelake.llm.tables import numbered, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating; slopes of their schedules, between -1 and 1.
WEIGHTS = (1, 2, 3)
SLOPES = (-0.5, 0.0, 0.5)
#: Most times a document is taken.
MAX_REPEATS = 3


class Mix(NamedTuple):
    documents: DataFrame
    positions: DataFrame


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycled(values: tuple, place: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (place % len(values)).cast("int") + 1)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """Rows (source, source_size) with their place in source order and ``target`` words.

    A target is the level times the weight, at most ``repeats`` times the size; the level is
    raised until the targets sum up to all words. Each round adds the sources that the level
    of the round before puts above their limit, and sends two sums to the driver.
    """
    order = [F.col("source").asc_nulls_last()]
    placed = with_place(sliced(sizes, order, "mixing-sources"), "place")
    rows = written(placed.withColumn("weight", _cycled(weights, F.col("place"))), "mixing-weights")
    limit = F.col("source_size") * repeats
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    rest, weight, full = total, rows.agg(F.sum("weight")).first()[0] or 1, -1
    while True:
        above = limit.cast("double") <= F.col("weight") * F.lit(float(rest)) / F.lit(float(weight))
        count, capped, open_weight = rows.agg(
            F.count_if(above), F.sum(F.when(above, limit).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        if count == full or not open_weight:
            break
        full, rest, weight = count, total - capped, open_weight
    level = F.col("weight") * F.lit(float(rest)) / F.lit(float(weight))
    return rows.withColumn("target", F.least(limit.cast("double"), level)).drop("weight")


def demand_time(share: Column, slope: Column) -> Column:
    """When the part ``share`` of a source's demand is due: the inverse of t + slope * (t^2 - t)."""
    rest = 1 - slope
    return 2 * share / (rest + F.sqrt(rest * rest + 4 * slope * share))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS,
    slopes: tuple = SLOPES, repeats: int = MAX_REPEATS, row: str | None = None,
) -> Mix:
    """How often the mix takes each document, and where.

    ``documents``: row (a number per input row, or the unique column named), doc_id, size, source_size, target, passes and
    taken. ``positions``: row, pass and the training position from 0 of every taken document.
    The size is the number of words; a null text has none and is never taken. Null sources are one
    source, the last. Equal rows and equal ids each count for themselves; null ids sort as
    empty text. Of the last pass over a source those documents are taken whose middle lies
    within the target, so the sum is off by half a document at most. Other columns are not
    read; no documents give no rows.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    own = written(
        docs.select(
            number.alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
        ),
        "mixing-sizes",
    )
    totals = own.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(totals, weights, repeats), "mixing-targets")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("size"), F.col("row")]
    running = with_sum_before(
        sliced(own.withColumn("key", key), order, "mixing-order"), "source", "size", "before"
    )
    known = running.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "d.*", "t.source_size", "t.target", "t.place"
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    inside = 2 * F.col("before") + F.col("size") <= 2 * (F.col("target") - F.col("whole") * F.col("source_size"))
    passes = F.when(F.col("size") > 0, F.least(F.lit(repeats), F.col("whole") + inside.cast("int"))).otherwise(0)
    documents = written(
        known.withColumn("whole", whole).withColumn("passes", passes.cast("int"))
        .withColumn("taken", F.col("size") * F.col("passes"))
        .withColumn("slope", _cycled(slopes, F.col("place"))).drop("whole", "place"),
        "mixing-documents",
    )
    due = documents.where("passes > 0").select(
        "row", "key", "target", "slope", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("pass"),
        (F.col("source_size") * F.col("pass") + F.col("before") + F.col("size") / 2).alias("due"),
    )
    timed = due.select(
        "row", "pass", "key",
        demand_time(F.least(F.lit(1.0), F.col("due") / F.col("target")), F.col("slope")).alias("time"),
    )
    order = [F.col("time"), F.col("key"), F.col("pass"), F.col("row")]
    positions = with_place(sliced(timed, order, "mixing-positions"), "position")
    return Mix(
        documents.select("row", "doc_id", "size", "source_size", "target", "passes", "taken"),
        positions.select("row", "pass", "position"),
    )


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **settings
) -> DataFrame:
    """The documents in training order, each as often as the mix takes it; columns as given."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = numbered(docs.select(doc), "mixing-input", "row")
    flat = rows.select(
        "row", *[F.col(f"doc.`{old}`").alias(new) for old, new in ((doc_id, "doc_id"), (text, "text"), (source, "source"))]
    )
    # Written, so that Spark knows the size of the positions and need not shuffle texts to a small list.
    taken = rows.join(written(mix(flat, row="row", **settings).positions, "mixing-where"), "row")
    return taken.repartitionByRange("position").sortWithinPartitions("position").select("doc.*")
