"""Repeated runs of lines deleted, by a suffix array over line ids built with prefix doubling.

Suffixes start at every line of every document. Round k ranks them by their first 2^k lines:
the pair of ranks of the two halves is ranked anew, by a distributed sort. Suffixes with
equal ranks form an interval whose common prefix is at least 2^k lines. A suffix whose rank
is its own can start no repeated run of that length and leaves. A run of m lines is named by
the ranks of its first and last 2^k lines, with 2^k <= m < 2 * 2^k.

A run counts from ``min_words`` words. It is enough to look at runs that fall below that
without their first or without their last line: every line of a longer repeated run lies in
one of these. As each line has a word, they have at most ``min_words`` lines, which bounds
the rounds. All but the first copy (by doc_id, then input row, then line) are deleted.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake.llm.mixing import WORD
from venuelake.llm.ordered import sliced, with_place
from venuelake.llm.tables import numbered, written

MIN_WORDS = 50
SUFFIX = ["row", "at"]


def _run_lengths(words: Column, min_words: int) -> Column:
    """For each line, how many lines from it on have ``min_words`` words; 0 if the text ends before."""

    def lines(at: Column) -> Column:
        start = F.struct(F.lit(0).alias("lines"), F.lit(0).alias("words"))
        end = F.aggregate(
            F.slice(words, at + 1, F.lit(min_words)), start,
            lambda run, n: F.when(run.words >= min_words, run).otherwise(
                F.struct((run.lines + 1).alias("lines"), (run.words + n).alias("words"))
            ),
        )
        return F.when(end.words >= min_words, end.lines).otherwise(0)

    return F.transform(words, lambda _, at: lines(at))


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """Rows (row, doc_id, at, id, ahead, back) of all lines with a word: their digest and run lengths.

    ``at`` counts these lines from 0. ``ahead`` and ``back`` are the lengths of the shortest
    runs with enough words that start and end there, 0 if there is none.
    """
    trimmed = F.transform(F.split("text", "\n", -1), lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))
    filled = F.filter(trimmed, lambda x: x != "")
    counts = F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD)))
    return (
        docs.where("text is not null").select("row", "doc_id", filled.alias("lines"))
        .select("row", "doc_id", "lines", counts.alias("words"))
        .select(
            "row", "doc_id",
            F.posexplode(
                F.arrays_zip(
                    F.transform("lines", lambda x: F.unhex(F.md5(x))).alias("id"),
                    _run_lengths(F.col("words"), min_words).alias("ahead"),
                    F.reverse(_run_lengths(F.reverse("words"), min_words)).alias("back"),
                )
            ).alias("at", "line"),
        )
        .select("row", "doc_id", "at", "line.*")
    )


def _ranked(suffixes: DataFrame, by: list[str], name: str) -> DataFrame:
    """Rows (row, at, rank) of the suffixes that share ``by`` with another one."""
    intervals = suffixes.groupBy(*by).agg(F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    ranks = with_place(sliced(intervals, [F.col(c) for c in by], f"{name}-intervals"), "new_rank")
    ranked = suffixes.join(written(ranks, f"{name}-ranks"), by)
    return written(ranked.select(*SUFFIX, F.col("new_rank").alias("rank")), name)


def _doubled(ranks: DataFrame, width: int, name: str) -> DataFrame:
    """Ranks by twice as many lines from the ranks by ``width`` lines."""
    second = ranks.select("row", (F.col("at") - width).alias("at"), F.col("rank").alias("second"))
    return _ranked(written(ranks.join(second, SUFFIX), f"{name}-pairs"), ["rank", "second"], name)


def _later_runs(runs: DataFrame, ranks: DataFrame, width: int) -> DataFrame:
    """Those of ``runs`` (row, doc_id, at, size; width <= size < 2 * width) with an earlier copy."""
    second = ranks.select("row", F.col("at").alias("last"), F.col("rank").alias("second"))
    named = runs.join(ranks, SUFFIX).withColumn("last", F.col("at") + F.col("size") - width).join(second, ["row", "last"])
    named = written(named.select("doc_id", *SUFFIX, "size", "rank", "second"), "lines-runs")
    name = ["size", "rank", "second"]
    place = F.struct("doc_id", *SUFFIX)
    first = named.groupBy(*name).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    kept = written(first.drop("copies"), "lines-first")
    return named.join(kept, name).where(place > F.col("first")).select(*SUFFIX, "size")


def repeated_lines(lines: DataFrame) -> DataFrame:
    """Rows (row, lines): for each input row the sorted places of its lines that lie in a later copy."""
    starts = lines.where("ahead > 0").select("row", "doc_id", "at", F.col("ahead").alias("size"))
    ends = lines.where("back > 0").select(
        "row", "doc_id", (F.col("at") - F.col("back") + 1).alias("at"), F.col("back").alias("size")
    )
    runs = written(starts.union(ends).distinct(), "lines-candidates")
    longest = runs.agg(F.max("size")).first()[0] or 0
    ranks, width, found = _ranked(lines.select(*SUFFIX, "id"), ["id"], "lines-rank"), 1, []
    while width <= longest:
        own = runs.where((F.col("size") >= width) & (F.col("size") < 2 * width))
        found.append(_later_runs(own, ranks, width))
        width *= 2
        if width <= longest:
            ranks = _doubled(ranks, width // 2, f"lines-rank-{width}")
    later = found[0] if found else runs.select(*SUFFIX, "size").limit(0)
    for more in found[1:]:
        later = later.union(more)
    covered = later.select("row", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("at"))
    return covered.groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("lines"))


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` without the later copies of repeated line runs of at least ``min_words`` words.

    Returns columns ``doc`` (the given columns, with the new text), ``n_lines`` (lines with a
    word) and ``n_removed``. Lines are compared without white space at their ends; lines without
    a word are never compared and stay. A null or empty text stays as it is. Rows with equal
    ids are told apart by their place in the input, null ids come first; equal rows are copies
    of each other. Other columns are carried along whatever their names.
    """
    rest = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != text]
    rows = numbered(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.struct(*rest).alias("rest")
        ),
        "lines-input", "row",
    )
    lines = written(line_table(rows, min_words), "lines")
    return _rebuilt(rows, repeated_lines(lines), docs.columns, text)


def _rebuilt(rows: DataFrame, removed: DataFrame, columns: list[str], text: str) -> DataFrame:
    """Text put together again from the lines that stay; a text without deletions is passed on."""
    part = lambda i: F.element_at("parts", i + 1)
    every = F.sequence(F.lit(0), F.size("parts") - 1)
    gone = F.transform("lines", lambda k: F.element_at("filled", k + 1))
    kept = F.transform(F.array_except(every, gone), part)
    new = F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    fields = [new.alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in columns]
    return (
        rows.join(removed, "row", "left").withColumn("parts", F.split("text", "\n", -1))
        .withColumn("filled", F.filter(every, lambda i: part(i).rlike(r"[^\x20\x09-\x0D]")))
        .select(
            F.struct(*fields).alias("doc"), F.coalesce(F.size("filled"), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
        )
    )
