"""Quality rules by cross-document line frequency, in DataFrame functions.

Lines are normalised and hashed, the distinct documents of each line are counted per host, and
lines above the limits are boilerplate of that host. A document is judged by the words that are
left without them. Texts are scanned once; only digests and counts are shuffled.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake.llm.mixing import WORD
from venuelake.llm.tables import written
from venuelake.operators import skew

#: A line is boilerplate of a host if it is in at least ``MIN_DOCS`` of its documents and in
#: at least ``PER_MILLE`` of 1,000 of them.
MIN_DOCS = 5
PER_MILLE = 5
#: A document is depleted if less than this percentage of its words is left.
LEFT_PERCENT = 50
MIN_WORDS = 50
#: More than this percentage of words in repeated windows of three fails a document.
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_SPACES = r"[\x20\x09-\x0D]+"
_SEPARATORS = " \t\n\x0b\x0c\r"
_PLACE = (1 << 31) - 1


def line_words(line: Column) -> Column:
    """The words of a line that has one."""
    return F.split(F.btrim(line, F.lit(_SEPARATORS)), _SPACES)


def normalised(words: Column) -> Column:
    """The words with one space between, A-Z as a-z and each digit as 0."""
    joined = F.array_join(words, " ")
    return F.translate(joined, string.ascii_uppercase + string.digits, string.ascii_lowercase + "0" * 10)


def line_id(words: Column) -> Column:
    return F.unhex(F.md5(normalised(words)))


def _beside(sorted_array: str, same) -> Column:
    """The elements of a sorted array that equal a neighbour by ``same``."""

    def repeated(x: Column, at: Column) -> Column:
        before, after = F.get(sorted_array, at - 1), F.get(sorted_array, at + 1)
        return F.coalesce(same(x, before), F.lit(False)) | F.coalesce(same(x, after), F.lit(False))

    return F.filter(sorted_array, repeated)


def repeat_words(df: DataFrame) -> DataFrame:
    """``df`` with ``n_repeat_words``: words of ``words`` that lie in a window of three found twice.

    Windows are sorted by a 32-bit hash and their place, in one array of numbers; those whose
    hash has company are compared word by word.
    """
    word = lambda at: F.get("words", at)
    places = F.when(F.size("words") >= 3, F.sequence(F.lit(0), F.size("words") - 3)).otherwise(F.array().cast("array<int>"))
    number = F.transform(
        places,
        lambda k: F.shiftleft(F.hash(word(k), word(k + 1), word(k + 2)).cast("long"), 32).bitwiseOR(k.cast("long")),
    )
    window = lambda k: F.struct(
        word(k).alias("a"), word(k + 1).alias("b"), word(k + 2).alias("c"), k.alias("at")
    )
    same = lambda x, y: (x.a == y.a) & (x.b == y.b) & (x.c == y.c)
    starts = df.withColumn("numbers", number).withColumn("numbers", F.sort_array("numbers"))
    likely = starts.withColumn("numbers", _beside("numbers", lambda x, y: F.shiftright(x, 32) == F.shiftright(y, 32)))
    windows = likely.withColumn(
        "windows",
        F.sort_array(F.transform("numbers", lambda x: window(x.bitwiseAND(F.lit(_PLACE)).cast("int")))),
    ).drop("numbers")
    found = windows.withColumn("windows", F.transform(_beside("windows", same), lambda x: x.at))
    following = [F.transform("windows", lambda x: x + 1), F.transform("windows", lambda x: x + 2)]
    covered = F.array_distinct(F.concat("windows", *following))
    return found.withColumn("n_repeat_words", F.size(covered).cast("long")).drop("windows")


def measured(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """One row per document with its counts and its lines; no text.

    ``lines`` has a struct (id, words, first) for each line with a word: digest of the normalised
    line, its words, and whether it is the document's first line of that digest. ``host`` tells a
    null host from an empty one. Written, with a number per row.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(f"`{host}`")), F.lit("")).alias("host"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    split = rows.select(
        "doc_id", "host", F.unhex(F.md5("text")).alias("digest"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
    )
    worded = split.withColumn("line_words", F.transform("lines", line_words)).withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    ).drop("lines")
    named = worded.withColumn("words", F.flatten("line_words")).withColumn(
        "lines", F.transform("line_words", lambda x: F.struct(normalised(x).alias("line"), F.size(x).alias("words")))
    ).drop("line_words")
    chars = F.aggregate("lines", F.lit(0).cast("long"), lambda total, x: total + F.length(x.line) - x.words + 1)
    line = lambda x: F.struct(F.unhex(F.md5(x.line)).alias("id"), x.words.alias("words"))
    hashed = repeat_words(named).select(
        "doc_id", "host", "digest", F.size("words").cast("long").alias("n_words"), chars.alias("word_chars"), "n_symbols",
        "n_dup_lines", "n_repeat_words", F.sort_array(F.transform("lines", line)).alias("lines"),
    )
    flagged = F.transform(
        "lines",
        lambda x, at: F.struct(
            x.id.alias("id"), x.words.alias("words"), F.coalesce(F.get("lines", at - 1).id != x.id, F.lit(True)).alias("first")
        ),
    )
    return written(hashed.withColumn("lines", flagged).withColumn("row", F.monotonically_increasing_id()), "quality-documents")


def boilerplate(rows: DataFrame, min_docs: int = MIN_DOCS, per_mille: int = PER_MILLE) -> DataFrame:
    """Rows (host, id, docs) of the lines of ``measured`` that are above the limits of their host."""
    lines = rows.select("host", F.explode("lines").alias("line")).where("line.first").select("host", "line.id")
    docs = lines.groupBy("host", "id").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs)
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    above = docs.join(hosts, "host").where(1000 * F.col("docs") >= per_mille * F.col("host_docs"))
    return written(above.select("host", "id", "docs"), "quality-boilerplate")


def _removed(rows: DataFrame, common: DataFrame) -> DataFrame:
    """Rows (row, lines, words): how many lines of a document are boilerplate, and their words."""
    lines = rows.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.id", "line.words")
    hot = common.where(F.col("docs") > skew.HOT_ROWS).orderBy(F.desc("docs")).limit(skew.HOT_SHARE).select(
        "host", "id", F.ceil(F.col("docs") / skew.TASK_ROWS).alias("_parts")
    )
    gone = skew.skew_join(lines, common.select("host", "id"), ["host", "id"], hot=hot.collect())
    return gone.groupBy("row").agg(F.count(F.lit(1)).alias("lines"), F.sum("words").alias("words"))


def judged(rows: DataFrame, common: DataFrame, left_percent: int = LEFT_PERCENT) -> DataFrame:
    """The documents of ``measured`` without their lines, with counts, ``base_failed`` and ``kept``."""
    gone = _removed(rows, common).withColumnRenamed("lines", "n_common_lines").withColumnRenamed("words", "gone")
    known = rows.drop("lines").join(gone, "row", "left").withColumn(
        "n_common_lines", F.coalesce("n_common_lines", F.lit(0)).cast("long")
    ).withColumn("n_left_words", F.col("n_words") - F.coalesce("gone", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    depleted = 100 * F.col("n_left_words") < left_percent * F.col("n_words")
    return known.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted).drop("gone")


def judge_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", min_docs: int = MIN_DOCS,
    per_mille: int = PER_MILLE, left_percent: int = LEFT_PERCENT,
) -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_common_lines, n_left_words, base_failed, kept).

    A null text is empty: no words, so it fails. A null host is a host of its own. Every row is a
    document, so repeated rows and equal ids count for themselves, and a text copied often enough
    on a host is boilerplate there. Lines without a word are never compared. Long texts are
    sorted in arrays of numbers, in time n log n. Other columns are not read, no rows give none.
    """
    rows = measured(docs, doc_id, text, host)
    return judged(rows, boilerplate(rows, min_docs, per_mille), left_percent).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_common_lines",
        "n_left_words", "base_failed", "kept",
    )


def clean_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", min_docs: int = MIN_DOCS,
    per_mille: int = PER_MILLE, left_percent: int = LEFT_PERCENT,
) -> DataFrame:
    """The documents that ``judge_documents`` keeps, their boilerplate lines removed; columns as given.

    What goes depends on the host and the text alone, so rows find it by these two; nothing else
    of them is compared and columns of any name are carried along.
    """
    rows = measured(docs, doc_id, text, host)
    common = boilerplate(rows, min_docs, per_mille)
    lines = rows.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.id")
    gone = skew.skew_join(lines, common.select("host", "id"), ["host", "id"]).groupBy("row").agg(F.collect_set("id").alias("ids"))
    verdict = written(judged(rows, common, left_percent).where("kept").select("row", "host", "digest"), "quality-kept")
    wanted = verdict.join(gone, "row", "left").groupBy("host", "digest").agg(F.any_value("ids").alias("ids"))
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    keyed = docs.select(
        doc, F.coalesce(F.concat(F.lit("="), F.col(f"`{host}`")), F.lit("")).alias("host"),
        F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("digest"),
    )
    own = F.col(f"doc.`{text}`")
    stays = lambda x: ~x.rlike(WORD) | ~F.array_contains("ids", line_id(line_words(x)))
    new = F.when(F.col("ids").isNull(), own).otherwise(F.array_join(F.filter(F.split(own, "\n", -1), stays), "\n"))
    fields = [new.alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    return skew.skew_join(keyed, wanted, ["host", "digest"]).select(*fields)
