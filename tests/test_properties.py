"""Properties over generated inputs, many per Spark job."""

from __future__ import annotations

import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from venuelake.functions import text
from venuelake.operators import mutate

# Literals write these as eight-digit codes, which only the tag characters are read from.
readable = st.characters(exclude_categories=["Cs", "Cn", "Co"]).filter(
    lambda c: ord(c) < 0x10000 or c.isprintable() or 0xE0000 <= ord(c) <= 0xE00FF
)
review = st.fixed_dictionaries(
    {
        "author": st.one_of(st.none(), st.booleans(), st.text(readable, max_size=8)),
        "rating": st.integers(1, 5),
        "text": st.one_of(
            st.text(readable, max_size=40),
            st.lists(st.sampled_from(["'", '"', "\\", "None", "True", ": ", ", ", "{", "}", "\n", "}\n{", "x", "é", "\x00", "\xa0"])).map("".join),
        ),
        "time": st.integers(0, 2_000_000_000),
        "translated": st.booleans(),
    }
)
few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(st.lists(st.lists(review, min_size=1, max_size=4), min_size=40, max_size=80))
def test_literal_records_are_read_back(spark, venues):
    written = [(i, "[" + "\n ".join(map(repr, records)) + "]") for i, records in enumerate(venues)]
    df = spark.createDataFrame(written, "i int, t string")
    got = {r["i"]: r["p"] for r in df.select("i", text.parse_reviews(F.col("t")).alias("p")).collect()}
    for i, records in enumerate(venues):
        assert [tuple(r) for r in got[i]] == [(r["rating"], r["text"], r["time"]) for r in records]


rows = st.dictionaries(st.integers(0, 40), st.integers(), max_size=30)


@few
@given(rows, rows)
def test_upsert_is_a_dictionary_update_and_idempotent(spark, target, source):
    frame = lambda d: spark.createDataFrame([(k, v % 1000) for k, v in d.items()], "k int, v int")
    once = mutate.upsert(frame(target), frame(source), ["k"])
    twice = mutate.upsert(once, frame(source), ["k"])
    expected = {k: v % 1000 for k, v in (target | source).items()}
    for df in (once, twice):
        assert sorted(map(tuple, df.collect())) == sorted(expected.items())


def test_tag_characters():
    assert unicodedata.category("\U000e0067") == "Cf" and repr("\U000e0067") == "'\\U000e0067'"
