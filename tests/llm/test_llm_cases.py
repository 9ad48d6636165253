"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; methods on small data."""

from __future__ import annotations

from collections import Counter, defaultdict
from math import log, log10
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from venuelake.llm import (
    components, jaccard, language_model, licenses, line_dedup, mixing, near_vectors, packing, sharding, topk, toxicity,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{k}" for k in range(30_000))
RUN = " ".join(f"common{k}" for k in range(60))
COLUMNS = "doc_id long, text string, source string, row int, key string, score string, doc string"
ROWS = [
    (1, f"first line\n{RUN}\nlast", "a"), (2, f"other\n{RUN}\n\nend", "a"), (3, None, "b"), (4, "", None),
    (5, LONG, "b"), (5, LONG, "b"), (None, "a b c d e f", "a"), (7, "  \n\t\n", "c"), (8, "a b c d e f", None),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(*r, 1, "k", "s", "d") for r in ROWS], COLUMNS)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (2, 0), (None, 1), (8, None)], "doc_id long, toxic int")


def operators(docs, labels):
    return {
        "pack": packing.pack_documents(docs, TOKENIZER), "jaccard": jaccard.link_documents(docs),
        "lines": line_dedup.dedup_lines(docs), "shards": sharding.assign_shards(docs, limit=1000),
        "model": language_model.score_documents(docs),
        "licences": licenses.scan(docs.withColumn("path", F.concat_ws("/", "source", "doc_id")), "path"),
        "toxicity": toxicity.score_documents(docs, labels), "mix": mixing.mix(docs).documents,
        "mixed": mixing.mixed_documents(docs),
    }


def test_empty_tables(docs, labels):
    for name, result in operators(docs.limit(0), labels.limit(0)).items():
        assert result.count() == 0, name


def test_every_row_has_a_result(docs, labels):
    for name, result in operators(docs, labels).items():
        if name not in ("pack", "mixed"):
            assert result.count() == len(ROWS), name


def test_packing_cases(docs):
    rows = packing.pack_documents(docs, TOKENIZER).collect()
    empty = [r for r in rows if r.doc_id in (3, 4)]
    assert [r.length for r in empty] == [1, 1] and all(r.ids == b"\x02\0\0\0" for r in empty)
    long = [r for r in rows if r.doc_id == 5]
    assert len(long) > 100 and len({r.sequence_id for r in long if r.length == 1024}) == sum(r.length == 1024 for r in long)


def test_genetic_packing_is_valid_and_no_worse_than_best_fit():
    sizes = sorted(np.random.default_rng(1).integers(1, 700, 300).tolist(), reverse=True)
    start = packing.best_fit(list(range(300)), sizes, [], 1024)
    best = packing.evolve(sizes, [start], 1024, 7)
    assert sorted(i for b in best for i in b) == list(range(300))
    assert all(sum(sizes[i] for i in b) <= 1024 for b in best) and len(best) <= len(start)
    assert packing.evolve(sizes, [start], 1024, 7) == best


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_piece_bounds(n):
    bounds = packing.piece_bounds(n, 1024)
    assert sum(x for _, x in bounds) == n and all(x == 1024 for _, x in bounds[1:])


def test_jaccard_cases(docs):
    rows = {(r.doc_id, r.n_shingles): r for r in jaccard.link_documents(docs).collect()}
    assert rows[3, 0].component_id == 3 and rows[4, 0].component_id == 4 and rows[7, 0].component_id == 7
    assert rows[None, 2].component_id == 8 and rows[8, 2].kept and not rows[None, 2].kept
    assert sum(r.kept for r in jaccard.link_documents(docs).collect() if r.doc_id == 5) == 1


@pytest.mark.parametrize("part", [2, 32])
def test_jaccard_of_many_near_copies(spark, monkeypatch, part):
    """Chains of copies with more and more edits, next to copies of another text, through small parts and buckets."""
    monkeypatch.setattr(jaccard, "PART_MEMBERS", part)
    monkeypatch.setattr(jaccard, "PART_QUERIES", 3)
    monkeypatch.setattr(jaccard, "BUCKET_TOKENS", 200)
    rng = np.random.default_rng(3)
    texts = []
    for base in range(6):
        words = [f"t{base}x{k}" for k in range(60)]
        for _ in range(25):
            texts.append(" ".join(words))
            words[rng.integers(0, 60)] = f"e{rng.integers(0, 10**6)}"
    texts += [" ".join(f"t0x{k}" for k in range(60)) + f" tail{k} of its own to it" for k in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    while True:
        new = [
            min(root[b] for b in range(len(sets)) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
            for a in range(len(sets))
        ]
        new = [new[r] for r in new]
        if new == root:
            break
        root = new
    found = {r.doc_id: r.component_id for r in jaccard.link_documents(docs).collect()}
    assert [found[k] for k in range(len(texts))] == root


def test_jaccard_pairs_grow_with_the_documents(spark, monkeypatch):
    """Many copies of a text, each with edits of its own, and texts with one line in common: few pairs that come to nothing."""
    rng = np.random.default_rng(5)
    texts = []
    for k in range(120):
        words = [f"t{j}" for j in range(150)]
        for at in rng.choice(150, k % 9, replace=False):
            words[at] = f"e{rng.integers(0, 10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"line{j}" for j in range(12)) + " " + " ".join(f"u{k}x{j}" for j in range(60)) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    near = [[b for b in range(len(sets)) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])] for a in range(len(sets))]
    root, before = list(range(len(texts))), None
    while root != before:
        before, root = root, [min(root[b] for b in near[a]) for a in range(len(sets))]
    pairs, possible = [], jaccard._possible
    monkeypatch.setattr(jaccard, "_possible", lambda p, *given: pairs.append(p.count()) or possible(p, *given))
    found = {r.doc_id: r.component_id for r in jaccard.link_documents(docs).collect()}
    assert [found[k] for k in range(len(texts))] == root
    assert sum(pairs) < 4 * len(texts)


def test_jaccard_asks_parts_not_pairs():
    """Many classes alike but in no group: rows follow the classes and the parts they ask, with all that a pair shares counted."""
    classes, tokens = np.arange(96), np.arange(40, dtype=np.int64) * 7919
    token, cls = np.repeat(tokens, 96), np.tile(classes, 40)
    bucket = pa.table({
        "token": token, "cls": cls, "size": np.full(len(cls), 100, np.int32), "grp": cls, "several": np.full(len(cls), 40),
        "last": np.ones(len(cls), np.int64), "members": np.ones(len(cls), np.int64), "part": cls // 32,
    })
    asked = jaccard._asked(bucket, 75).to_pylist()
    assert len(asked) <= 96 * 3 and {r["shared"] for r in asked} == {40}
    # Every pair is asked by one of both, and 86 of 100 tokens in common need 12 among the first, as 74 may follow.
    assert {(a, b) for a in range(96) for b in range(3) if any(c > a for c in range(32 * b, 32 * b + 32))} == {
        (r["cls"], r["part"]) for r in asked
    }
    assert {r["need"] for r in asked} == {86 - 74}


def test_jaccard_tokens_of_copies_share_a_place():
    """Tokens that the same class leads meet in one bucket, so a pair of its copies is counted there once."""
    token = np.repeat(np.arange(30, dtype=np.uint64) * np.uint64(7919), 20)
    cls, usual = np.tile(np.arange(20), 30), np.tile(np.arange(20, dtype=np.uint16), 30)
    bucket = {"token": token, "cls": cls, "size": np.full(600, 100, np.int32), "usual": usual}
    table = pa.table({name: pa.array([column.tobytes()], pa.binary()) for name, column in bucket.items()})
    places = [r["place"] for r in jaccard._shared(table, 75).to_pylist() if r["token"] is not None]
    assert len(places) == 600 and len(set(places)) == 1


def test_model_keeps_no_more_than_scores_need(spark, monkeypatch):
    """When texts are scored, the sequences' counts and contexts are off the disk, and the sums meet the tree in shares."""
    docs = spark.createDataFrame([(k, f"a b c d e{k % 3} a b c") for k in range(40)], "doc_id long, text string")
    made, write = defaultdict(list), language_model.written
    monkeypatch.setattr(language_model, "written", lambda df, name: made[name].append(write(df, name)) or made[name][-1])
    assert language_model.score_documents(docs).where("score < 0").count() == 40
    there = lambda table: all(Path(urlparse(f).path).exists() for f in table.inputFiles())
    assert not any(there(t) for name in ("model-level", "model-pairs") for t in made[name])
    assert len(made["model-sums"]) > 1 and there(made["model-nodes"][0])


@pytest.mark.parametrize("hot", [4, 20])
def test_jaccard_of_hot_tokens(spark, monkeypatch, hot):
    """A token of many documents meets no single task, and groups are those found with all in one."""
    rng = np.random.default_rng(8)
    base = [f"t{k}" for k in range(60)]
    texts = []
    for k in range(60):
        words = base[: 60 - k % 25]
        words[rng.integers(0, len(words))] = f"e{k}"
        texts.append(" ".join(words))
    texts += [texts[0]] * 15 + [" ".join(base[:8] + [f"u{k}x{j}" for j in range(20 + k)]) for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = lambda: {r.doc_id: r.component_id for r in jaccard.link_documents(docs).collect()}
    expected, longest = found(), []
    monkeypatch.setattr(jaccard, "HOT_TOKENS", hot, raising=False)
    dealt = jaccard._dealt
    monkeypatch.setattr(jaccard, "_dealt", lambda *given: longest.append(
        [np.unique(np.frombuffer(b"".join(tokens), np.int64), return_counts=True)[1].max(initial=0)
         for tokens in dealt(*given).groupBy("bucket").agg(F.collect_list("token").alias("t")).toPandas()["t"]]
    ) or dealt(*given))
    assert found() == expected and max(longest[0]) <= hot


def test_jaccard_sets_are_joined_on_the_cluster(spark, docs, monkeypatch):
    """The classes whose sets are fetched never come to the driver."""
    rows, texts = docs.select("text"), [ROWS[0][1]]
    sets = [jaccard.token_set(jaccard.word_hashes(pa.array([t]))[0]) for t in texts]
    needed = spark.createDataFrame([(jaccard.digest(s),) for s in sets], "cls long")
    monkeypatch.setattr(type(needed), "toArrow", None)
    monkeypatch.setattr(type(needed), "collect", None)
    found = jaccard._token_sets(rows, needed)
    monkeypatch.undo()
    assert [(r.cls, r.tokens) for r in found.collect()] == [(jaccard.digest(s), s.view(np.int64).tolist()) for s in sets]


def test_line_cases(docs):
    rows = line_dedup.dedup_lines(docs).collect()
    by_id = {r.doc.doc_id: r for r in rows if r.doc.doc_id not in (5,)}
    assert by_id[1].doc.text == ROWS[0][1] and by_id[2].doc.text == "other\n\nend"
    assert by_id[3].doc.text is None and by_id[4].doc.text == "" and by_id[7].doc.text == "  \n\t\n"
    assert sorted((r.n_removed, r.doc.text == LONG) for r in rows if r.doc.doc_id == 5) == [(0, True), (1, False)]
    assert rows[0].doc.asDict().keys() == set(docs.columns)


def test_lines_of_a_run_over_many_lines(spark):
    short = [f"w{k} x{k}" for k in range(40)]
    docs = spark.createDataFrame(
        [(1, "\n".join(["a", *short, "b"])), (2, "\n".join(["c", *short[5:], "d"])), (3, "\n".join(short[:20]))],
        "doc_id long, text string",
    )
    rows = {r.doc.doc_id: r.doc.text for r in line_dedup.dedup_lines(docs).collect()}
    assert rows[1].count("\n") == 41 and rows[2] == "c\nd" and rows[3] == "\n".join(short[:20])


def test_shards_keep_their_limit(docs):
    rows = sharding.assign_shards(docs.where("doc_id <> 5"), limit=500).collect()
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r.bytes)
    assert all(sum(b) <= 500 or len(b) == 1 for b in shards.values())
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))


def test_shards_of_one_repeated_id(spark):
    docs = spark.range(200).selectExpr("1L as doc_id", "repeat('x', 100) as text")
    rows = sharding.assign_shards(docs, limit=1000).collect()
    assert len(rows) == 200 and max(r.shard_bytes for r in rows) <= 1000


def test_write_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), limit=1000)
    assert spark.read.parquet(str(tmp_path / "out")).select(*docs.columns).exceptAll(docs).count() == 0


def test_language_model_is_a_distribution(spark):
    """After every state the probabilities of all words and of the unseen sum up to one."""
    docs = spark.createDataFrame([("a b c a b d " * 20,), ("a b c x",), ("c a y",)], "text string")
    tree, _ = language_model.learn(docs.withColumn("text", F.trim("text")))
    root = {int(c): (n - tree.discount) / tree.tokens for c, n in enumerate(tree.counts[np.isin(tree.words, tree.symbols)])}
    single = {s: 10**a for s, a in zip(tree.states.tolist(), tree.state_logs.tolist()) if s < 1 << 20}
    assert single
    for state, alpha in single.items():
        entries = {e & 0xFFFFF: 10**p for e, p in zip(tree.entries.tolist(), tree.entry_logs.tolist()) if e >> 20 == state}
        rest = 1 - sum(root[x - 1] for x in entries)
        assert sum(entries.values()) + alpha * rest == pytest.approx(1)


@pytest.mark.parametrize("past", ["", "a", "zz a", "c a", "a b"])
def test_language_model_scores_are_a_distribution(spark, past):
    """At the start of a text, after a rare word and after known contexts, over all words and what is left for the unseen."""
    docs = spark.createDataFrame([("a b c a b d " * 20,), ("a b c x",), ("c a y",)], "text string")
    tree, _ = language_model.learn(docs)

    def in_place(text):
        tokens, bounds = language_model.tokens_of(pa.array([text]))
        return language_model._in_place(tree, tokens, language_model._coded(tree.symbols, tokens, bounds))

    nexts = ["a", "b", "c", "d", "x", "y", "unseen"]
    total = 0.0
    for word in nexts:
        place, log = in_place(f"{past} {word}")
        unseen = np.log10(tree.discount * tree.types / tree.tokens)
        total += 10 ** (log[-2] + (unseen if place[-2] < 0 else 0))
    _, log = in_place(past)
    assert total + 10 ** log[-1] == pytest.approx(1)


def test_language_model_does_not_depend_on_what_tasks_hold(spark, monkeypatch):
    """Scores are the same with all sequences in place, some, and none but joined."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in np.minimum(rng.zipf(1.5, 40), 30)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0], "w1", "", "w99 w1 w2"])), "doc_id long, text string")
    found = []
    for looked_up, held in ((1e-6, 1e-5), (1e-6, 0.01), (0.01, 0.02), (0.5, 0.5)):
        monkeypatch.setattr(language_model, "LOOKUP_SHARE", looked_up)
        monkeypatch.setattr(language_model, "STATE_SHARE", held)
        found.append({r.doc_id: r.score for r in language_model.score_documents(docs).collect()})
    assert all(scores == pytest.approx(found[0]) for scores in found[1:])


def test_licence_inheritance(spark):
    rows = [
        ("r/LICENSE", "Released under the MIT License."), ("r/a/x", "text of its own"), ("r/b/LICENSE", "All rights reserved."),
        ("r/b/c/y", "more text"), ("q/z", "nothing"), ("r/b/own", "Licensed under CC BY 4.0.\n" + "long text " * 50), (None, None),
    ]
    docs = spark.createDataFrame(rows, "path string, text string").withColumn("doc_id", F.col("path"))
    found = {r.path: (r.licence, r.inherited, r.inherited_from) for r in licenses.scan(docs, "path").collect()}
    assert found["r/a/x"] == (None, "MIT", "r") and found["r/b/c/y"] == (None, "proprietary", "r/b")
    assert found["q/z"] == (None, None, None) == found[None] and found["r/b/own"] == ("CC-BY-4.0", None, None)


def test_licence_wrapped_embedded_and_full(spark):
    from venuelake.llm.licence_texts import TEXTS

    code = "x = compute(a, b)\n" * 60
    bsd = ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided "
           "that the following\n# conditions are met:\n")
    rows = [
        ("a/wrapped", "# Copyright 2020 A. All rights reserved.\n" + bsd + code),
        ("a/embedded", "This tool came later. Licensed under the MIT License. It was written by two people in spring.\n" + code),
        ("a/none", code), ("m/LICENSE", "MIT License\n\nCopyright (c) 2021 Somebody\n\n" + TEXTS["MIT"]), ("m/s/x", code),
        ("g/COPYING", TEXTS["GPL-3.0"]), ("g/y", code), ("b/LICENSE", "Copyright (c) 2021 B\n" + TEXTS["BSD-3-Clause"]), ("b/z", code),
        ("p/LICENSE", TEXTS["Apache-2.0"]), ("p/z", code),
    ]
    docs = spark.createDataFrame(rows, "path string, text string").withColumn("doc_id", F.col("path"))
    found = {r.path: r for r in licenses.scan(docs, "path").collect()}
    assert found["a/wrapped"].licence == "BSD-3-Clause" and found["a/wrapped"].n_notices == 2
    assert found["a/embedded"].licence == "MIT" and found["a/none"].licence is None is found["a/none"].inherited
    inherited = {"m/s/x": "MIT", "g/y": "GPL-3.0", "b/z": "BSD-3-Clause", "p/z": "Apache-2.0"}
    assert {k: found[k].inherited for k in inherited} == inherited


def test_toxic_grammar():
    scorer = toxicity.Scorer({"fool": 3.0, "idio*": 2.0})

    def outcome(text):
        values = scorer.features(text)
        return {name for name, v in zip(toxicity.OUTCOMES, values) if v}

    assert outcome("What a fool!") == {"insult"} and outcome("idiots everywhere") == {"insult"}
    assert outcome("you are a fool") == {"targeted"} and outcome("no, you are not a fool") == {"negated"}
    assert outcome("He said you are a fool") == {"reported"} and outcome("He said so. A fool!") == {"insult"}
    assert outcome("I will kill you") == {"threat"} and outcome("kill the process") == set() == outcome("")


def test_mixing_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 500), ("e", 0)], "source string, source_size long")
    rows = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert sum(rows.values()) == pytest.approx(1610) and rows["a"] == 30 and rows["c"] == 300 and rows["e"] == 0
    assert rows["b"] / 2 == pytest.approx(rows[None] / 2)


def test_mixing_takes_its_targets(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then 'a' when id % 10 = 1 then null else concat('s', id % 5) end as source",
        "repeat('w ', cast(id % 50 as int)) as text",
    )
    documents, positions = mixing.mix(docs)
    for r in documents.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r.taken - r.target) <= 50
    taken = documents.agg(F.sum("passes")).first()[0]
    assert sorted(r.position for r in positions.collect()) == list(range(taken))
    assert documents.agg(F.max("passes")).first()[0] <= 3


VECTORS = [
    (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.99, 0.01]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]),
    (7, [0.0, 2.0]), (None, [1.0, 0.0]), (20, [float("inf"), 0.0]), (40, [0.5, 0.5]),
]


@pytest.fixture
def vectors(spark):
    return spark.createDataFrame([(*v, 1) for v in VECTORS], "vec_id long, embedding array<double>, row int")


def test_vector_cases(vectors):
    rows = near_vectors.near_duplicates(vectors).collect()
    found = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in rows)
    assert len(rows) == len(VECTORS)
    assert found[:4] == [(-1, 3, 1, None), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False)]
    assert all(n == 0 and i == c for i, n, c, _ in found[4:])
    assert near_vectors.near_duplicates(vectors.limit(0)).count() == 0


def test_many_near_vectors_in_small_blocks(spark, monkeypatch):
    """A tight cluster far larger than blocks and leaves, among others: counts and components as by brute force."""
    monkeypatch.setattr(near_vectors, "LEAF_ROWS", 30)
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(32)
    x = np.vstack([centre + 0.03 * rng.standard_normal((150, 32)), rng.standard_normal((250, 32))])
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = near_vectors.near_duplicates(table, block_rows=40, split_rows=60).toPandas().sort_values("vec_id")
    units = x / np.linalg.norm(x, axis=1)[:, None]
    links = (units @ units.T >= 0.95).sum(1) - 1
    assert (rows["n_links"].to_numpy() <= links).all() and rows["n_links"].sum() >= 0.9 * links.sum()
    assert (rows["component_id"].to_numpy() == np.where(np.arange(400) < 150, 0, np.arange(400))).all()


def test_top_k_cases(vectors):
    rows = topk.top_k(vectors, "vec_id % 20 = 0").collect()
    assert {r.query_id for r in rows} == {40} and len(rows) == 6
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(rows, key=lambda r: r["rank"])] == [
        (1, 4 + 3, 32 * 128), (2, 1, 32 * 64), (3, 1, 32 * 64), (4, None, 32 * 64), (5, 2, 32 * 63), (6, 4, 0)
    ]
    assert topk.top_k(vectors.limit(0), "vec_id % 20 = 0").count() == 0


def test_bounds_stop_reading_and_lose_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    values, queries = np.floor(64 * rng.standard_normal((2, 500, 16)) / 4)
    exact = queries @ values.T
    least = np.sort(exact, axis=1)[:, -10]
    at, candidate, scores = topk.nra(topk.Tile(values), queries, least, {})
    assert set(zip(at, candidate)) == set(zip(*np.nonzero(exact >= least[:, None]))) and (scores == exact[at, candidate]).all()


def test_components(spark):
    rng = np.random.default_rng(9)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(5, None)]
    root = {n: n for link in links for n in link if n is not None and link[1] is not None and link[0] != link[1]}
    for _ in range(60):
        for a, b in links[:-1]:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    rows = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == root and len(rows) == len(root)


def _brute_force_scores(texts, trained):
    """Scores by dictionaries of all sequences of up to three tokens; None is a text's end."""
    texts = [(*text.lower().split(), None) for text in texts]
    counts = [Counter(), Counter(), Counter()]
    for text, learnt in zip(texts, trained):
        for size in (1, 2, 3) if learnt else ():
            counts[size - 1].update(text[k : k + size] for k in range(len(text) - size + 1))
    total, times = counts[0].total(), Counter(counts[0].values())
    discount = times[1] / (times[1] + 2 * times[2]) if times[2] else 0.5
    root = {w: (n - discount) / total for w, n in counts[0].items()}
    probabilities, weights, below = {}, {}, {w: root[w] for w, n in counts[0].items() if n >= 2}
    for size in (2, 3):
        after = defaultdict(list)
        for sequence, n in counts[size - 1].items():
            if n >= 2:
                after[sequence[:-1]].append((sequence, (n + 10 * below[sequence[1:]]) / (counts[size - 2][sequence[:-1]] + 10)))
        level = {}
        for context, entries in after.items():
            p = sum(here for _, here in entries), sum(below[s[1:]] for s, _ in entries)
            rest = [max(1e-9, 1 - x) for x in p]
            gain = sum(here * log(here / below[s[1:]]) for s, here in entries) + rest[0] * log(rest[0] / rest[1])
            if gain >= 0.01:
                weights[context] = rest[0] / rest[1]
            level |= {s: here if gain >= 0.01 else below[s[1:]] for s, here in entries}
        probabilities, below = probabilities | level, level
    for text in texts:
        score = 0.0
        for k, token in enumerate(text):
            p = root.get((token,), (1 - discount) / total)
            for context in (text[max(0, k - size) : k] for size in (1, 2) if k >= size):
                if context in weights:
                    p = probabilities.get((*context, token), p * weights[context])
            score += log10(p)
        yield score


@pytest.mark.parametrize("held", [1e-5, 0.02])
def test_scores_are_those_of_a_tree_by_brute_force(spark, monkeypatch, held):
    """Every score, whether the tasks hold the tree or it is joined."""
    monkeypatch.setattr(language_model, "STATE_SHARE", held)
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{k}" for k in np.minimum(rng.zipf(1.4, rng.integers(1, 60)), 200)) for _ in range(150)]
    texts += ["", "never seen words", texts[3], texts[3], " ".join(["w1 w2"] * 200)]
    rows = language_model.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    rows.sort(key=lambda r: r.doc_id)
    expected = list(_brute_force_scores(texts, [not r.held_out for r in rows]))
    assert [r.score for r in rows] == pytest.approx(expected)


def test_invented_words_score_no_better_than_known_ones(spark):
    """A text of words nobody wrote is less likely than one of words seen once, and one more such word costs the same."""
    texts = [f"common words of the text come often again {k} rare{k}" for k in range(300)]
    texts += [" ".join(f"invented{k}q{j}" for j in range(20)) for k in range(40)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in language_model.score_documents(docs).collect()}
    held = [r for r in rows.values() if r.held_out]
    known = [r.score / r.n_tokens for r in held if r.doc_id < 300]
    made_up = [r.score / r.n_tokens for r in held if r.doc_id >= 300]
    assert known and made_up and max(made_up) < min(known)
    assert all(r.score <= r.n_tokens * np.log10(1 / r.train_tokens) * 0.8 for r in held if r.doc_id >= 300)


@pytest.mark.parametrize("bits", [15, 16, 20])
def test_sketch_keeps_every_node(spark, bits):
    keys = np.random.default_rng(bits).integers(-(1 << 63), 1 << 63, 3000)
    nodes = spark.createDataFrame([(int(k), 1.0) for k in keys[:2000]], "key long, value double")
    kept = language_model._maybe(language_model.node_sketch(nodes, bits), bits, keys.view(np.uint64))
    assert kept[:2000].all() and kept[2000:].mean() < 2.5 * 2000 / (1 << bits) + 0.01
