"""The operators' queries on given tables: against their SQL, or against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from checks.compare import differences
from venuelake.llm.queries import ORACLES, QUERIES, TOKENIZER

FOLDER = "/root/testdata/sf0.001"
SHARDED = "/root/testdata/sf0.01"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    folder = SHARDED if name.startswith("op5") else FOLDER
    assert differences(QUERIES[name](spark, folder), folder, ORACLES[name]) is None


def test_packing_is_a_round_trip(spark, documents):
    model = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    ids = {d.doc_id: [*model.encode(d.text or "", add_special_tokens=False).ids, 2] for d in documents}
    rows = QUERIES["op1_best_fit_packing"](spark, FOLDER).collect()
    for row in rows:
        part = np.asarray(ids[row.doc_id][row.start : row.start + row.length], "<u4")
        assert 0 < row.length <= 1024 and zlib.crc32(part.tobytes()) == row.ids_crc32
        assert row.piece == 0 or (row.length == 1024 and row.start > 0)
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    places = {}
    for row in rows:
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 1024
    assert len(places) <= -(-sum(map(len, ids.values())) // 1024) + 2


def test_jaccard_against_brute_force(spark, documents):
    sets = {}
    for d in documents:
        own = words(d.text)
        sets[d.doc_id] = {tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = QUERIES["op2_ngram_jaccard_join"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(s), find(i)) for i, s in sets.items()}


def test_language_model(spark, documents):
    train = Counter(
        w for d in documents if zlib.crc32(str(d.doc_id).encode()) % 7 != 2 for w in [*words(d.text), None]
    )
    total, gain = train.total(), 0.0
    for row in QUERIES["op6_suffix_tree_scores"](spark, FOLDER).collect():
        text = next(d.text for d in documents if d.doc_id == row.doc_id)
        own = [*words(text), None]
        base = sum(log10((train[w] + 1) / (total + len(train) + 1)) for w in own)
        assert row.base_score == pytest.approx(base) and row.train_tokens == total and row.score <= 0
        assert (row.n_tokens, row.n_known) == (len(own), sum(train[w] > 0 for w in own))
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 7 == 2)
        gain += (row.score - row.base_score) * row.held_out
    assert gain > 0


def test_near_vectors_against_brute_force(spark):
    rows = QUERIES["op8_embedding_near_dedup"](spark, FOLDER).toPandas().sort_values("vec_id")
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas().sort_values("vec_id")
    units = np.vstack(table["embedding"]).astype(float)
    units /= np.linalg.norm(units, axis=1)[:, None]
    links = (units @ units.T >= 0.95).sum(1) - 1
    assert rows["n_links"].sum() >= 0.9 * links.sum() and (rows["n_links"].to_numpy() <= links).all()


def test_toxicity_held_out(spark):
    """On the rows no label was learned from, hardly a clean document is rejected and most toxic ones are found."""
    scored = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("toxic", "predicted", "score").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    toxic, clean = ([r.predicted for r in rows if r.toxic == k] for k in (1, 0))
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_license_scan_finds_every_notice(spark, documents):
    notices = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "All rights reserved.": "proprietary",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    }
    found = {r.doc_id: r for r in QUERIES["op7_license_scan"](spark, FOLDER).collect()}
    for d in documents:
        expected = {notices[line] for line in (d.text or "").split("\n") if line in notices}
        assert (found[d.doc_id].licence in expected) if expected else (found[d.doc_id].licence is None)
        assert found[d.doc_id].inherited is None or found[d.doc_id].licence is None


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        kept = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and kept <= before and len(kept) > 0.8 * len(before)
        before = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == len(before)
