"""Prefix trie, filter audit and quality rules against brute force, on hand-made hard cases and in small parts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from itertools import permutations
from math import fmod

import numpy as np
import pytest

from venuelake.llm import filter_audit, prefix_trie, quality
from venuelake.operators import skew

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{k}" for k in range(30_000))
TURNS = "conv_id long, turn long, role string, text string, depth string, next string, id int"


def brute_trie(turns):
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(rows)] for c, rows in own.items()}
    paths = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - int(fmod(c, 20)), [])[:h] + rows[h:])
    members, ends = {}, {}
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members.setdefault(paths[c][:d], []).append(c)
        ends.setdefault(paths[c], []).append(str(c))
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, own_members in members.items():
        words = len(WORD.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(own_members) - 1) * words
    return {
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(ends.get(p, [])).encode()).hexdigest())
        for p, m in members.items()
    }


def found_trie(spark, turns):
    rows = prefix_trie.conversation_trie(spark.createDataFrame([(*t, "x", "y", 1) for t in turns], TURNS)).collect()
    assert sorted(r.enter for r in rows) == sorted({r.enter for r in rows})
    return {tuple(r)[:-1] for r in rows}


def test_trie_cases(spark):
    turns = [
        (0, 0, "user", "a b"), (0, 1, "bot", "c"), (0, 2, "user", "d e f"), (1, 0, "user", "a b"), (1, None, None, None),
        (1, 0, "user", "a b"), (2, 5, "user", LONG), (3, 0, "x", ""), (5, 1, "user", "a b"), (None, 0, "user", "lost"),
        (25, 0, "user", "no base"), (26, 0, "user", "no base"), (40, None, "user", "b"), (40, None, "user", "a"),
        (41, 0, "u", "s"), (41, 0, "u", "s"), (-3, 0, "user", "a b"), (-3, 1, "bot", "c"), (0, 3, "us", "er"),
    ] + [(k, j, "user", f"t{k % 3} {j}") for k in range(60, 100) for j in range(k % 6)]
    assert found_trie(spark, turns) == brute_trie(turns)


def test_trie_of_long_and_many_equal_conversations(spark, monkeypatch):
    """One conversation of very many turns, one repeated by hundreds, and a first turn with hundreds of followers."""
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    monkeypatch.setattr(skew, "TASK_ROWS", 20)
    turns = [(7, k, "user", f"w{k % 5}") for k in range(700)]
    turns += [(1000 + k, j, "user", f"same {j}") for k in range(200) for j in range(3)]
    turns += [(3000 + k, j, "bot", "first" if j == 0 else f"{k} own {j}") for k in range(300) for j in range(2)]
    assert found_trie(spark, turns) == brute_trie(turns)


def test_trie_of_no_turns(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b", "", "", 1)], TURNS)).count() == 0


def brute_audit(docs, labels):
    first, out = {}, Counter()
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    parts = {lang or "" for _, _, lang in docs}
    for doc_id, text, lang in docs:
        text, words = text or "", WORD.findall(text or "")
        bad = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and text in first and doc_id > first[text],
        }
        for order in permutations("ABCDE"):
            gone = False
            for step, x in enumerate(order, 1):
                key = (lang or "", "".join(order), step)
                removed = bad[x] and not gone
                out[*key, "removed"] += removed
                out[*key, "redundant"] += bad[x] and gone
                out[*key, "unique"] += bad[x] and sum(bad.values()) == 1
                out[*key, "good"] += removed and doc_id in good
                out[*key, "toxic"] += removed and doc_id in toxic
                out[lang or "", x] += removed
                gone |= bad[x]
                out[*key, "kept"] += not gone
    return {
        (p, o, s, *(out[p, o, s, k] for k in ("kept", "removed", "redundant", "unique", "good", "toxic")), out[p, o[s - 1]])
        for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)
    }


DOCS = "doc_id long, text string, lang string, failed int, part string, digest string, alive string"
PROSE = " ".join(f"word{k}" for k in range(150))


def test_audit_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "BLOCK", 64)
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    monkeypatch.setattr(skew, "TASK_ROWS", 2)
    docs = [
        (1, PROSE, "en"), (2, PROSE, "de"), (2, PROSE, "en"), (1, PROSE, "en"), (None, PROSE, "en"), (3, None, None),
        (4, "", ""), (5, "  \n\t ", "en"), (6, PROSE.upper(), "en"), (7, PROSE + " 5 %", "fr"), (8, "a b " * 90, "fr"),
        (9, "ÄÖÜ Ä" * 50, "de"), (10, LONG, "de"), (11, "x\x0b#\x85y z", "de"), (None, None, None),
    ] + [(20 + k, "short $ A", "en") for k in range(30)]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (6, 1, 1), (7, 1, None), (None, 1, 1), (99, 1, 1), (25, 1, 0)]
    found = filter_audit.audit(
        spark.createDataFrame([(*d, 1, "p", "d", "a") for d in docs], DOCS),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    assert {tuple(r) for r in found.collect()} == brute_audit(docs, labels)
    assert filter_audit.audit(
        spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000])
def test_positional_popcounts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    assert filter_audit.positional_popcounts(words).tolist() == [int((words >> k & 1).sum()) for k in range(32)]


QUALITY = "doc_id long, text string, source string, host string, words int, lines string, row string"


def brute_quality(docs, min_docs, per_mille):
    same = lambda line: " ".join(re.sub("[0-9]", "0", line.translate({c: c + 32 for c in range(65, 91)})).split())
    seen, hosts, out = Counter(), Counter(s for _, _, s in docs), []
    for _, text, source in docs:
        seen.update({(source, same(x)) for x in (text or "").split("\n") if WORD.search(x)})
    for doc_id, text, source in docs:
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        n = lambda x: seen[source, same(x)]
        common = [x for x in lines if n(x) >= min_docs and 1000 * n(x) >= per_mille * hosts[source]]
        left = len(words) - sum(len(WORD.findall(x)) for x in common)
        failed = len(words) < 50 or 2 * len(covered) > len(words)
        out.append((
            doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), len(common), left, failed, not failed and 2 * left >= len(words),
        ))
    return Counter(out)


def quality_docs():
    text = lambda k: f"{PROSE[:400]} own{'x' * k}\n\nSee page {k} of\tTHE list\nmore of {k} # <b>"
    return [(k, text(k), "a") for k in range(40)] + [
        (50, None, "a"), (51, "", None), (52, LONG, "b"), (52, LONG, "b"), (None, "a b c a b c a b c " * 9, None),
        (53, "say it again " * 30 + PROSE, "b"), (54, "x\n \nx\n" + PROSE, ""), (55, "ÄÄ\x85ß é\x1c" * 60, ""), (56, PROSE, None),
    ] + [(60 + k, f"Footer 1{k}\n{PROSE[k:]} {k}" + "\nfooter 20" * 3, "c") for k in range(9)] + [
        (80 + k, "the same old menu of a site " * 9, "c") for k in range(7)
    ]


@pytest.mark.parametrize("limits", [(5, 5), (2, 900), (30, 1)])
def test_quality_against_brute_force(spark, monkeypatch, limits):
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(skew, "TASK_ROWS", 2)
    docs = quality_docs()
    rows = quality.judge_documents(
        spark.createDataFrame([(*d, "h", 1, "l", "r") for d in docs], QUALITY), min_docs=limits[0], per_mille=limits[1]
    )
    assert Counter(tuple(r) for r in rows.collect()) == brute_quality(docs, *limits)


def test_quality_cleaned_texts(spark):
    docs = spark.createDataFrame([(*d, "h", 1, "l", "r") for d in quality_docs()], QUALITY)
    clean = quality.clean_documents(docs)
    texts = {r.doc_id: r.text for r in clean.collect()}
    kept = [r.doc_id for r in quality.judge_documents(docs).where("kept").collect()]
    assert clean.columns == docs.columns and clean.count() == len(kept) and set(texts) == set(kept)
    assert texts[3] == f"{PROSE[:400]} ownxxx\n" and texts[62] == f"{PROSE[2:]} 2" and texts[52] == LONG
    assert quality.clean_documents(docs.limit(0)).count() == 0 and quality.judge_documents(docs.limit(0)).count() == 0
