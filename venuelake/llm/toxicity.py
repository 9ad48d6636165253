"""Toxicity by a weighted finite-state pattern grammar over clauses.

Terms and their weights are learned: words and word beginnings that labelled toxic documents
have significantly more often than the others. A lexicon maps each word of a clause to a
class; transducers for negation, reported speech and targets, composed into one machine,
rewrite an insult to what it amounts to in its clause; threats need a target after them.
A logistic function of the weights of the matched clauses, by outcome, is the score.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from venuelake.llm.tables import id_remainder, written
from venuelake.llm.words import shingle_hashes, word_hashes

#: Labelled documents the model is fitted on: all, or about this many by a digest of the id.
LABELLED_ROWS = 20_000
THRESHOLD = 0.7
#: A term needs this many toxic documents, this log ratio and this G statistic.
MIN_DOCUMENTS, MIN_WEIGHT, MIN_G = 4, 2.0, 16.0
BEGINNINGS = (4, 5, 6)
#: Words after a negation or a target within which they reach an insult.
REACH = 3
MEMO_WORDS = 300_000
STRIP = string.punctuation + "«»„“”¿¡…–—"
CLAUSE_END = (".", "!", "?", ";", ":")

TARGETS = set("you your you're u ur du dich dir ihr euch dein deine tu te toi vous ton ta usted ustedes ti tú vos".split())
NEGATIONS = set("not no never isn't aren't don't nicht kein keine nie pas jamais nunca jamás tampoco".split())
REPORTS = set("said says saying wrote quoted called sagte schrieb nannte dijo dice escribió llamó dit disait écrit appelle".split())
THREATS = set("kill hurt beat destroy shoot töten umbringen schlagen tuer frapper matar golpear".split())
OUTCOMES = ("insult", "targeted", "negated", "reported", "threat")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) to (state, symbol); what is not listed is passed on by ``default``."""

    moves: dict
    default: dict

    def step(self, state, symbol):
        return self.moves.get((state, symbol)) or (self.default[state], symbol)


def within(trigger: str, reach: int, rewrites: dict[str, str]) -> Transducer:
    """For ``reach`` symbols after ``trigger``, symbols are rewritten."""
    moves, default = {}, {0: 0}
    for left in range(reach + 1):
        moves[left, trigger] = (reach, trigger)
        default[left] = max(0, left - 1)
        if left:
            moves |= {(left, old): (left - 1, new) for old, new in rewrites.items()}
    return Transducer(moves, default)


def after(trigger: str, rewrites: dict[str, str]) -> Transducer:
    """From ``trigger`` to the clause's end, symbols are rewritten."""
    return Transducer({(0, trigger): (1, trigger)} | {(1, old): (1, new) for old, new in rewrites.items()}, {0: 0, 1: 1})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The output of ``first`` fed to ``second``."""
    symbols = {s for t in (first, second) for _, s in t.moves} | {o for t in (first, second) for _, o in t.moves.values()}
    moves, default = {}, {}
    for a in first.default:
        for b in second.default:
            default[a, b] = (first.default[a], second.default[b])
            for symbol in symbols:
                state, middle = first.step(a, symbol)
                last, out = second.step(b, middle)
                moves[(a, b), symbol] = ((state, last), out)
    return Transducer(moves, default)


def grammar() -> tuple[Transducer, object]:
    """The composed machine and its start state. Reports outrank negations, these outrank targets."""
    parts = [
        within("target", REACH, {"insult": "targeted"}),
        within("violence", REACH, {"target": "threat"}),
        within("negation", REACH, {"insult": "negated", "targeted": "negated", "violence": "other"}),
        after("report", {"insult": "reported", "targeted": "reported", "negated": "reported", "threat": "reported"}),
    ]
    return reduce(compose, parts), reduce(lambda a, b: (a, b), [0] * len(parts))


def bare(word: str) -> str:
    return word.strip(STRIP)


def terms_of(word: str) -> list[str]:
    """The word and its beginnings, by which it may be in the lexicon."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)] if len(word) >= 3 else []


class Scorer:
    """Outcome weights of a text under a lexicon ``{term: weight}``."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, (self.machine, self.start), self.memo = lexicon, grammar(), {}

    def classed(self, word: str) -> tuple[str, float]:
        """Class and weight of a lower-case word."""
        word = bare(word)
        weights = [self.lexicon[t] for t in terms_of(word) if t in self.lexicon]
        if weights:
            return "insult", max(weights)
        for symbol, words in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS), ("violence", THREATS)):
            if word in words:
                return symbol, 1.0
        return "other", 0.0

    def features(self, text: str) -> list[float]:
        """For each outcome, log(1 + weight of its matches); matches per 100 words; share of clauses with one."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo, total = self.memo, dict.fromkeys(OUTCOMES, 0.0)
        matches = clauses = matched = words = 0
        for line in text.lower().split("\n"):
            tokens = line.split()
            classes = []
            for token in tokens:
                known = memo.get(token)
                if known is None:
                    known = memo[token] = (*self.classed(token), token.endswith(CLAUSE_END))
                classes.append(known)
            words += len(tokens)
            clauses += sum(end for *_, end in classes) + 1
            if not any(symbol in ("insult", "violence") for symbol, _, _ in classes):
                continue
            state, hit = self.start, 0
            for symbol, weight, end in [*classes, ("other", 0.0, True)]:
                state, out = self.machine.step(state, symbol)
                if out in total:
                    total[out] += weight
                    hit += 1
                if end:
                    matches, matched, state, hit = matches + hit, matched + bool(hit), self.start, 0
        return [*(log1p(v) for v in total.values()), 100 * matches / max(1, words), matched / max(1, clauses)]


def _counted(batches: Iterator[pa.RecordBatch], lexicon: set[str] | None) -> Iterator[pa.RecordBatch]:
    """(toxic, text) rows to (term, toxic, documents); only terms of ``lexicon`` if given."""
    counts: Counter = Counter()
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {bare(w) for w in (text or "").lower().split()}
            terms = {t for w in words for t in terms_of(w)}
            counts.update((toxic, t) for t in (terms if lexicon is None else terms & lexicon))
    labels, terms = zip(*counts, strict=True) if counts else ((), ())
    yield pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string()), pa.array(labels, pa.int32()), pa.array(counts.values(), pa.int64())],
        ["term", "toxic", "documents"],
    )


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Weights of the terms that tell toxic documents (toxic int, text) from others."""
    spark = sample.sparkSession
    schema = "term string, toxic int, documents long"
    toxic = sample.where("toxic = 1").mapInArrow(lambda b: _counted(b, None), schema)
    common = toxic.groupBy("term").agg(F.sum("documents").alias("n")).where(F.col("n") >= MIN_DOCUMENTS)
    candidates = {r.term: r.n for r in common.collect()}
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    known = spark.sparkContext.broadcast(set(candidates))
    clean = sample.where("toxic = 0").mapInArrow(lambda b: _counted(b, known.value), schema)
    others = {r.term: r.n for r in clean.groupBy("term").agg(F.sum("documents").alias("n")).collect()}
    size, rest = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = {}
    for term, a in candidates.items():
        b = others.get(term, 0)
        weight = log((a + 0.5) / (size + 1)) - log((b + 0.5) / (rest + 1))
        expected = (a + b) * size / (size + rest)
        g = 2 * (a * log(a / expected) + (b * log(b / (a + b - expected)) if b else 0)) if rest else 0
        if weight >= MIN_WEIGHT and g >= MIN_G:
            lexicon[term] = weight
    return lexicon


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Coefficients, the constant last, by Newton's method with a small ridge penalty."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) rows with the least hash of a run of five words, which near copies mostly share."""
    for batch in batches:
        words, bounds = word_hashes(batch.column(1))
        runs = [shingle_hashes(words[a:b], 5) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        least = np.array([r.min() if len(r) else 0 for r in runs], np.uint64).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], ["toxic", "text", "key"])


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
          rows: int = LABELLED_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """Lexicon and coefficients from the labelled documents that are not held out.

    Of several labels for an id the largest counts; null ids and labels are left out. Without
    labels of both kinds the lexicon is empty and the score the labels' mean, or 0.
    """
    kept = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (id_remainder("doc_id", 3) != 1))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, rows / max(1, kept.count()))
    if share < 1:
        kept = kept.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    labelled = texts.join(F.broadcast(kept), "doc_id").select("toxic", "text")
    keyed = labelled.mapInArrow(_keyed, "toxic int, text string, key long")
    # Copies of one document would make any of its words look telling.
    sample = written(keyed.groupBy("toxic", "key").agg(F.min("text").alias("text")).drop("key"), "toxicity-sample")
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        mean = sizes.get(1, 0) / max(1, sum(sizes.values()))
        return {}, np.array([0.0] * (len(OUTCOMES) + 2) + [log((mean + 1e-6) / (1 - mean + 1e-6))])
    lexicon = learn_lexicon(sample)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches:
            values = [scorer.features(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int32()), pa.array(values, pa.list_(pa.float64()))], ["toxic", "values"]
            )

    # At most ``rows`` short rows.
    fitted = sample.mapInArrow(features, "toxic int, values array<double>").toPandas()
    return lexicon, fit_logistic(np.vstack(fitted["values"]), fitted["toxic"].to_numpy(float))


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    toxic: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``doc`` (the given columns), ``held_out``, ``score`` (0 to 1) and ``predicted`` (0 or 1).

    Every document is scored from its whole text; null and empty texts have no matches. Rows with
    equal or null ids each get their own score; ids play no part in it. Columns of any name are
    carried along. Without documents there are no rows.
    """
    lexicon, weights = learn(docs, labels, doc_id, text, toxic)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            x = np.array([scorer.features(t.as_py() or "") for t in batch.column(1)]).reshape(-1, len(weights) - 1)
            values = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc", "score"])

    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(given, F.col(f"`{text}`").alias("text"))
    scored = rows.mapInArrow(score, StructType([rows.schema["doc"], StructField("score", DoubleType())]))
    return scored.select(
        "doc", (id_remainder(F.col(f"doc.`{doc_id}`").cast("string"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
