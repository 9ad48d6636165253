"""Licence scan: notices and licence files by TF-IDF cosine, then inheritance along directories.

Every line of every whole text, and the text as a whole, is a sparse vector of its words;
the weights are log-damped counts times inverse document frequencies over all documents.
Words that no template has count at the largest weight. So that notices inside a long sentence and
notices wrapped over lines match too, every run of as many words as a template has is compared with it,
wherever one of the template's heaviest words lets it match at all. A document takes the licence of its best
line or run; that all rights are reserved counts only if there is nothing else. One whose whole text matches
a notice or a full licence text, or that largely consists of notices, is a licence file of its directory; documents without a
notice of their own inherit from the nearest directory above them that has such a file.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake.llm.licence_texts import TEXTS
from venuelake.llm.tables import written

#: Notices by licence (fixed values: the usual wordings).
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
                   "in compliance with the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
                  "International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-ShareAlike 4.0 International License."],
    "proprietary": ["All rights reserved."],
}
#: What whole texts are compared with (no full texts of the CC licences, whose notices stand for them).
FILES = {name: [*notices, *([TEXTS[name]] if name in TEXTS else [])] for name, notices in TEMPLATES.items()}
MIN_COSINE = 0.8
#: Share of a document's words in notices from which it is a licence file.
FILE_SHARE = 0.1
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
FOUND = "id {id}, path string, licence string, cosine double, n_notices int, file_licence string, file_cosine double"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


VOCABULARY = frozenset(w for notices in FILES.values() for n in notices for w in words(n))


class Matcher:
    """Cosines of word lists to the templates under given document frequencies."""

    def __init__(self, templates: dict[str, list[str]], frequencies: dict[str, int], documents: int):
        self.unknown = log((1 + documents) / 1) + 1
        self.idf = {
            w: log((1 + documents) / (1 + frequencies.get(w, 0))) + 1
            for notices in templates.values() for n in notices for w in words(n)
        }
        self.vectors = [(name, self.vector(words(n))) for name, notices in sorted(templates.items()) for n in notices]
        self.lengths = [len(words(n)) for _, notices in sorted(templates.items()) for n in notices]
        self.anchors: dict[float, dict[str, list[int]]] = {}
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for at, (_, vector) in enumerate(self.vectors):
            for word, weight in vector.items():
                self.postings.setdefault(word, []).append((at, weight))

    def vector(self, tokens: list[str]) -> dict[str, float]:
        raw = {w: (1 + log(n)) * self.idf.get(w, self.unknown) for w, n in Counter(tokens).items()}
        norm = sqrt(sum(x * x for x in raw.values())) or 1.0
        return {w: x / norm for w, x in raw.items()}

    def best(self, tokens: list[str], least: float) -> tuple[float, str | None]:
        """Largest cosine and its licence, the first by name among equals; 0 and none below ``least``."""
        counts = Counter(tokens)
        inside = sum(((1 + log(n)) * self.idf[w]) ** 2 for w, n in counts.items() if w in self.idf)
        outside = sum((1 + log(n)) ** 2 for w, n in counts.items() if w not in self.idf) * self.unknown**2
        if inside < least * least * (inside + outside) or not inside:
            return 0.0, None  # the part outside the templates' words bounds the cosine
        dots = [0.0] * len(self.vectors)
        for word, weight in self.vector(tokens).items():
            for at, other in self.postings.get(word, ()):
                dots[at] += weight * other
        at = max(range(len(dots)), key=lambda k: (dots[k], -k))
        return (dots[at], self.vectors[at][0]) if dots[at] >= least else (0.0, None)


    def runs(self, tokens: list[str], least: float) -> list[tuple[float, int, int, str]]:
        """(cosine, first word, words, licence) of all runs as long as a template that are as near to it.

        A run without any of the words ``_anchors`` names for a template is too far from it, so only those around
        them are compared.
        """
        found = []
        anchors = self._anchors(least)
        places: dict[int, list[int]] = {}
        if anchors.keys().isdisjoint(tokens):
            return found
        for at, word in enumerate(tokens):
            for template in anchors.get(word, ()):
                places.setdefault(template, []).append(at)
        for template, hits in places.items():
            length, end = min(self.lengths[template], len(tokens)), -1
            for hit in hits:
                first, last = max(hit - length + 1, end + 1, 0), min(hit, len(tokens) - length)
                if first <= last:
                    found += self._slide(template, tokens, first, last, length, least)
                    end = last
        return found

    def _slide(self, template: int, tokens: list[str], first: int, last: int, length: int, least: float) -> list[tuple]:
        """Runs of a template that begin from ``first`` to ``last``, near enough to it."""
        name, vector = self.vectors[template]
        counts: Counter = Counter()
        squares = dot = 0.0
        found = []

        def change(word: str, by: int) -> None:
            nonlocal squares, dot
            n, idf = counts[word], self.idf.get(word, self.unknown)
            old, new = ((1 + log(k)) * idf if k else 0.0 for k in (n, n + by))
            counts[word] = n + by
            squares += new * new - old * old
            dot += (new - old) * vector.get(word, 0.0)

        for word in tokens[first : first + length]:
            change(word, 1)
        for start in range(first, last + 1):
            if dot >= least * sqrt(squares):
                found.append((min(1.0, dot / sqrt(squares)), start, length, name))
            if start < last:
                change(tokens[start], -1)
                change(tokens[start + length], 1)
        return found

    def _anchors(self, least: float) -> dict[str, list[int]]:
        """Templates by word: of each the heaviest words, without all of which no cosine is ``least``."""
        if least not in self.anchors:
            named: dict[str, list[int]] = {}
            for template, (_, vector) in enumerate(self.vectors):
                rest = 1.0
                for word, weight in sorted(vector.items(), key=lambda item: (-item[1], item[0])):
                    if rest < least * least - 1e-9:
                        break
                    rest -= weight * weight
                    named.setdefault(word, []).append(template)
            self.anchors[least] = named
        return self.anchors[least]


def scan_text(matcher: Matcher, files: Matcher, text: str, min_cosine: float, file_share: float) -> tuple:
    """(licence, cosine, notices, file licence, file cosine) of one text; nulls where nothing matches.

    Notices are the lines that match, and of the runs of words outside them the best that do not overlap.
    """
    found, every, covered = [], [], bytearray()
    for line in text.split("\n"):
        tokens = words(line)
        cosine, name = matcher.best(tokens, min_cosine)
        if name:
            found.append((cosine, len(every), len(tokens), name))
        covered += bytes([name is not None]) * len(tokens)
        every += tokens
    count = len(found)
    runs = matcher.runs(every, min_cosine)
    for _, start, length, _ in sorted(runs, key=_rank):
        if not any(covered[start : start + length]):
            count += 1
            covered[start : start + length] = b"\1" * length
    best = min(found + runs, key=_rank, default=(0.0, 0, 0, None))
    best = (best[0], best[3])
    whole = files.best(every, min_cosine)
    if whole[1] is None:
        whole = best if every and sum(covered) >= file_share * len(every) else (0.0, None)
    return best[1], best[0] if best[1] else None, count, whole[1], whole[0] if whole[1] else None


def _rank(notice: tuple[float, int, int, str]) -> tuple:
    """Nearest first, then the longest and the first in the text."""
    cosine, start, length, name = notice
    return name == "proprietary", -round(cosine, 9), -length, start, name


def _frequencies(docs: DataFrame) -> tuple[dict[str, int], int]:
    """In how many documents each template word occurs, and the number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(VOCABULARY.intersection(words(text or "")))
                counts[""] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    # One row per template word.
    rows = docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r.word: r.n for r in rows}
    return found, found.pop("", 0)


def directory(path: Column) -> Column:
    """Of ``a/b/c``: ``a/b``; of a bare name the empty text."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def _above(folder: Column) -> Column:
    """The directory and all above it, nearest first, the root last."""
    parts = F.split(folder, "/")
    whole = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.array_distinct(F.concat(whole, F.array(F.lit(""))))


def inherit(found: DataFrame) -> DataFrame:
    """Rows of ``scan`` with ``inherited`` and the directory it is ``inherited_from``, nearest first.

    Of several licence files in a directory the best match counts, then the first licence and path by name.
    """
    own = found.withColumn("folder", directory(F.col("path")))
    files = own.where("file_licence is not null and path is not null").groupBy("folder").agg(
        F.min_by("file_licence", F.struct(-F.col("file_cosine"), "file_licence", "path")).alias("inherited")
    )
    folders = own.where("path is not null").select("folder").distinct()
    asked = folders.select("folder", F.posexplode(_above(F.col("folder"))).alias("distance", "above"))
    known = files.withColumnRenamed("folder", "above")
    nearest = written(
        asked.join(known, "above").groupBy("folder").agg(F.min_by(F.struct("inherited", "above"), "distance").alias("from")),
        "licence-folders",
    )
    return own.join(nearest, "folder", "left").select(
        "id", "path", "licence", "cosine", "n_notices",
        F.when(F.col("licence").isNull(), F.col("from.inherited")).alias("inherited"),
        F.when(F.col("licence").isNull(), F.col("from.above")).alias("inherited_from"),
    )


def scan(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", min_cosine: float = MIN_COSINE,
         file_share: float = FILE_SHARE) -> DataFrame:
    """Licence of every document: its own (``licence``, ``cosine``, ``n_notices``) or ``inherited``.

    Null and empty texts have no notice but inherit; a null path neither inherits nor passes on. Rows
    are scanned each for itself, so equal rows give equal rows; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(path).cast("string").alias("path"), F.col(text).alias("text"))
    frequencies, documents = _frequencies(rows.select("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, files = (Matcher(t, frequencies, documents) for t in (TEMPLATES, FILES))
        kinds = [pa.string(), pa.float64(), pa.int32(), pa.string(), pa.float64()]
        names = ["licence", "cosine", "n_notices", "file_licence", "file_cosine"]
        for batch in batches:
            results = [scan_text(matcher, files, t.as_py() or "", min_cosine, file_share) for t in batch.column(2)]
            columns = [pa.array([r[k] for r in results], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "path", *names])

    kind = rows.schema["id"].dataType.simpleString()
    return inherit(written(rows.mapInArrow(find, FOUND.format(id=kind)), "licence-scan"))
