"""Licence scans: sparse TF-IDF cosine to templates, then inheritance along directories.

Every line, every paragraph and the whole of a text, and every stretch of a text as long as a
template, is compared with licence notices, the usual file headers and full licence texts.
Document frequencies of the templates' terms are counted over all documents; any other word
weighs as much as one that no document holds, so a line of ordinary prose is far from every
template. A file that is a licence as a whole, or is named like one, speaks for its directory,
and a file without a notice of its own takes the licence of its nearest ancestor directory.

Inheritance joins distinct directories, not files, with their ancestors; each join has one row
per key on its other side, which is broadcast where it measures small.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.llm.licence_texts import HEADERS, TEXTS
from reknit.operators.joins import measured
from reknit.session import materialize

# Licences by their SPDX identifiers, with the notices that name them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the software without "
            "restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file "
                   "except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# The line that names a licence by its identifier, with the forms that GNU licences have.
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}{form}")
              for name in sorted({*TEXTS, *(name for name, _ in TEMPLATES)})
              for form in (("", "-only", "-or-later", "+") if "GPL" in name else ("",))]
TEMPLATES += [*HEADERS, *TEXTS.items()]
THRESHOLD = 0.8
# Fixed value: names of files that speak for their directory, in any case, before any ending.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"

_MARKS = b".,;:()[]{}<>\"'*/#!&$%|-"


def terms_of(line: bytes) -> list[bytes]:
    """The words of a line, A-Z in lower case, without marks around them."""
    return [word for word in (word.strip(_MARKS) for word in line.lower().split()) if word]


@dataclass
class Templates:
    """Weighted template vectors over their own vocabulary."""

    names: list[str]
    vectors: list[dict[bytes, float]]
    weights: dict[bytes, float]
    other: float
    threshold: float
    sizes: list[int]

    def __post_init__(self) -> None:
        """What the search may leave out, by the threshold t: a match holds t² of a template's
        squares, so it has at least ``needs`` distinct terms and one of the ``anchors``, the
        heaviest terms that make more than 1 - t² of them."""
        enough = self.threshold**2 - 1e-9
        self.needs, self.anchors = [], {}
        for k, vector in enumerate(self.vectors):
            held, need = 0.0, 0
            for term, w in sorted(vector.items(), key=lambda pair: (-pair[1], pair[0])):
                if held <= 1 - enough:
                    self.anchors.setdefault(term, []).append(k)
                if held < enough:
                    need += 1
                held += w * w
            self.needs.append(need)
        self.ranks = sorted(set(self.needs))
        self.known = [frozenset(t for need, vector in zip(self.needs, self.vectors) if need <= rank
                                for t in vector) for rank in self.ranks]

    def matches(self, counts: Counter, outside: int) -> dict[str, float]:
        """Licences whose cosine reaches the threshold; ``outside``: squares of other words."""
        own = {term: n * self.weights[term] for term, n in counts.items()}
        length = math.sqrt(sum(w * w for w in own.values()) + outside * self.other**2)
        found: dict[str, float] = {}
        for name, vector, need in zip(self.names, self.vectors, self.needs):
            if need > len(own):
                continue
            cosine = sum(w * vector[t] for t, w in own.items() if t in vector) / length
            if cosine >= self.threshold and cosine > found.get(name, 0):
                found[name] = cosine
        return found

    def scan(self, words: list[bytes]) -> dict[str, float]:
        counts = Counter(words)
        rank = bisect_right(self.ranks, len(counts))
        if not rank:
            return {}
        # A cosine is at most the part of the length that lies in words of templates that can
        # be reached at all: most lines end here.
        known, weights, other = self.known[rank - 1], self.weights, self.other
        inside = total = 0.0
        for word, n in counts.items():
            square = (n * weights.get(word, other))**2
            total += square
            if word in known:
                inside += square
        if inside < (self.threshold**2 - 1e-9) * total:
            return {}
        own = Counter({word: n for word, n in counts.items() if word in weights})
        return self.matches(own, sum(n * n for word, n in counts.items() if word not in weights))

    def windows(self, words: list[bytes]) -> dict[str, float]:
        """Licences of stretches as long as a template, in a longer text."""
        places: dict[int, list[int]] = {}
        for place, word in enumerate(words):
            for k in self.anchors.get(word, ()):
                if self.sizes[k] < len(words):
                    places.setdefault(k, []).append(place)
        found: dict[str, float] = {}
        for k, spots in places.items():
            size, vector, name = self.sizes[k], self.vectors[k], self.names[k]
            end = -1
            for spot in spots:
                # Stretches that hold this anchor and haven't been looked at.
                first = max(spot - size + 1, 0, end)
                last = min(spot, len(words) - size)
                if first > last:
                    continue
                counts = Counter(words[first:first + size])
                total = sum((n * self.weights.get(t, self.other))**2 for t, n in counts.items())
                dot = sum(n * self.weights[t] * vector[t] for t, n in counts.items() if t in vector)
                for start in range(first, last + 1):
                    cosine = dot / math.sqrt(total)
                    if cosine >= self.threshold and cosine > found.get(name, 0):
                        found[name] = min(cosine, 1.0)
                    if start == last:
                        break
                    for term, by in ((words[start], -1), (words[start + size], 1)):
                        weight, n = self.weights.get(term, self.other), counts[term]
                        total += (2 * n * by + 1) * weight * weight
                        dot += by * weight * vector.get(term, 0.0)
                        counts[term] = n + by
                end = last + 1
        return found


def unit_terms(text: str | None) -> Iterator[tuple[bool, list[bytes]]]:
    """The words of each line, each paragraph of several lines, and the whole text (True)."""
    lines = [terms_of(line) for line in
             (text or "").encode("utf-8", "surrogatepass").split(b"\n")]
    paragraph: list[list[bytes]] = []
    for words in [*lines, []]:
        if words:
            yield False, words
            paragraph.append(words)
            continue
        if len(paragraph) > 1:
            yield False, [word for line in paragraph for word in line]
        paragraph = []
    yield True, [word for line in lines for word in line]


def fit(docs: DataFrame, text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
        threshold: float = THRESHOLD) -> Templates:
    """Template vectors, with document frequencies of their terms over all of ``docs``."""
    counted = [(name, Counter(terms_of(notice.encode()))) for name, notice in templates]
    vocabulary = {term for _, terms in counted for term in terms}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, number = Counter(), 0
        for batch in batches:
            number += len(batch)
            for cell in batch.column(0):
                raw = (cell.as_py() or "").encode("utf-8", "surrogatepass")
                found.update(vocabulary.intersection(terms_of(raw)))
        terms = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *terms], pa.binary()),
             pa.array([number, *(found[term] for term in terms)], pa.int64())],
            names=["term", "n"])

    sums = docs.select(F.col(text).cast("string")).mapInArrow(run, "term binary, n long").groupBy(
        "term").agg(F.sum("n").alias("n")).collect()
    # As many rows as the templates have terms, and one for the number of documents.
    frequency = {None if row["term"] is None else bytes(row["term"]): row["n"] for row in sums}
    total = frequency.get(None, 0)
    weights = {t: math.log((total + 1) / (frequency.get(t, 0) + 1)) + 1 for t in vocabulary}
    vectors = []
    for _, terms in counted:
        vector = {term: n * weights[term] for term, n in terms.items()}
        length = math.sqrt(sum(w * w for w in vector.values()))
        vectors.append({term: w / length for term, w in vector.items()})
    return Templates([name for name, _ in counted], vectors, weights, math.log(total + 1) + 1,
                     threshold, [sum(terms.values()) for _, terms in counted])


def notices(docs: DataFrame, templates: Templates, keep: Sequence[str],
            text: str = "text") -> DataFrame:
    """``keep``, licence and cosine of the best notice, all ``licences``, and ``whole``: is the
    text as a whole a notice. Ties go to the first identifier; no notice gives NULL."""
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, scores, every, wholes = [], [], [], []
            for cell in batch.column(len(keep)):
                found: dict[str, float] = {}
                entire = False
                for whole, words in unit_terms(cell.as_py()):
                    for name, cosine in templates.scan(words).items():
                        found[name] = max(cosine, found.get(name, 0))
                        entire |= whole
                    if whole:
                        for name, cosine in templates.windows(words).items():
                            found[name] = max(cosine, found.get(name, 0))
                name = min(found, key=lambda n: (-found[n], n), default=None)
                best.append(name)
                scores.append(found.get(name))
                every.append(sorted(found))
                wholes.append(entire)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(best, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(every, pa.list_(pa.string())),
                 pa.array(wholes, pa.bool_())],
                names=[*keep, "licence", "cosine", "licences", "whole"])

    fields = "".join(f"`{name}` {kind}, " for name, kind in rows.dtypes[:len(keep)])
    return rows.mapInArrow(run, f"{fields}licence string, cosine double, "
                                "licences array<string>, whole boolean")


def scan_licences(files: DataFrame, id: str = "doc_id", path: str = "path", text: str = "text",
                  templates: Sequence[tuple[str, str]] = TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``id``, path, licence, cosine, licences, origin, inherited_from.

    origin is ``own`` for a notice in the text, ``inherited`` for the licence of the nearest
    directory at or above the file that has one (inherited_from; its best notice, ties to the
    smallest path), else NULL. Directories are what stands before each ``/``. NULL and empty
    texts have no notice; a NULL path has no directories. Repeated rows each give a row.
    """
    rows = files.select(F.col(id).alias("id"), F.col(path).cast("string").alias("path"),
                        F.col(text).alias("text"))
    found = materialize(notices(rows, fit(rows, "text", templates, threshold), ["id", "path"]),
                        "notices")
    # "" stands for the root; a file in it has no slash in its path.
    found = found.withColumn("folder", F.regexp_replace(
        F.regexp_extract("path", r"(?s)^(.*/)?", 0), "/$", ""))
    name = F.regexp_extract("path", r"(?s)([^/]*)$", 1)
    speaking = (found.filter("licence IS NOT NULL AND path IS NOT NULL")
                .filter(F.col("whole") | name.rlike(LICENCE_FILE))
                .groupBy("folder")
                .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "path", "licence", "cosine"))
                     .alias("best")))
    parts = F.split("folder", "/", -1)
    lines = found.filter("licence IS NULL AND path IS NOT NULL").select("folder").distinct().select(
        "folder", F.explode(F.transform(
            F.sequence(F.lit(0), F.size(parts)),
            lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/")
                               .alias("above")))).alias("line"))
    inherited = (lines.select("folder", "line.depth", F.col("line.above").alias("above"))
                 .join(speaking.withColumnRenamed("folder", "above"), "above")
                 .groupBy("folder").agg(F.max(F.struct("depth", "above", "best")).alias("nearest")))
    # One row per folder that inherits: where these are few, no file is shuffled to its folder.
    inherited = measured(inherited, ["folder"])
    own = F.col("licence").isNotNull()
    near = F.col("nearest.best")
    return found.join(inherited, "folder", "left").select(
        F.col("id").alias(id), "path", F.coalesce("licence", near["licence"]).alias("licence"),
        F.coalesce("cosine", near["cosine"]).alias("cosine"), "licences",
        F.when(own, "own").when(near.isNotNull(), "inherited").alias("origin"),
        F.when(~own, F.col("nearest.above")).alias("inherited_from"))
