"""License scans: TF-IDF cosine to templates, then directory inheritance.

A text is a sequence of terms. Candidates are each line, each window of a
template's length (over line ends, so that wrapped headers are joined and
sentences within long lines are found), and a licence file (by its name) as a
whole. Each becomes a sparse vector of term counts times inverse document
frequency (over ``TEMPLATES``; terms that none of them has weigh most, so other
words count against it). It counts for a template if it holds a word of
``MARKERS``, as headers do that name a licence; templates without such a word
(grants) are reached by ``SHARED`` of their terms as well. Nothing is lost by the
bounds that spare most of the work: a candidate without heavy enough terms of a
template cannot be as similar as ``LEAST`` (with the terms that both have, the
cosine is at most the root of their squared weights), and counting every term
once at least bounds a window's length from below, by prefix sums. Only windows
within both bounds are counted. A file's own
licence is its best candidate of ``LEAST`` similarity or more; a copyright line
(``RESERVED``) only if no other licence reaches it. Headers are the candidates
taken best first (longer first, then earlier) as long as none overlaps one that
is taken already.

Licence files (by name, or since ``FILE_SHARE`` of their words are in headers)
speak for their directory. A file without a licence of its own takes
that of its nearest ancestor directory. Ancestors are looked up once for each
directory, by a join of its path's prefixes with the speaking directories;
files then join their directory, so neither a file's ancestors nor a
directory's files multiply.

Defined results: a null text counts as empty; a null path is a file in the
root; of equally similar licences the first by name holds; of equally good
licence files in a directory likewise; rows that repeat give equal rows; an
empty table gives no rows; further columns are not read. Long texts are read
whole, in parts that end at a blank; a task holds about 100 bytes for each of a
text's terms.
"""

from __future__ import annotations

import functools
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ship, text_of, written

LEAST = 0.55
FILE_SHARE = 0.3
MARKERS = r"(?i)licen[cs]|copyright|spdx|public domain|creative commons|cc by|cc0|warrant"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
SHARED = 5
#: Characters of a part of a text, and windows that are counted at once.
BLOCK, CHUNK = 1 << 20, 512
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([.-][^/]*)?$"

#: The documents have no paths; the query gives them directories of 1024 and
#: of 32 neighbouring ids below their source (Spark SQL, DuckDB SQL).
DOC_PATH = "concat_ws('/', coalesce(source, '-'), doc_id div 1024, doc_id div 32, doc_id)"
DOC_PATH_SQL = "concat_ws('/', coalesce(source, '-'), doc_id // 1024, doc_id // 32, doc_id)"

#: SPDX identifiers and the phrases by which texts name them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except"
                   " in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
                " General Public License as published by the Free Software Foundation, either version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"
                     " provided that the following conditions are met"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Licensed under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International"
                     " License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved."),
]

_NOTICE = ("This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General"
           " Public License as published by the Free Software Foundation, either version {}")

#: Versions, identifiers and grants that ``TEMPLATES`` lacks; weighed by the same frequencies.
FURTHER = [
    ("GPL-2.0", _NOTICE.format("program", ";", "", "2")),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", _NOTICE.format("library", ";", "Lesser ", "2.1")),
    ("LGPL-3.0", _NOTICE.format("library", ":", "Lesser ", "3")),
    ("LGPL-3.0", _NOTICE.format("program", ":", "Lesser ", "3")),
    ("AGPL-3.0", _NOTICE.format("program", ":", "Affero ", "3")),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
            " hereby granted"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    *((name, f"SPDX-License-Identifier: {name}{end}") for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
      for end in ("", "-only", "-or-later") if (name, end) not in (("GPL-2.0", "-only"), ("GPL-3.0", "-only"))),
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "BSD-3-Clause", "BSD-2-Clause", "MPL-2.0", "ISC", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0",
        "Unlicense")),
]

#: Stands over most grants and withdraws none.
RESERVED = "Proprietary"

_MARKER = re.compile(MARKERS)
#: What a text in lower case must hold for ``MARKERS`` to match.
_MARKS = [m for part in MARKERS.removeprefix("(?i)").split("|")
          for m in ([part[:-4] + c for c in part[-3:-1]] if part.endswith("]") else [part])]
_TERM_OR_LINE = re.compile(TERM + r"|\n")
_BLANK = re.compile(r"[ \n]")


def terms_of(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def template_vectors(templates=TEMPLATES) -> tuple[list[tuple], float]:
    """Rows (term, idf, template, license, weight) with unit vectors, and the
    idf of a term that no template has."""
    counts = [Counter(terms_of(t)) for _, t in templates]
    df = Counter(term for c in counts for term in c)
    idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in df.items()}
    rows = []
    for k, ((name, _), c) in enumerate(zip(templates, counts)):
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        rows += [(t, idf[t], k, name, n * idf[t] / norm) for t, n in sorted(c.items())]
    return rows, math.log(1 + len(templates)) + 1


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def _with_further(templates, further) -> list[tuple[str, dict[str, float], int]]:
    """(license, unit vector, length in terms) of all templates."""
    rows, unknown = template_vectors(templates)
    idf = {term: i for term, i, *_ in rows}
    out = []
    for name, text in [*templates, *further]:
        c = Counter(terms_of(text))
        x = {t: n * idf.get(t, unknown) for t, n in c.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        out.append((name, {t: v / norm for t, v in x.items()}, sum(c.values())))
    return out


class Scanner:
    """Headers of one text after the other."""

    def __init__(self, templates, further, least: float):
        rows, self.unknown = template_vectors(templates)
        self.idf = {term: i for term, i, *_ in rows}
        self.least = least
        self.templates = _with_further(templates, further)
        self.grants = {k for k, (_, t) in enumerate([*templates, *further]) if not re.search(MARKERS, t)}
        # Terms of templates are numbered first; all others weigh alike.
        self.known = {t: i for i, t in enumerate(dict.fromkeys(t for _, v, _ in self.templates for t in v))}
        self.n = len(self.known)
        self.weigh = np.array([self.idf.get(t, self.unknown) for t in self.known] + [self.unknown])
        self.weights = np.zeros((len(self.templates), self.n + 1))
        for k, (_, vector, _) in enumerate(self.templates):
            for t, w in vector.items():
                self.weights[k, self.known[t]] = w
        self.has = (self.weights > 0).astype(int)
        self.floor = max(least - 1e-5, 0)
        self.marked = functools.lru_cache(maxsize=1 << 16)(lambda body: bool(_MARKER.search(body)))

    def _terms(self, text: str) -> tuple[np.ndarray, list[str], np.ndarray]:
        """The numbers of the terms, all terms by number, and where lines end."""
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        number.update(self.known)
        line_feed, parts, at = number["\n"], [], 0
        while at < len(text):
            m = _BLANK.search(text, at + BLOCK) if len(text) - at > BLOCK else None
            end = m.start() if m else len(text)
            found = _TERM_OR_LINE.findall(text, at, end)
            parts.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
            at = end
        numbers = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        breaks = np.flatnonzero(numbers == line_feed)
        ends = np.append(breaks - np.arange(len(breaks)), len(numbers) - len(breaks))
        return np.delete(numbers, breaks) if len(breaks) else numbers, list(number), ends

    def _alive(self, present: np.ndarray, marked: bool) -> list[int]:
        """Templates that something with these known terms can be as similar to."""
        near = np.flatnonzero((self.weights ** 2) @ present >= self.floor ** 2).tolist()
        return near if marked else [k for k in near if k in self.grants and self.has[k] @ present >= SHARED]

    def _similarities(self, numbers: np.ndarray, among: list[int]) -> list[tuple[float, str]]:
        """(-similarity, license) of the whole of ``numbers``."""
        each, n = np.unique(numbers, return_counts=True)
        x = n * self.weigh[np.minimum(each, self.n)]
        dots = self.weights[among][:, np.minimum(each, self.n)] @ x
        return [(-round(float(s), 6), self.templates[k][0]) for k, s in zip(among, dots / math.sqrt(x @ x))]

    def _line(self, numbers: np.ndarray, marked: bool) -> tuple[float, str] | None:
        """The best template of one line, None if none is similar enough."""
        some = self._alive(np.bincount(np.minimum(numbers, self.n), minlength=self.n + 1) > 0, marked)
        best = min(self._similarities(numbers, some), default=(0.0, ""))
        return best if -best[0] >= self.least else None

    def _windows(self, numbers, dot, square, k, names):
        """(similarity, begin, end) of the windows of template ``k``'s length
        that are similar enough."""
        m = min(self.templates[k][2], len(numbers))
        bound = (dot[m:] - dot[:-m]) / np.sqrt(square[m:] - square[:-m])
        near = np.flatnonzero(bound >= self.floor)
        views = np.lib.stride_tricks.sliding_window_view(numbers, m)
        for i in range(0, len(near), CHUNK):
            begins = near[i:i + CHUNK]
            own = views[begins]
            times = (own[:, :, None] == own[:, None, :]).sum(axis=2)  # how often each term is there
            own = np.minimum(own, self.n)
            length = (times * self.weigh[own] ** 2).sum(axis=1)
            similar = np.round((self.weigh * self.weights[k])[own].sum(axis=1) / np.sqrt(length), 6)
            shared = np.rint((self.has[k][own] / times).sum(axis=1))
            for begin, s, n in zip(begins[similar >= self.least].tolist(), similar[similar >= self.least].tolist(),
                                   shared[similar >= self.least].tolist()):
                if (k in self.grants and n >= SHARED) or self.marked(" ".join(
                        [names[j] for j in numbers[begin:begin + m].tolist()])):
                    yield s, begin, begin + m

    def scan(self, text: str, named: bool) -> tuple | None:
        """(license, similarity, words in headers, headers, words of the text),
        None without any."""
        text = text.lower()
        numbers, names, ends = self._terms(text)
        if not len(numbers):
            return None
        folded = np.minimum(numbers, self.n)
        any_mark = any(m in text for m in _MARKS)
        alive = self._alive(np.bincount(folded, minlength=self.n + 1) > 0, any_mark)
        found, best = [], []
        if alive:
            begins = np.append(0, ends[:-1])
            square = np.append(0.0, np.cumsum(self.weigh[folded] ** 2))
            lines = np.flatnonzero(ends > begins)
            near = np.zeros(len(ends), bool)
            for k in alive:
                dot = np.append(0.0, np.cumsum((self.weigh * self.weights[k])[folded]))
                b, e = begins[lines], ends[lines]
                near[lines] |= (dot[e] - dot[b]) / np.sqrt(square[e] - square[b]) >= self.floor
                found += [(-s, b - e, b, e, self.templates[k][0])
                          for s, b, e in self._windows(numbers, dot, square, k, names)]
            marked = self._marked_lines(text) if any_mark and near.any() else set()
            for i in np.flatnonzero(near).tolist():
                b, e = int(begins[i]), int(ends[i])
                line = self._line(numbers[b:e], i in marked)
                if line is not None:
                    found.append((line[0], b - e, b, e, line[1]))
            best = [(s, name) for s, _, _, _, name in found]
        if named:
            whole = min(self._similarities(numbers, list(range(len(self.templates)))))
            if -whole[0] >= self.least:
                best.append(whole)
        if not best:
            return None
        begins, ends, words = [], [], 0
        for _, _, b, e, _ in sorted(found):
            i = bisect_left(begins, b)
            if (i == 0 or ends[i - 1] <= b) and (i == len(begins) or begins[i] >= e):
                begins.insert(i, b)
                ends.insert(i, e)
                words += e - b
        s, name = min(best, key=lambda x: (x[1] == RESERVED, x))
        return name, -s, words, len(begins), len(numbers)

    @staticmethod
    def _marked_lines(text: str) -> set[int]:
        out, line, at = set(), 0, 0
        for m in _MARKER.finditer(text):
            line += text.count("\n", at, m.start())
            at = m.start()
            out.add(line)
        return out


def _own(files: DataFrame, scanner: tuple) -> DataFrame:
    """(id, path, named, own, own_similarity, in_headers, n_headers, n_terms),
    the latter null without a licence of its own, of every file."""
    ship(files.sparkSession)

    def run(batches):
        scan = _scanner(*scanner).scan
        for batch in batches:
            found = [scan(text.as_py(), named) or (None,) * 5 for named, text in zip(
                batch.column("named").to_pylist(), batch.column("text"))]
            columns = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("id", "path", "named")), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["id", "path", "named", *names])

    names = ["own", "own_similarity", "in_headers", "n_headers", "n_terms"]
    types = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
    return files.mapInArrow(run, "id long, path string, named boolean, own string, own_similarity double, in_headers long,"
                                 " n_headers long, n_terms long")


@functools.lru_cache(maxsize=4)
def _scanner(templates: tuple, further: tuple, least: float) -> Scanner:
    """One for each Python worker, kept between its tasks."""
    return Scanner(templates, further, least)


def _prefixes(directory: Column) -> Column:
    """The directory and its ancestors down to the root (''), with depths."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        F.array_join(F.slice(parts, 1, i), "/").alias("ancestor"), i.alias("depth")))


def scan(files: DataFrame, id_col: str, path_col: str, text_col: str = "text", templates=TEMPLATES,
         least: float = LEAST, file_share: float = FILE_SHARE, further=FURTHER) -> DataFrame:
    """One row per row of ``files``: ``id``, ``path``, ``license`` (null if
    none), ``similarity`` (of what it rests on), ``origin`` (own, inherited or
    null), ``directory`` (the one that it inherits from) and ``n_headers``."""
    base = files.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")).alias("path"),
                        text_of(f"`{text_col}`").alias("text"))
    base = base.select("id", "path", F.col("path").rlike(FILE_NAME).alias("named"), "text")
    own = _own(base, (tuple(templates), tuple(further), least))
    rows = written(own.withColumn("at", _directory(F.col("path"))), "license-own", wide=True)
    speaks = rows.filter(F.col("own").isNotNull() & (F.col("named") | (F.col("in_headers") >= file_share * F.col("n_terms"))))
    speaks = speaks.groupBy(F.col("at").alias("ancestor")).agg(
        F.min(F.struct((-F.col("own_similarity")).alias("s"), F.col("own").alias("license"))).alias("b"))
    ancestors = rows.select("at").distinct().select("at", F.explode(_prefixes(F.col("at"))).alias("p")).select("at", "p.*")
    nearest = (ancestors.join(speaks, "ancestor").groupBy("at")
               .agg(F.max(F.struct("depth", "ancestor", "b")).alias("m"))
               .select("at", F.col("m.ancestor").alias("ancestor"), F.col("m.b.license").alias("inherited"),
                       (-F.col("m.b.s")).alias("inherited_similarity")))
    own_here, heir = F.col("own").isNotNull(), F.col("inherited").isNotNull()
    return rows.join(written(nearest, "license-nearest"), "at", "left").select(
        "id", "path", F.coalesce("own", "inherited").alias("license"),
        F.coalesce("own_similarity", "inherited_similarity").alias("similarity"),
        F.when(own_here, F.lit("own")).when(heir, F.lit("inherited")).alias("origin"),
        F.when(~own_here & heir, F.col("ancestor")).alias("directory"),
        F.coalesce("n_headers", F.lit(0)).cast("long").alias("n_headers"))
