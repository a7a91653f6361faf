"""License scans against a plain cosine and a plain walk up the directories."""

import math
import random
import re
from collections import Counter

import pytest

from martlake.llm import licenses as L

SCHEMA = "doc_id long, p string, text string, path string, license string, n long"
T = dict(reversed([(n, t) for n, t in L.TEMPLATES]))


def vector(text, idf, unknown):
    return {t: n * idf.get(t, unknown) for t, n in Counter(L.terms_of(text)).items()}


def cosine(a, b):
    dot = sum(x * b.get(t, 0) for t, x in a.items())
    return dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())) if a and b else 0.0


def own(text, path):
    rows, unknown = L.template_vectors()
    idf = {t: i for t, i, *_ in rows}
    cands = [(x, False) for x in text.split("\n") if re.search(L.MARKERS, x)]
    if re.search(L.FILE_NAME, path):
        cands.append((text, True))
    best, headers, words = None, 0, 0
    for body, whole in cands:
        v = vector(body, idf, unknown)
        s = [(round(cosine(v, vector(t, idf, unknown)), 6), n) for n, t in L.TEMPLATES]
        top = max(x for x, _ in s)
        if top >= L.LEAST:
            pick = (-top, min(n for x, n in s if x == top))
            best = min(best, pick) if best else pick
            if not whole:
                headers += 1
                words += len(L.terms_of(body))
    return best, headers, words


def brute(rows):
    info = []
    for i, p, t in rows:
        p, t = p or "", t or ""
        best, headers, words = own(t, p)
        at = p.rsplit("/", 1)[0] if "/" in p else ""
        info.append((i, p, at, best, headers, bool(best) and (bool(re.search(L.FILE_NAME, p)) or words >= L.FILE_SHARE * len(L.terms_of(t)))))
    speaks = {}
    for _, _, at, best, _, says in info:
        if says:
            speaks[at] = min(speaks.get(at, best), best)
    out = []
    for i, p, at, best, headers, _ in info:
        if best:
            out.append((i, p, best[1], -best[0], "own", None, headers))
            continue
        d = at
        while d and d not in speaks:
            d = d.rsplit("/", 1)[0] if "/" in d else ""
        hit = speaks.get(d)
        out.append((i, p, hit and hit[1], hit and -hit[0], hit and "inherited", d if hit else None, headers))
    return out


def rows_of():
    rng = random.Random(1)
    dirs = ["", "a/", "a/b/", "a/b/c/", "a/d/e/", "x/", "x/y/z/"]
    prose = "some words of code that mean nothing here\n"
    rows = [(1, "a/LICENSE", prose + T["MIT"]), (2, "x/y/COPYING.txt", "\n".join(t for n, t in L.TEMPLATES if n == "GPL-3.0")),
            (3, "a/d/LICENSE.md", ""), (4, None, None), (5, "", ""), (6, "a/b/k", T["Apache-2.0"]),
            (7, "a/b/k", prose * 30 + T["CC0-1.0"]), (None, "a/b/c/q", "license " * 50), (8, "x/q", "copyright\n\nLICENCE"),
            (9, "x/s", prose + "// SPDX-License-Identifier: Apache-2.0\n" + prose), (9, "x/s", prose + "// SPDX-License-Identifier: Apache-2.0\n" + prose)]
    for i in range(80):
        rows.append((100 + i, rng.choice(dirs) + f"f{i}", prose * rng.randint(0, 3) + (rng.choice(L.TEMPLATES)[1] if rng.random() < .1 else "")))
    return rows


def test_against_a_plain_scan(spark):
    rows = rows_of()
    df = spark.createDataFrame([(*r, "p", "l", 1) for r in rows], SCHEMA).repartition(3)
    got = [(r["id"], r["path"], r["license"], r["similarity"], r["origin"], r["directory"], r["n_headers"])
           for r in L.scan(df, "doc_id", "p").collect()]
    want = brute(rows)
    for g, w in zip(sorted(got, key=repr), sorted(want, key=repr)):
        assert g[:3] + g[4:] == w[:3] + w[4:]
        assert g[3] == pytest.approx(w[3], abs=2e-6)
    assert len(got) == len(want)


def test_every_template_names_itself():
    for name, text in L.TEMPLATES:
        assert re.search(L.MARKERS, text) or name in ("MIT", "GPL-3.0", "BSD-3-Clause"), text


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, p string, text string"), "doc_id", "p").count() == 0


def plain_best(body, templates):
    rows, unknown = L.template_vectors()
    idf = {t: i for t, i, *_ in rows}
    v = vector(body, idf, unknown)
    return max(((cosine(v, vector(t, idf, unknown)), n) for n, t in templates), default=(0.0, ""))


def scanned(spark, texts):
    df = spark.createDataFrame([(i, f"{i}/f", t) for i, t in enumerate(texts)], "doc_id long, p string, text string")
    return [r for r in L.scan(df.repartition(3), "doc_id", "p").orderBy("id").collect()]


def test_every_template_is_reached_alone_and_within_a_line(spark):
    templates = L.TEMPLATES + L.FURTHER
    rest = "qq ww ee rr tt yy uu ii oo pp"
    texts = [t for _, t in templates] + [f"{rest} {t} {rest}" for _, t in templates] + [
        f"{rest}\n" + "\n".join(f"# {x}" for x in re.findall(r"\S+(?: \S+){0,3}", t)) + f"\n{rest}" for _, t in templates]
    for (name, t), r in zip(templates * 3, scanned(spark, texts)):
        assert (r["license"], r["similarity"], r["origin"]) == (name, pytest.approx(1), "own"), t
        assert r["n_headers"] >= 1


def test_heaviest_terms_lose_no_candidate():
    templates = L.TEMPLATES + L.FURTHER
    scanner = L.Scanner(L.TEMPLATES, L.FURTHER, L.LEAST)
    rng = random.Random(2)
    for _ in range(3000):
        name, t = rng.choice(templates)
        body = " ".join(x for x in L.terms_of(t) if rng.random() < .6)
        best = plain_best(body, templates if re.search(L.MARKERS, body) else [
            (n, x) for n, x in templates if not re.search(L.MARKERS, x) and len(set(L.terms_of(x)) & set(L.terms_of(body))) >= L.SHARED])
        if abs(best[0] - L.LEAST) > 1e-5:
            assert (scanner.scan(body, False) is not None) == (best[0] > L.LEAST), body


def test_words_without_a_marker_are_no_header(spark):
    assert [r["license"] for r in scanned(spark, ["All rights reserved.", "er kam mit mit uns", "to be with or without it"])] == [None] * 3


def test_grants_without_a_title_and_copyright_lines(spark):
    bsd = ("Copyright (c) 2020, Jane Doe. All rights reserved.\n\nRedistribution and use in source and binary forms, with or"
           " without\nmodification, are permitted provided that the following conditions are met:\n")
    mit = ("Copyright. All rights reserved.\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files")
    assert [r["license"] for r in scanned(spark, [bsd, mit, "Copyright (c) 2020, Jane Doe. All rights reserved."])] == [
        "BSD-3-Clause", "MIT", "Proprietary"]


def test_wrapped_notices_and_sentences_in_paragraphs(spark):
    gpl = (" * This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU {}General"
           " Public License as published by\n * the Free Software Foundation; either version {} of the License, or\n"
           " * (at your option) any later version.\n")
    texts = [gpl.format("", 2), gpl.format("", 3), gpl.format("Lesser ", 3), gpl.format("Affero ", 3),
             "We did this in two years of work, and it was Released under the MIT License. Thanks go to all of you.",
             "// SPDX-License-Identifier: BSD-3-Clause", "x\nSPDX-License-Identifier: LGPL-2.1-or-later\ny"]
    assert [r["license"] for r in scanned(spark, texts)] == [
        "GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "MIT", "BSD-3-Clause", "LGPL-2.1"]
    assert scanned(spark, ["\n".join([T["MIT"]] * 3) + "\nother words"])[0]["n_headers"] == 3


def plain_windows(text):
    """Whether any line or window of a template's length is similar enough, and
    the best: the definition, one candidate after the other."""
    every = L.TEMPLATES + L.FURTHER
    rows, unknown = L.template_vectors()
    idf = {t: i for t, i, *_ in rows}
    vectors = [(n, t, vector(t, idf, unknown), len(L.terms_of(t)), bool(re.search(L.MARKERS, t))) for n, t in every]
    terms = L.terms_of(text)
    lines = [(x, L.terms_of(x), None) for x in text.lower().split("\n")]
    windows = [(" ".join(w), w, k) for k, (_, _, _, m, _) in enumerate(vectors)
               for i in range(max(len(terms) - m, 0) + 1) for w in [terms[i:i + m]]]
    found = []
    for body, own, k in lines + windows:
        v = {t: n * idf.get(t, unknown) for t, n in Counter(own).items()}
        marked = bool(re.search(L.MARKERS, body))
        for j, (name, _, u, _, named) in enumerate(vectors):
            if k in (None, j) and (marked or not named and len(u.keys() & v.keys()) >= L.SHARED):
                s = round(cosine(v, u), 6)
                if s >= L.LEAST:
                    found.append((name == L.RESERVED, -s, name))
    return min(found, default=None)


def test_whole_documents_against_every_window():
    import duckdb
    scanner = L.Scanner(L.TEMPLATES, L.FURTHER, L.LEAST)
    rng = random.Random(8)
    docs = [t for t, in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' WHERE length(text) < 3000"
                                   " ORDER BY doc_id").fetchall()]
    words = [w for t in docs for w in t.split()][:3000] + [w for _, t in L.TEMPLATES + L.FURTHER for w in t.split()] * 3
    texts = [t or "" for t in docs[:40]]
    for _ in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(1, 12))) if rng.random() < .6 else
                 " ".join(x for x in rng.choice(L.TEMPLATES + L.FURTHER)[1].split() if rng.random() < .85) for _ in range(8)]
        texts.append("".join(p + rng.choice([" ", "\n", ", "]) for p in parts))
    hits = 0
    for text in texts:
        want, got = plain_windows(text), scanner.scan(text, False)
        if want and abs(want[1] + L.LEAST) < 2e-6:
            continue
        assert (got is None) == (want is None), text
        if want:
            hits += 1
            assert got[0] == want[2] and got[1] == pytest.approx(-want[1], abs=2e-6)
    assert hits > 20


def test_very_long_texts(spark):
    mit = T["MIT"]
    texts = ["a-" * 1_000_000, "license " + "a-" * 2000 + "b", " " * 2_000_000, "license " * 200_000, "\n" * 1_000_000,
             "word " * 400_000 + mit, "a." * 500_000 + "\n" + mit, "x" * 2_000_000 + " license"]
    assert [r["license"] for r in scanned(spark, texts)][-3:] == ["MIT", "MIT", None]


def test_parts_of_long_texts_end_at_blanks(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 16)
    scanner = L.Scanner(L.TEMPLATES, L.FURTHER, L.LEAST)
    for name, t in L.TEMPLATES + L.FURTHER:
        numbers, names, ends = scanner._terms((t + "\nnext line\n").lower())
        assert [names[i] for i in numbers] == L.terms_of(t) + ["next", "line"] and ends.tolist() == [
            len(numbers) - 2, len(numbers), len(numbers)]
        assert scanner.scan(f"{t}\nnext line\n", False)[:2] == (name, 1.0)
