"""Merkle fingerprints against a plain tree, and edits located by branches."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from martlake.llm import fingerprints as M

SCHEMA = "doc_id long, text string, k long, edited string, fingerprint string"


def short(s):
    return hashlib.md5(s.encode()).hexdigest()[:16]


def tree(text):
    paragraphs = []
    for line in re.findall(r"[^\n]*\n|[^\n]+$", text):
        body, end = line.rstrip("\n"), line.endswith("\n")
        blocks, now = [], ""
        while body:   # up to the first cut that is not too far, else the longest leaf
            cut = next((n for n in range(2, M.LEAF + 1) if body[n - 1:n] == " " and re.fullmatch("[^ g-z]", body[n - 2])), M.LEAF)
            blocks.append(body[:cut])
            body = body[cut:]
        if end and (not blocks or re.search("[^ g-z] $", blocks[-1])):
            blocks.append("\n")   # behind a cut the line feed is a leaf of its own
        elif end:
            blocks[-1] += "\n"
        leaves = [f"{short(b)}.{len(b)}" for b in blocks]
        paragraphs.append((",".join(leaves) + (";" if end else ","), leaves, line == "\n"))
    sections, now = [], []
    for p, _, blank in paragraphs:
        cut = blank or short(p)[0] in "01"
        now.append(p + "/" * cut)
        if cut:
            sections.append(now)
            now = []
    if now:
        sections.append(now)
    root = hashlib.sha256("".join(short("".join(map(short, s))) for s in sections).encode()).hexdigest()
    return root + "|" + "".join("".join(s) for s in sections), [x for _, ls, _ in paragraphs for x in ls]


def near(a, b):
    (fa, la), (fb, lb) = tree(a), tree(b)
    if fa.split("|")[0] == fb.split("|")[0]:
        return 1.0

    def size(x):
        return sum(int(v.split(".")[1]) for v in set(x))
    return 2 * size(set(la) & set(lb)) / (size(la) + size(lb))


def texts(rng, n):
    out = [None, "", "\n", "\n\n", "a", "a\n", "\na", "é\U0001f600" * 300, "x" * 256, "x" * 257, "x" * 256 + "\n"]
    for _ in range(n):
        out.append("\n".join(" ".join(rng.choice(["ab", "ç", "word", ""]) for _ in range(rng.choice([0, 5, 200])))
                             for _ in range(rng.randint(1, 30))))
    return out


def test_against_a_plain_tree(spark):
    rng = random.Random(1)
    t = texts(rng, 40)
    ids = rng.sample(range(-500, 500), len(t))
    rows = list(zip(ids, t))
    df = spark.createDataFrame([(i, x, 1, "e", "f") for i, x in rows], SCHEMA).repartition(4)
    got = {r["id"]: r for r in M.edited_fingerprints(df).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for n, (i, x) in enumerate(order):
        x, y = x or "", order[(n + 1) % len(order)][1] or ""
        half = len(x) // 2
        edited = x[:len(x) - half] + y[:half]
        r = got[i]
        assert (r["n_chars"], r["edited"]) == (len(x), edited)
        assert r["fingerprint"] == tree(x)[0] and r["edited_fingerprint"] == tree(edited)[0]
        assert r["near_edited"] == pytest.approx(near(x, edited)) and r["near_next"] == pytest.approx(near(x, y))


def test_repeated_and_null_ids(spark):
    rows = [(1, "aa\nbb"), (1, "aa\nbb"), (1, "cc"), (None, "dddd"), (None, "dddd"), (5, "eeee")]
    df = spark.createDataFrame([(i, x, 1, "e", "f") for i, x in rows], SCHEMA).repartition(3)
    got = sorted(((r["id"] is not None, r["id"], r["n_chars"], r["edited"]) for r in M.edited_fingerprints(df).collect()))
    first = df.filter("doc_id = 1").orderBy(F.xxhash64("text")).first()["text"]
    assert got == sorted([(False, None, 4, "dd" + first[:2])] * 2 + [(True, 1, 5, "aa\nee")] * 2
                         + [(True, 1, 2, "ce"), (True, 5, 4, "eedd")])


def test_single_row_and_empty_table(spark):
    df = spark.createDataFrame([(1, "abcd", 1, "e", "f")], SCHEMA)
    r = M.edited_fingerprints(df).first()
    assert (r["edited"], r["near_next"]) == ("abab", 1.0)
    assert M.edited_fingerprints(df.limit(0)).count() == 0


def test_branches_locate_an_edit(spark):
    rng = random.Random(3)
    lines = [" ".join(rng.choice(["ab", "cd", "ef"]) for _ in range(9)) + str(i) for i in range(60)]
    other = list(lines)
    other[17] = "edited"
    other.insert(40, "new")
    df = spark.createDataFrame([(0, "\n".join(other)), (1, "\n".join(lines))], "doc_id long, text string")
    a, b = (r["fingerprint"] for r in M.fingerprints(df).orderBy("id").collect())
    two = spark.createDataFrame([(a, b)], "a string, b string")
    assert two.select(M.differing_paragraphs(F.col("a"), F.col("b")).alias("x")).first()["x"] == [17, 40]
    assert two.select(M.differing_paragraphs(F.col("a"), F.col("a")).alias("x")).first()["x"] == []
    # Sections away from the edits are common branches.
    sections = [set(re.findall("[^/]+/?", f.split("|")[1])) for f in (a, b)]
    assert len(sections[0] & sections[1]) >= len(sections[0]) - 4


def test_successors_over_many_ranges(spark):
    ids = random.Random(4).sample(range(10 ** 6), 500)
    got = {r["k"]: r["next_k"] for r in M.successors(M.in_order(
        spark.createDataFrame([(i,) for i in ids], "k long").repartition(5))).collect()}
    order = sorted(ids)
    assert got == dict(zip(order, order[1:] + order[:1]))


def test_short_one_line_texts_are_near_their_edits(spark):
    rng = random.Random(5)
    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    lines = []
    for n in range(100, 501, 10):
        line = ""
        while len(line) < n:
            line += word() + rng.choice([" ", " ", " ", ", ", ". "])
        lines.append(line[:n])
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    for r in M.edited_fingerprints(df).collect():
        assert r["near_edited"] > .25 and r["near_next"] < .15
    # An insertion early in a long line moves the cuts near it only.
    text = " ".join(word() for _ in range(300))
    two = M.fingerprints(spark.createDataFrame([(0, text), (1, "x" + text)], "doc_id long, text string")).collect()
    pair = spark.createDataFrame([(two[0][1], two[0][2], two[1][1], two[1][2])], "a string, a_leaves array<string>, b string, b_leaves array<string>")
    assert pair.select(M.likeness("a", "b").alias("x")).first()["x"] > .9


def test_leaves_cover_the_text(spark):
    df = spark.createDataFrame([(i, t or "") for i, t in enumerate(texts(random.Random(6), 20))], "doc_id long, text string")
    for r in M.fingerprints(df).join(df, F.col("id") == F.col("doc_id")).select(
            F.char_length("text").alias("n"), M._length(F.col("fingerprint_leaves")).alias("m")).collect():
        assert r["n"] == r["m"]
