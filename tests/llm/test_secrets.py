"""Secret spans against a plain scan, and links only where parts co-occur."""

import random
import re

from martlake.llm import secrets as X

SCHEMA = "doc_id long, text string, spans string, rid long, kind string"
FLAGS = {k: re.compile(v[2].replace("(?i:", "(?ai:"), re.ASCII) for k, v in X.KINDS.items()}


def brute(text, scope=X.SCOPE):
    spans = []
    for kind, rx in FLAGS.items():
        for m in rx.finditer(text):
            if kind == "assign" and len(m[2]) < 6:
                continue
            if kind == "weak" and not (re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])):
                continue
            spans.append((m.start(), X.KINDS[kind][0], kind, m.end()))
    out = []
    for s, rank, kind, e in spans:
        if kind in X.STRONG:
            out.append((s, rank, kind, e))
            continue
        near = [o for o in spans if o[3] > s - scope and o[0] < e + scope]
        apart = [o for o in near if o[3] <= s or o[0] >= e]
        if any(o not in apart and o[2] in X.STRONG for o in near):
            continue
        roles = {X.KINDS[o[2]][1] for o in apart} | {X.KINDS[kind][1]}
        if {"identifier", "secret"} <= roles:
            out.append((s, rank, kind, e))
    return sorted(out)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "s", 1, "k") for i, t in rows], SCHEMA).repartition(3)
    return sorted(((r["id"], [tuple(x) for x in r["spans"]]) for r in X.secret_spans(df, **kw).collect()), key=repr)


PARTS = ["password=abc123", 'token = "deadbeef00"', "API_KEY: x", "apikey='zzzzzz'", "AKIA" + "Q7" * 8, "AKIA123",
         "0123456789abcdef01234567", "0123456789abcdef0123", "user=alice", "login: bob_1", "key_id=AKIA" + "Z" * 16,
         "https://db.example.com/x", "db.example.com:5432", "Zm9vYmFy12345678", "é\U0001f600", "word", "secret:secret: abcdef",
         "token:token: abcdefgh", "\n", "AKIAAKIA" + "A" * 14, "x" * 150]


def test_against_a_plain_scan(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))) for i in range(150)]
    rows += [(900, None), (901, ""), (None, "user=alice password=abc123"), (7, rows[7][1])]
    assert got(spark, rows) == sorted([(i, brute(t or "")) for i, t in rows], key=repr)


def test_weak_parts_need_their_complements(spark):
    far = " " * 300
    rows = [(1, "user=alice"), (2, "user=alice Zm9vYmFy12345678"), (3, "Zm9vYmFy12345678"),
            (4, "https://a.example/x password=abc123"), (5, "https://a.example/x user=al1 password=abc123"),
            (6, "user=alice" + far + "password=abc123"), (7, "key_id=AKIA" + "Z" * 16 + " token=abcdef1")]
    kinds = {i: [s[2] for s in spans] for i, spans in got(spark, rows)}
    assert kinds == {1: [], 2: ["ident", "weak"], 3: [], 4: ["assign"], 5: ["endpoint", "ident", "assign"],
                     6: ["assign"], 7: ["access", "assign"]}


def test_many_and_long_spans(spark):
    text = "\n".join("user=u%d token=%s" % (i, "ab" * 8) for i in range(3000)) + " " + "f" * 20000
    assert got(spark, [(1, text)]) == [(1, brute(text))]


def test_empty_table(spark):
    assert X.secret_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0
