"""Fill-in-middle: rotations, cuts and outputs against plain slices."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martlake.llm import fill_middle as M

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = st.text(alphabet=st.one_of(st.sampled_from(" \n\t<>PSMab\x1c\x85 é界😀"), st.characters(exclude_categories=["Cs"])), max_size=40)


def plain(doc_id, text):
    """The contract, by slices of the text."""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or h[2] % 100 >= 50 or any(s in text for s in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60), st.data(), st.integers(1, 7))
def test_rotation_exchanges_blocks(data, draw, step):
    cuts = sorted(draw.draw(st.integers(0, len(data))) for _ in range(3))
    buffer = bytearray(data)
    M.rotate(buffer, *cuts)
    a, b, c = cuts
    assert bytes(buffer) == data[:a] + data[b:c] + data[a:b] + data[c:]
    view = np.frombuffer(buffer, np.uint8)
    before = bytes(buffer)
    M.reverse(view, a, c, step)
    assert bytes(buffer) == before[:a] + before[a:c][::-1] + before[c:]


@settings(max_examples=500, deadline=None)
@given(st.integers(-5, 300), TEXTS)
def test_forms_and_exact_round_trip(doc_id, text):
    doc, n, form, p, m, out = M.transform(doc_id, text.encode(), 42, 50, 80)
    assert (doc, n, form, p, m, out.decode()) == plain(doc_id, text)
    assert M.restored(out, form).decode() == text


def test_every_form_at_every_cut():
    text = "a<b \n é> c<S d>".encode()
    ends = [0, *M.unit_ends(text).tolist()]
    for i, first in enumerate(ends):
        for second in ends[i:]:
            for form in ("psm", "spm"):
                assert M.restored(bytes(M.arranged(text, first, second, form)), form) == text


def test_documents(spark):
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (None, "one two three"), (None, "one two three"), (5, " \n "), (6, "a <P> b"), (7, "same x"),
            (7, "same x"), (8, "word " * 300_000), (9, "x" * 2_000_000), (10, " " * 2_000_000), (11, "é\n" * 500_000)]
    rows += [(20 + i, "".join(rng.choice("ab <>PSM\n界") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, output string").repartition(3)
    got = M.restored_texts(M.fill_in_middle(df)).collect()
    want = sorted((plain(i, t or "") for i, t in rows), key=repr)
    assert sorted((tuple(r)[:6] for r in got), key=repr) == want
    assert sorted(r["restored"] for r in got) == sorted(t or "" for _, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert M.restored_texts(M.fill_in_middle(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
