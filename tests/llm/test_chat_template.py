"""Templates: compiling, folding, the sandbox, and exact round trips."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martlake.llm import chat_template as C

PIECES = ["\\", "### ", "###", "</turn>", "</turn>\n", ":\n", ":", "\n", "a", "é\U0001f600", " ", "</", "\\### ", "#", "<"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


def out(source, turns):
    return "".join(t for t, _ in C.compile_template(source)(iter(turns)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.just("assistant"), TEXT), TEXT), max_size=5), st.integers(1, 7))
def test_round_trip(turns, step):
    segments = list(C.compile_template(C.TEMPLATE)(iter(turns)))
    whole = "".join(t for t, _ in segments)
    assert C.read_back(whole) == turns
    # Unescaped control strings are the template's alone.
    reader = C.ReadBack()
    for t, g in segments:
        if g:
            reader.feed(t, True)
        else:
            for k in range(0, len(t), step):
                reader.feed(t[k:k + step], False)
    reader.close()
    assert reader.n_turns == len(turns)
    assert reader.turns.hexdigest() == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    assert (reader.loss_chars, reader.loss.hexdigest()) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_language():
    t = [("user", " Hi "), ("assistant", "Yo")]
    assert out("{% for turn in turns %}{{ loop.index }}{{ turn.text|trim|upper }}{% if loop.first %},{% else %}.{% endif %}{% endfor %}!", t) == "1HI,2YO.!"
    assert out("{% for turn in turns %}{% if turn.role == 'user' and not loop.first %}a{% elif turn.role != \"user\" or false %}b{% else %}c{% endif %}{% endfor %}", t) == "cb"
    assert out("{{ 1 + 2 }}{{ 'a' + 1 }}{{ ('x' + 'y')|upper }}{{ true }}", t) == "3a1XYtrue"
    marks = list(C.compile_template("{% for turn in turns %}{% generation %}{{ turn.text }}{% endgeneration %};{% endfor %}")(iter(t)))
    assert marks == [(" Hi ", True), (";", False), ("Yo", True), (";", False)]


def test_folding():
    tree = C.fold(C.parse("a{{ 'b' + 1 }}{% if 1 == 1 %}c{% else %}d{% endif %}{% if false %}e{% endif %}{{ 'f'|upper }}"))
    assert tree == (C.Emit(C.Const("ab1cF")),)
    tree = C.fold(C.parse(C.TEMPLATE))
    assert isinstance(tree[0], C.For) and tree[0].body[1] == C.Emit(C.Const(":\n"))


@pytest.mark.parametrize("source", [
    "{{ turn.text }}", "{{ turn.text.__class__ }}", "{{ __import__ }}", "{{ 'a'|eval }}", "{{ f('a') }}", "{{ }}",
    "{% for x in turns %}{% endfor %}", "{% for turn in turns %}", "{% if 1 %}a", "{% while 1 %}", "{{ 'a }}",
    "{% for turn in turns %}{% for turn in turns %}{% endfor %}{% endfor %}", "{% endif %}", "{{ 1 2 }}", "{{ (1 }}"])
def test_sandbox_and_errors(source):
    with pytest.raises(C.TemplateError):
        C.compile_template(source)


ROWS = [(1, 1, "assistant", "b\n"), (1, 0, "user", "a"), (2, 0, None, None), (2, None, "system", "\\"), (3, 0, "assistant", "x" * 30000),
        (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (None, 0, "user", "n"), (5, 0, "a:\n### </turn>", "### "),
        (-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def test_tables(spark):
    df = spark.createDataFrame([(*r, 1, "g") for r in ROWS],
                               "conv_id long, turn long, role string, text string, conv long, generated string").repartition(3)
    got = {r["conv"]: r for r in C.formatted_digests(df).collect()}
    full = {}
    for r in C.format_conversations(df).orderBy("conv", "segment").collect():
        full.setdefault(r["conv"], []).append(r)
    assert set(got) == {r[0] for r in ROWS}
    for conv in got:
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in ROWS if c == conv))
        turns = [(r, x) for _, _, r, x in own]
        whole = "".join(s["text"] for s in full[conv])
        assert C.read_back(whole) == turns
        loss = "".join(x for r, x in turns if r == "assistant")
        g = got[conv]
        assert g["n_turns"] == len(turns) and g["formatted_chars"] == len(whole) and g["loss_chars"] == len(loss)
        assert g["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert g["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert "".join(C.unescape(s["text"]) for s in full[conv] if s["generated"]) == loss
    assert C.formatted_digests(df.limit(0)).count() == C.format_conversations(df.limit(0)).count() == 0
    assert C.format_conversations(df, "fixed").count() == len(got)
