"""Chat formatting by compiled templates.

A template is compiled in three steps: ``parse`` reads it into a syntax tree,
``fold`` joins neighbouring texts and evaluates what holds constants only, and
``compile_template`` turns the tree into closures that render one turn after
the other. The language has texts, ``{{ expression }}``,
``{% if e %} .. {% elif e %} .. {% else %} .. {% endif %}``,
``{% for turn in turns %} .. {% endfor %}`` and
``{% generation %} .. {% endgeneration %}``, which marks what the model is to
produce (the loss mask). Expressions have strings, whole numbers, names,
``turn.role``, ``turn.text``, ``loop.first`` and ``loop.index``, ``==``,
``!=``, ``+``, ``and``, ``or``, ``not``, parentheses, and the filters listed in
``FILTERS``. It is sandboxed: nothing but these names, fields and filters can
be reached, there are no calls, and the only loop is over the turns.

``escape`` makes texts safe: in an escaped text, a backslash stands in front of
every backslash and of the first character of every control string, so control
strings occur unescaped only where the template put them. ``read_back`` undoes
it and gives the turns again.

Turns are rendered as they come, so a conversation of any length needs the
memory of one turn. Spark deals conversations by id and sorts their turns.

Defined results: a null text or role counts as empty; null turns come first;
turns with equal numbers are ordered by role, then text; a null conversation
id is one conversation; an empty table gives no rows; further columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ship, text_of

#: Control strings of the template below, the end of a turn last.
TURN, TEXT, END = "### ", ":\n", "</turn>\n"
CONTROL = (TURN, "</turn>")
TEMPLATE = ("{% for turn in turns %}{{ '### ' + turn.role|escape_role }}{{ ':' + '\\n' }}"
            "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text|escape }}{% endgeneration %}"
            "{% else %}{{ turn.text|escape }}{% endif %}{{ '</turn>' + '\\n' }}{% endfor %}")
_CONTROL = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_ROLE = re.compile(r"\\|:|\n|" + "|".join(map(re.escape, CONTROL)))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    """As ``escape``; a colon and a line feed, which end a role, too."""
    return _ROLE.sub(lambda m: "\\" + m[0], role)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "escape_role": escape_role, "upper": str.upper, "lower": str.lower, "trim": str.strip}


# --- syntax tree ------------------------------------------------------------

class TemplateError(ValueError):
    pass


class Const(NamedTuple):
    value: object


class Field(NamedTuple):
    path: str


class Filter(NamedTuple):
    name: str
    of: object


class Not(NamedTuple):
    of: object


class Binary(NamedTuple):
    op: str
    left: object
    right: object


class Emit(NamedTuple):
    of: object


class If(NamedTuple):
    cases: tuple  # of (condition, body)
    other: tuple


class For(NamedTuple):
    body: tuple


class Generation(NamedTuple):
    body: tuple


FIELDS = ("turn.role", "turn.text", "loop.first", "loop.index")
_TOKENS = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)"""
                     r"""|(?P<name>[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)|(?P<op>==|!=|[+|()]))""")
_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def _take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def parse(self):
        tree = self._either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def _either(self):
        left = self._both()
        while self._take("or"):
            left = Binary("or", left, self._both())
        return left

    def _both(self):
        left = self._negated()
        while self._take("and"):
            left = Binary("and", left, self._negated())
        return left

    def _negated(self):
        return Not(self._negated()) if self._take("not") else self._compared()

    def _compared(self):
        left = self._sum()
        op = self._take("==", "!=")
        return Binary(op, left, self._sum()) if op else left

    def _sum(self):
        left = self._filtered()
        while self._take("+"):
            left = Binary("+", left, self._filtered())
        return left

    def _filtered(self):
        of = self._atom()
        while self._take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            of = Filter(name, of)
        return of

    def _atom(self):
        if self._take("("):
            inner = self._either()
            if not self._take(")"):
                raise TemplateError("missing )")
            return inner
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if kind == "int":
            return Const(int(value))
        if kind == "name" and value in ("true", "false"):
            return Const(value == "true")
        if kind == "name" and value in FIELDS:
            return Field(value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.DOTALL)
    body, at = _parse_block([p for p in parts if p], 0, (), False)
    assert at == len([p for p in parts if p])
    return body


def _parse_block(parts: list[str], at: int, ends: tuple[str, ...], in_loop: bool):
    """Nodes from ``parts[at]`` to a tag that begins with one of ``ends``."""
    out = []
    while at < len(parts):
        part = parts[at]
        if part.startswith("{{"):
            out.append(Emit(_checked(_Expression(part[2:-2]).parse(), in_loop)))
            at += 1
        elif not part.startswith("{%"):
            out.append(Emit(Const(part)))
            at += 1
        else:
            tag = part[2:-2].strip()
            word = tag.split(None, 1)[0] if tag else ""
            if word in ends:
                return tuple(out), at
            if word == "if":
                node, at = _parse_if(parts, at, in_loop)
            elif word == "for":
                if in_loop or not re.fullmatch(r"for\s+turn\s+in\s+turns", tag):
                    raise TemplateError(f"the only loop is 'for turn in turns': {tag!r}")
                inner, at = _parse_block(parts, at + 1, ("endfor",), True)
                node, at = For(inner), _closed(parts, at, "endfor")
            elif tag == "generation":
                inner, at = _parse_block(parts, at + 1, ("endgeneration",), in_loop)
                node, at = Generation(inner), _closed(parts, at, "endgeneration")
            else:
                raise TemplateError(f"unexpected tag {tag!r}")
            out.append(node)
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return tuple(out), at


def _closed(parts, at: int, tag: str) -> int:
    if parts[at][2:-2].strip() != tag:
        raise TemplateError(f"unexpected {parts[at]!r}")
    return at + 1


def _parse_if(parts, at: int, in_loop: bool):
    cases, other, tag = [], (), parts[at][2:-2].strip()
    while True:
        word, _, condition = tag.partition(" ")
        if word == "else":
            other, at = _parse_block(parts, at + 1, ("endif",), in_loop)
            return If(tuple(cases), other), _closed(parts, at, "endif")
        test = _checked(_Expression(condition).parse(), in_loop)
        body, at = _parse_block(parts, at + 1, ("elif", "else", "endif"), in_loop)
        cases.append((test, body))
        tag = parts[at][2:-2].strip()
        if tag == "endif":
            return If(tuple(cases), other), at + 1


def _checked(tree, in_loop: bool):
    if isinstance(tree, Field) and not in_loop:
        raise TemplateError(f"{tree.path} is known inside the loop only")
    for child in tree if isinstance(tree, tuple) else ():
        if isinstance(child, tuple):
            _checked(child, in_loop)
    return tree


# --- folding ----------------------------------------------------------------

def fold(nodes: tuple) -> tuple:
    """The tree without what can be known now: constant expressions are
    evaluated, decided branches replaced, neighbouring texts joined."""
    out: list = []
    for node in nodes:
        if isinstance(node, Emit):
            new = [Emit(fold_expression(node.of))]
        elif isinstance(node, For):
            new = [For(fold(node.body))]
        elif isinstance(node, Generation):
            new = [Generation(fold(node.body))]
        else:
            cases, other = [], fold(node.other)
            for test, body in node.cases:
                test = fold_expression(test)
                if isinstance(test, Const):
                    if test.value:
                        other = fold(body)
                        break
                    continue
                cases.append((test, fold(body)))
            new = [If(tuple(cases), other)] if cases else list(other)
        for n in new:
            if isinstance(n, Emit) and isinstance(n.of, Const):
                if n.of.value == "":
                    continue
                if out and isinstance(out[-1], Emit) and isinstance(out[-1].of, Const):
                    out[-1] = Emit(Const(_string(out[-1].of.value) + _string(n.of.value)))
                    continue
            out.append(n)
    return tuple(out)


def fold_expression(tree):
    if isinstance(tree, Filter):
        tree = Filter(tree.name, fold_expression(tree.of))
        known = isinstance(tree.of, Const)
    elif isinstance(tree, Not):
        tree = Not(fold_expression(tree.of))
        known = isinstance(tree.of, Const)
    elif isinstance(tree, Binary):
        tree = Binary(tree.op, fold_expression(tree.left), fold_expression(tree.right))
        known = isinstance(tree.left, Const) and isinstance(tree.right, Const)
    else:
        return tree
    return Const(_value(tree)({})) if known else tree


# --- closures ---------------------------------------------------------------

def _string(value: object) -> str:
    return value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def _plus(a, b):
    return a + b if isinstance(a, int) and isinstance(b, int) else _string(a) + _string(b)


_OPS = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": _plus,
        "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def _value(tree) -> Callable[[dict], object]:
    if isinstance(tree, Const):
        value = tree.value
        return lambda env: value
    if isinstance(tree, Field):
        path = tree.path
        return lambda env: env[path]
    if isinstance(tree, Filter):
        f, of = FILTERS[tree.name], _value(tree.of)
        return lambda env: f(_string(of(env)))
    if isinstance(tree, Not):
        of = _value(tree.of)
        return lambda env: not of(env)
    op, left, right = _OPS[tree.op], _value(tree.left), _value(tree.right)
    return lambda env: op(left(env), right(env))


Segments = Iterator[tuple[str, bool]]


def _body(nodes: tuple, generated: bool) -> Callable[[dict], Segments]:
    run = [_node(n, generated) for n in nodes]

    def body(env: dict) -> Segments:
        for r in run:
            yield from r(env)
    return body


def _node(node, generated: bool) -> Callable[[dict], Segments]:
    if isinstance(node, Emit):
        value = _value(node.of)

        def emit(env):
            yield _string(value(env)), generated
        return emit
    if isinstance(node, Generation):
        return _body(node.body, True)
    if isinstance(node, If):
        cases = [(_value(t), _body(b, generated)) for t, b in node.cases]
        other = _body(node.other, generated)

        def choose(env):
            for test, body in cases:
                if test(env):
                    return body(env)
            return other(env)
        return choose
    body = _body(node.body, generated)

    def loop(env):
        for n, (role, text) in enumerate(env["turns"]):
            env.update({"turn.role": role, "turn.text": text, "loop.first": n == 0, "loop.index": n + 1})
            yield from body(env)
    return loop


def compile_template(source: str) -> Callable[[Iterator[tuple[str, str]]], Segments]:
    """A function from turns (role, text) to segments (text, generated),
    which are made as the turns come."""
    body = _body(fold(parse(source)), False)
    return lambda turns: body({"turns": turns})


# --- reading back -----------------------------------------------------------

class ReadBack:
    """Reads the turns back from the output of ``TEMPLATE``, piece by piece.

    Holds the piece at hand and what of a control string its end may begin.
    """

    _STOP = re.compile(r"\\.|:\n|</turn>\n", re.DOTALL)

    def __init__(self):
        self.n_turns = self.loss_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self._rest, self._where = "", "turn"

    def feed(self, piece: str, generated: bool) -> None:
        if generated:
            text = unescape(piece)
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        s, at = self._rest + piece, 0
        while True:
            if self._where == "turn":
                if len(s) - at < len(TURN):
                    break
                if not s.startswith(TURN, at):
                    raise ValueError("a turn does not begin where one must")
                at += len(TURN)
                self._where = "role"
                self.n_turns += 1
            stop = TEXT if self._where == "role" else END
            m = next((m for m in self._STOP.finditer(s, at) if m[0] == stop), None)
            keep = len(s) - len(END) if m is None else m.start()
            if m is None:
                keep = self._whole(s, at, keep)
            self._put(s[at:keep] if keep > at else "")
            at = max(at, keep)
            if m is None:
                break
            self._put_end()
            at = m.end()
        self._rest = s[at:]

    @staticmethod
    def _whole(s: str, at: int, to: int) -> int:
        """``to``, or one less if it would cut an escaped character."""
        slashes = 0
        while to - slashes > at and s[to - slashes - 1] == "\\":
            slashes += 1
        return to - slashes % 2

    def _put(self, part: str) -> None:
        self.turns.update(unescape(part).encode())

    def _put_end(self) -> None:
        self.turns.update(b"\n")
        self._where = "text" if self._where == "role" else "turn"

    def close(self) -> None:
        if self._where != "turn" or self._rest:
            raise ValueError("the output ends inside a turn")


def read_back(output: str) -> list[tuple[str, str]]:
    """The turns of a whole output of ``TEMPLATE``."""
    out, at = [], 0
    while at < len(output):
        if not output.startswith(TURN, at):
            raise ValueError("a turn does not begin where one must")
        at += len(TURN)
        parts = []
        for stop in (TEXT, END):
            m = next(m for m in ReadBack._STOP.finditer(output, at) if m[0] == stop)
            parts.append(unescape(output[at:m.start()]))
            at = m.end()
        out.append(tuple(parts))
    return out


# --- on tables --------------------------------------------------------------

def _turn_rows(batches):
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in ("conv", "role", "text")))


def _conversations(batches):
    """(id, turns) for each conversation of rows sorted by it."""
    rows = _turn_rows(batches)
    head = next(rows, None)
    while head is not None:
        conv = head[0]

        def turns():
            nonlocal head
            while head is not None and head[0] == conv:
                role, text = head[1], head[2]
                head = next(rows, None)
                yield role, text
        own = turns()
        yield conv, own
        for _ in own:  # what a template without a loop leaves
            pass


def _sorted_turns(conversations: DataFrame, id_col, turn_col, role_col, text_col) -> DataFrame:
    return (conversations.select(
        F.col(f"`{id_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        text_of(f"`{role_col}`").alias("role"), text_of(f"`{text_col}`").alias("text"))
        .repartition("conv").sortWithinPartitions("conv", "turn", "role", "text"))


def format_conversations(conversations: DataFrame, template: str = TEMPLATE, id_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The formatted texts in rows of one segment: ``conv``, ``segment`` (its
    number in the conversation), ``text`` and ``generated`` (under the mask)."""
    ship(conversations.sparkSession)
    compile_template(template)

    def run(batches):
        render = compile_template(template)
        rows = []
        for conv, turns in _conversations(batches):
            for n, (text, generated) in enumerate(render(turns)):
                rows.append((conv, n, text, generated))
                if len(rows) >= 1000:
                    yield _batch(rows)
                    rows = []
        yield _batch(rows)

    def _batch(rows):
        cols = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.bool_()))],
            ["conv", "segment", "text", "generated"])

    return (_sorted_turns(conversations, id_col, turn_col, role_col, text_col)
            .mapInArrow(run, "conv long, segment long, text string, generated boolean"))


def formatted_digests(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Formats every conversation with ``TEMPLATE``, reads the output back as
    it is made and gives digests of what was read: ``conv``, ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``."""
    ship(conversations.sparkSession)

    def run(batches):
        render = compile_template(TEMPLATE)
        rows = []
        for conv, turns in _conversations(batches):
            reader, chars = ReadBack(), 0
            for text, generated in render(turns):
                reader.feed(text, generated)
                chars += len(text)
            reader.close()
            rows.append((conv, reader.n_turns, reader.turns.hexdigest(), reader.loss_chars,
                         reader.loss.hexdigest(), chars))
            if len(rows) >= 5000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)

    def _batch(rows):
        cols = list(zip(*rows)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, kinds)],
            ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return (_sorted_turns(conversations, id_col, turn_col, role_col, text_col)
            .mapInArrow(run, "conv long, n_turns long, turns_sha256 string, loss_chars long,"
                             " loss_sha256 string, formatted_chars long"))
