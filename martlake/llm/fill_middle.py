"""Fill-in-middle transformation by block rotation in place.

A text is units (the blanks before a word with it, or blanks that end the
text). Two cuts between units, drawn from a hash of the id, part it into
prefix, middle and suffix. The cuts come from one scan for the ends of words;
all separators are ASCII, so UTF-8 bytes are scanned as they are.

The text is rearranged within one bytearray: a sentinel is inserted in front
of each part, and two neighbouring blocks are exchanged by three reversals
(each of them, then both together), which need no second text:

    <P>prefix<M>middle<S>suffix
    psm: the last two blocks change places: <P>prefix<S>suffix<M>middle
    spm: the suffix changes places with the rest: <S>suffix<P>prefix<M>middle

``restored`` finds the sentinels, turns the same rotation back and deletes
them. It is exact, since a text that holds a sentinel stays plain, and since
a sentinel begins with the only ``<`` in it, none can arise at a seam.

Defined results: a null text counts as empty; texts without units and texts
that hold a sentinel are plain; a null id is hashed as the empty string; rows
that repeat are rearranged alike; texts of any length are rearranged whole, in
a few times their own memory; an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ship, text_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
#: Of 100 texts so many are rearranged, and of 100 of these so many suffix first.
RATE, SUFFIX_FIRST = 50, 80
#: Bytes that a reversal holds beside the text.
STEP = 1 << 16

OUTPUT = "id long, n long, form string, prefix_chars long, middle_chars long, output string"


# --- rotations ----------------------------------------------------------------

def reverse(view: np.ndarray, begin: int, end: int, step: int = STEP) -> None:
    """Reverses ``view[begin:end]`` in place, a step from both ends at a time."""
    while end - begin > 1:
        n = min(step, (end - begin) // 2)
        front = view[begin:begin + n][::-1].copy()
        view[begin:begin + n] = view[end - n:end][::-1]
        view[end - n:end] = front
        begin, end = begin + n, end - n


def rotate(buffer: bytearray, begin: int, middle: int, end: int) -> None:
    """Exchanges ``buffer[begin:middle]`` and ``buffer[middle:end]``."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, begin, middle)
    reverse(view, middle, end)
    reverse(view, begin, end)


def arranged(text: bytes, first: int, second: int, form: str) -> bytearray:
    """``text``, cut at the bytes ``first`` and ``second``, in the ``form``."""
    buffer = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def restored(output: bytes, form: str) -> bytes:
    """The text that ``output`` was made from."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "psm":
        rotate(buffer, buffer.index(SUFFIX), buffer.index(MIDDLE), len(buffer))
    else:
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(sentinel)
        del buffer[at:at + len(sentinel)]
    return bytes(buffer)


# --- cuts ---------------------------------------------------------------------

def unit_ends(text: bytes) -> np.ndarray:
    """The byte behind each unit."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    return np.append(np.flatnonzero(~blank[:-1] & blank[1:]) + 1, len(data))


def n_chars(text: bytes) -> int:
    return len(text) - int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 == 0x80))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2^32 from the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(doc_id: int | None, text: bytes, seed: int, rate: int, suffix_first: int) -> tuple:
    """The row of ``OUTPUT`` for one text."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return doc_id, n, "plain", None, None, text
    units = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = (int(ends[u - 1]) if u else 0 for u in units)
    form = "spm" if h4 % 100 < suffix_first else "psm"
    return (doc_id, n, form, n_chars(text[:first]), n_chars(text[first:second]),
            bytes(arranged(text, first, second, form)))


# --- on Spark -----------------------------------------------------------------

def _utf8(values) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _transform_batches(seed: int, rate: int, suffix_first: int):
    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            rows = [transform(i, t.as_py(), seed, rate, suffix_first) for i, t in zip(b.column("id").to_pylist(), texts)]
            ids, n, form, prefix, middle, output = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), _utf8(output)],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n`` (units), ``form`` (plain, psm
    or spm), ``prefix_chars`` and ``middle_chars`` (null if plain), ``output``.
    Moves no rows."""
    ship(docs.sparkSession)
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(f"`{text_col}`").alias("text"))
            .mapInArrow(_transform_batches(seed, rate, suffix_first), OUTPUT))


def _restore_batches(form_col: str, output_col: str, to: str):
    def run(batches):
        for b in batches:
            texts = [restored(t.as_py(), f) for f, t in zip(
                b.column(form_col).to_pylist(), b.column(output_col).cast(pa.binary()))]
            yield pa.RecordBatch.from_arrays([*b.columns, _utf8(texts)], [*b.schema.names, to])
    return run


def restored_texts(rearranged: DataFrame, form_col: str = "form", output_col: str = "output",
                   to: str = "restored") -> DataFrame:
    """``rearranged`` with the exact text rebuilt from output and form alone."""
    ship(rearranged.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rearranged.schema.fields)
    return rearranged.mapInArrow(_restore_batches(form_col, output_col, to), f"{schema}, `{to}` string")
