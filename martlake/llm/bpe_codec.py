"""Byte-pair encoding and decoding with an index of pair occurrences.

Texts are cut into pre-tokens as the vocabulary's byte-level pre-tokenizer
does. The pre-tokens of a block of a partition that the worker has not met yet
are laid out one behind the other as one list of tokens, doubly linked within
each pre-token. The index maps each pair of neighbours that has a rank to all
its positions in that list. The active ranks are applied in ascending order,
each to all its positions at once: the pair becomes one token, and only the
neighbours of these positions get new pairs, whose positions are entered under
their own ranks. A pair that two earlier merges have broken is told by its
tokens; of overlapping positions of one pair (``aaa``) every second is taken
from the left.

Ascending order is exact where a merge makes its token before any merge can
use it, as in every trained list of merges; ``check`` refuses others.

What the workers met is kept as ids by pre-token, up to ``CACHE_SIZE``.

Pre-tokens are cut by a regular expression where it must agree with the
tokenizers library: texts of characters whose classes every version of Unicode
shares. All other texts are cut by the library's pre-tokenizer.

Decoding joins the bytes of the ids and reads them as UTF-8, with U+FFFD for
what is none; ids that the vocabulary lacks are skipped, as the library does.

Defined results: a null text counts as empty and has no ids; special strings
inside texts are their own ids; rows that repeat are encoded alike; a null
list of ids is the empty text; an empty table gives no rows; further columns
are not read. Long texts are encoded in parts that end before a blank; one
pre-token is encoded whole, in about 150 times its bytes of memory.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ship, text_of

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the pre-tokens of the byte-level pre-tokenizer.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters outside the ranges whose classes every version of Unicode shares.
UNUSUAL = regex.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
#: No pre-token holds a sign and the blank behind it.
BORDER = regex.compile(r"(?<=[!-~])(?=[ \n])")
#: Characters of a text's part and of a block of new pre-tokens; pre-tokens that a worker keeps, and their longest.
BLOCK = 1 << 20
CACHE_SIZE = 300_000
LONG_WORD = 100
_NO_RANK = np.iinfo(np.int64).max


def byte_signs() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself where
    it can be seen, else the next one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(seen)]
    signs = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [signs[b] for b in range(256)]


class PairIndex:
    """All positions of the pairs of a block, by rank."""

    def __init__(self, codec: "Codec", words: list[bytes]):
        self.codec = codec
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        self.ends = np.cumsum(lengths)
        self.tokens = np.append(codec.first[data], codec.guard)
        # Position n stands before the first and behind the last token of each word.
        self.after = np.arange(1, n + 2)
        self.before = np.arange(-1, n)
        self.after[self.ends - 1] = self.after[n] = self.before[0] = n
        self.before[self.ends] = n
        self.positions: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.enter(np.arange(n))

    def enter(self, at: np.ndarray) -> None:
        """No position comes twice with one pair: tokens only grow."""
        ranks = self.codec.ranks_of(self.tokens[at], self.tokens[self.after[at]])
        known = np.flatnonzero(ranks != _NO_RANK)
        if not len(known):
            return
        at, ranks = at[known], ranks[known]
        order = ranks.argsort(kind="stable")
        at, ranks = at[order], ranks[order]
        starts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()]
        for rank, begin, end in zip(ranks[starts].tolist(), starts, [*starts[1:], len(at)]):
            known = self.positions.get(rank)
            if known is None:
                self.positions[rank] = [at[begin:end]]
                heapq.heappush(self.active, rank)
            else:
                known.append(at[begin:end])

    def merge(self, rank: int) -> None:
        left, right, whole = self.codec.merges[rank]
        tokens, after, before = self.tokens, self.after, self.before
        at = np.concatenate(self.positions.pop(rank))
        at.sort()
        at = at[(tokens[at] == left) & (tokens[after[at]] == right)]
        if not len(at):
            return
        if left == right:
            number = np.arange(len(at))
            follows = np.append(False, after[at[:-1]] == at[1:])
            at = at[(number - np.maximum.accumulate(np.where(follows, 0, number))) % 2 == 0]
        gone = after[at]
        behind = after[gone]
        tokens[at], tokens[gone] = whole, self.codec.guard
        after[at], before[behind] = behind, at
        front = before[at]
        new = front < len(after) - 1
        new[1:] &= front[1:] != at[:-1]  # entered as a merged position already
        self.enter(np.concatenate([front[new], at]))

    def run(self) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers."""
        while self.active:
            self.merge(heapq.heappop(self.active))
        alive = self.tokens[:-1] != self.codec.guard
        ids = self.tokens[:-1][alive].astype("<i4").tobytes()
        ends = (4 * np.cumsum(alive)[self.ends - 1]).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Codec:
    """Encodes by one vocabulary."""

    def __init__(self, path: str, cache_size: int = CACHE_SIZE, block: int = BLOCK):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.check_kind(spec)
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_ids = {s: i.to_bytes(4, "little") for s, i in self.special.items()}
        self.special_pattern = regex.compile("|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.guard = max([*vocabulary.values(), *self.special.values()]) + 1
        self.first = np.array([vocabulary[sign] for sign in byte_signs()])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left, self.right, self.whole = (np.array(x, np.int64) for x in (
            [vocabulary[a] for a, _ in pairs], [vocabulary[b] for _, b in pairs], [vocabulary[a + b] for a, b in pairs]))
        self.merges = list(zip(self.left.tolist(), self.right.tolist(), self.whole.tolist()))
        keys = self.left * (self.guard + 1) + self.right
        order = np.argsort(keys)
        self.keys, self.order = np.append(keys[order], _NO_RANK), np.append(order, _NO_RANK)
        self.check_merges()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.cache_size = cache_size
        self.block = block

    @staticmethod
    def check_kind(spec: dict) -> None:
        """Raise unless texts are cut and encoded as this module does."""
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                               "byte_fallback", "ignore_merges"))
        added = any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if not (plain and model["type"] == "BPE" and spec["normalizer"] is None and not added and cut.get("use_regex")
                and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space")):
            raise ValueError("not a plain byte-level vocabulary")

    def check_merges(self) -> None:
        """Raise unless a token is made before a merge can use it."""
        made = np.full(self.guard + 1, -1)
        np.maximum.at(made, self.whole, np.arange(len(self.whole)))
        rank = np.arange(len(self.whole))
        if np.any(made[self.left] >= rank) or np.any(made[self.right] >= rank):
            raise ValueError("a merge uses a token that a later merge makes")

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * (self.guard + 1) + right
        at = self.keys.searchsorted(keys)
        return np.where(self.keys[at] == keys, self.order[at], _NO_RANK)

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if UNUSUAL.search(text):
            return [text[a:b] for _, (a, b) in self.cut(text)]
        return PATTERN.findall(text)

    def parts(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens and special strings of a text, part by part."""
        at = 0
        for m in self.special_pattern.finditer(text):
            yield from self._plain_parts(text, at, m.start())
            yield [m.group()]
            at = m.end()
        yield from self._plain_parts(text, at, len(text))

    def _plain_parts(self, text: str, at: int, end: int) -> Iterator[list[str]]:
        while end - at > self.block:
            m = BORDER.search(text, at + self.block, end)
            if m is None:
                break
            yield self.words(text[at:m.start()])
            at = m.start()
        if at < end:
            yield self.words(text[at:end])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        out, group, size = [], [], 0
        for n, text in enumerate(texts, 1):
            group.append(text)
            size += len(text)
            if size >= 4 * self.block or n == len(texts):
                out += self._encode_group(group)
                group, size = [], 0
        return out

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        coded = [[np.fromiter(map(number.__getitem__, words), np.int32, len(words)) for words in self.parts(text)]
                 for text in texts]
        table = self.ids_of(list(number))
        return [b"".join(b"".join(map(table.__getitem__, part.tolist())) for part in parts) for parts in coded]

    def ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of each of the distinct ``words``."""
        found = [self.young.get(w) or self.old.get(w) or self.special_ids.get(w) for w in words]
        block, size = [], 0
        missing = [i for i, ids in enumerate(found) if ids is None]
        for n, i in enumerate(missing, 1):
            block.append(i)
            size += len(words[i])
            if size >= self.block or n == len(missing):
                for j, ids in zip(block, PairIndex(self, [words[j].encode() for j in block]).run()):
                    found[j] = ids
                block, size = [], 0
        # What was met lately is kept: all of the young, and the old until the young are as many.
        if len(self.young) + len(words) > self.cache_size // 2:
            self.young, self.old = {}, self.young
        self.young.update((w, ids) for w, ids in zip(words[:self.cache_size // 2], found) if len(w) <= LONG_WORD)
        return found


def decode_ids(pieces: dict[int, bytes], ids: np.ndarray) -> str:
    """The text of the ids."""
    found = []
    for begin in range(0, len(ids), BLOCK):
        known = map(pieces.get, ids[begin:begin + BLOCK].tolist())
        found.append(b"".join(p for p in known if p is not None))
    return b"".join(found).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One for each Python worker, kept between its tasks."""
    return Codec(path)


@functools.lru_cache(maxsize=2)
def pieces_of(path: str) -> dict[int, bytes]:
    """The bytes of each id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = {sign: b for b, sign in enumerate(byte_signs())}
    pieces = {i: bytes(byte_of[c] for c in token) for token, i in spec["model"]["vocab"].items()}
    return pieces | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}


# --- on Spark -----------------------------------------------------------------

def _encode_batches(path: str):
    def run(batches):
        encode = codec(path).encode_all
        for b in batches:
            ids = encode(b.column("text").to_pylist())
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
            values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["id", "ids"])
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``ids`` (array<int>) of every row; moves no rows. ``path``:
    the vocabulary file, which every worker can open."""
    ship(docs.sparkSession)
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(f"`{text_col}`").alias("text"))
            .mapInArrow(_encode_batches(path), "id long, ids array<int>"))


def _decode_batches(path: str, ids_col: str, to: str):
    def run(batches):
        pieces = pieces_of(path)
        for b in batches:
            lists = b.column(ids_col)
            values = lists.values.to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy()
            texts = [decode_ids(pieces, values[i:j]) for i, j in zip(ends, ends[1:])]
            kept = [n for n in b.schema.names if n != ids_col]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), pa.array(texts, pa.string())], [*kept, to])
    return run


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """``encoded`` with the texts of its ids (of ``ids_col``) in their place."""
    ship(encoded.sparkSession)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != ids_col]
    none = F.array().cast("array<int>")
    ids = F.coalesce(F.col(f"`{ids_col}`").cast("array<int>"), none).alias(ids_col)
    columns = [ids if n == ids_col else F.col(f"`{n}`") for n in encoded.columns]
    return encoded.select(*columns).mapInArrow(_decode_batches(path, ids_col, to), ", ".join([*kept, f"`{to}` string"]))
