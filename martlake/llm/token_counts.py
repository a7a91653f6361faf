"""Token counts by a map-side two-tier lookup.

Texts are counted as the sentencepiece library counts them, without encoding
each text. A text falls into pre-tokens whose counts add up:

* U+2581 and the blank are one symbol to the model, and no piece has that
  symbol behind another character; so no merge crosses the start of a run of
  blanks, and a text can be cut there.
* No piece contains a line feed (it becomes a byte piece of its own), so a
  text can also be cut on both sides of each line feed, which counts 1.

``check_model`` tests these properties on the model's pieces and refuses a
model that lacks them.

Tier 1 is a compact table of the frequent pre-tokens with their numbers of
tokens, built from counts over all texts: each task keeps a bounded summary of
its pre-tokens of at most ``LONG_WORD`` characters (lossy counting: when the
summary is full, its rarer half goes) and passes on one row with at most twice
``table_size`` of them. These rows are merged in a tree, ``FAN_IN`` at a time,
into one of the same size: so pre-tokens are never dealt out by a shuffle, and no
task holds more than a few summaries. What they miss costs time, never a result.
Tier 2 encodes misses, once for each worker while its bounded cache holds them.

Defined results: a null text counts as empty and has 0 tokens; texts of blanks
alone, very long words (never cached) and all other texts count as the library
says; repeated rows repeat; an empty table gives no rows; further columns
are not read. Texts of any length are counted whole, with about 100 bytes for
each pre-token of one text.
"""

from __future__ import annotations

import functools
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ship, text_of, written

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
TABLE_SIZE = 40_000
#: Entries of a task's summary and of a worker's cache.
SUMMARY_SIZE = 400_000
CACHE_SIZE = 1_000_000
LONG_WORD = 200
#: Summaries that are merged at once.
FAN_IN = 16
BLANK = "▁"


@functools.lru_cache(maxsize=4)
def load_model(path: str):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    check_model(model)
    return model


@functools.lru_cache(maxsize=4)
def worker_cache(path: str) -> dict[str, int]:
    """The second tier: one for each Python worker, kept between its tasks."""
    return {}


def check_model(model) -> None:
    """Raise unless counts of pre-tokens add up to the count of the text."""
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if BLANK in piece.lstrip(BLANK) or "\n" in piece:
            raise ValueError(f"piece {piece!r} crosses a pre-token boundary")
    if model.encode("a▁b") != model.encode("a b") or len(model.encode("\n\n")) != 3:
        raise ValueError("the model normalises blanks or line feeds")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens other than line feeds, as the model must be given them.

    The model puts one blank in front of what it is given. So a run of blanks
    and the word behind it lose one blank; a run at the end of a line that is
    a single blank becomes "". A word that begins a line has no blank in front
    and is marked with a line feed. A text begins with the added blank.
    """
    out = []
    for n, line in enumerate(text.replace(BLANK, " ").split("\n")):
        parts = line.split(" ")
        if n:
            first = parts.pop(0)
            if first:
                out.append("\n" + first)
        out += _join_blanks(parts) if "" in parts else parts
    return out


def _join_blanks(parts: list[str]) -> list[str]:
    """Empty parts stand for further blanks in front of the next part."""
    out, lead = [], 0
    for p in parts:
        if p:
            out.append(" " * lead + p)
            lead = 0
        else:
            lead += 1
    if lead:
        out.append(" " * (lead - 1))
    return out


class TwoTierCounter:
    """Counts tokens by the broadcast table, a worker's cache, the library."""

    def __init__(self, path: str, table: dict[str, int], cache_size: int = CACHE_SIZE):
        self.model = load_model(path)
        self.table = table
        self.cache: dict[str, int] = {}
        self.cache_size = cache_size

    def encode(self, words: list[str]) -> list[int]:
        """Numbers of tokens of pre-tokens, by the library."""
        return [1 if not w else len(ids) - 2 if w[0] == "\n" else len(ids)
                for w, ids in zip(words, self.model.encode(words, num_threads=1))]

    def tokens(self, text: str) -> int:
        if not text:
            return 0
        words = pre_tokens(text)
        counts = list(map(self.table.get, words))
        total = text.count("\n")
        if None in counts:
            cache = self.cache
            missed = [w for w, n in zip(words, counts) if n is None]
            counts = [n for n in counts if n is not None]
            new = list({w for w in missed if w not in cache})
            fresh = dict(zip(new, self.encode(new))) if new else {}
            total += sum(fresh[w] if w in fresh else cache[w] for w in missed)
            if len(cache) + len(fresh) > self.cache_size:
                cache.clear()
            cache.update((w, n) for w, n in fresh.items() if len(w) <= LONG_WORD)
        return total + sum(counts)


SUMMARY = "part long, words array<string>, counts array<long>"


def most_frequent(seen: dict[str, int], size: int) -> dict[str, int]:
    """At most ``size`` of the most frequent words, without those that tie with
    the first one left out."""
    if len(seen) <= size:
        return seen
    counts = np.fromiter(seen.values(), np.int64, len(seen))
    cut = np.partition(counts, -size - 1)[-size - 1]
    return {w: n for w, n in seen.items() if n > cut}


def _summary(part: int, seen: dict[str, int], table_size: int) -> pa.RecordBatch:
    top = most_frequent(seen, 2 * table_size)
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([list(top)], pa.list_(pa.string())),
         pa.array([list(top.values())], pa.list_(pa.int64()))], ["part", "words", "counts"])


def _summaries(table_size: int, summary_size: int):
    def run(batches):
        seen: Counter = Counter()
        for b in batches:
            for t in b.column("text"):
                words = pre_tokens(t.as_py())
                if words and len(max(words, key=len)) > LONG_WORD:
                    words = [w for w in words if len(w) <= LONG_WORD]
                seen.update(words)
                if len(seen) > summary_size:
                    seen = Counter(dict(seen.most_common(summary_size // 2)))
        if seen:
            yield _summary(TaskContext.get().partitionId(), seen, table_size)
    return run


def _merged(table_size: int):
    def run(table: pa.Table) -> pa.Table:
        seen: Counter = Counter()
        for words, counts in zip(table.column("words"), table.column("counts")):
            for w, n in zip(words.as_py(), counts.as_py()):
                seen[w] += n
        return pa.Table.from_batches([_summary(table.column("part")[0].as_py() // FAN_IN, seen, table_size)])
    return run


def frequent_table(docs: DataFrame, path: str, text_col: str = "text",
                   table_size: int = TABLE_SIZE, summary_size: int = SUMMARY_SIZE) -> dict[str, int]:
    """At most ``table_size`` frequent pre-tokens with their token counts."""
    ship(docs.sparkSession)
    rows = written(docs.select(text_of(f"`{text_col}`").alias("text"))
                   .mapInArrow(_summaries(table_size, summary_size), SUMMARY), "token-summaries", wide=True)
    part = rows.agg(F.max("part")).first()[0]
    if part is None:
        return {}
    while part:
        rows = rows.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(_merged(table_size), SUMMARY)
        part //= FAN_IN
    last = rows.first()
    words = sorted(most_frequent(dict(zip(last["words"], last["counts"])), table_size))
    return dict(zip(words, TwoTierCounter(path, {}).encode(words)))


def _count_batches(path: str, shared):
    def run(batches):
        counter = TwoTierCounter(path, shared.value)
        counter.cache = worker_cache(path)
        for b in batches:
            counts = [counter.tokens(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("n_bytes"), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, table_size: int = TABLE_SIZE,
                 summary_size: int = SUMMARY_SIZE) -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.
    ``path``: the model file, which every worker can open."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        frequent_table(docs, path, text_col, table_size, summary_size))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       text_of(f"`{text_col}`").alias("text"))
    return (base.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
            .mapInArrow(_count_batches(path, shared), "id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
