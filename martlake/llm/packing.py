"""Packing of token sequences by minimum bin slack.

Every text is encoded once, ends with ``end_id`` and is cut at multiples of
the window; whole windows are sequences, what remains is packed. The plan is
made on the number of pieces of each length, a table of at most ``window``
rows whatever the corpus holds:

* The longest length left opens a window. A bitset subset-sum dynamic program
  over the lengths left (each as often as it is there, in binary splits) finds
  the reachable sum closest to the room left; backtracking through the bitsets
  gives how often each length is used.
* The multiset found is repeated as often as the counts allow. Each step
  exhausts a length below what the multiset needs, so the number of steps
  depends on the window, not on the corpus.

Pieces of one length are interchangeable: piece number r of a length belongs
to the multiset whose range of numbers holds r. The numbers come from counts
of salted groups of each length (a length that holds a third of all pieces is
many groups) and a row number in each group, so no task gets a whole length.

Ids are those of the tokenizers library. The same vocabulary as ranks gives
them several times faster by tiktoken, where both must agree: texts of
characters whose classes every version of Unicode shares, without the
vocabulary's special strings and of shorter runs of blanks than it refuses. All
other texts go to the tokenizers library.

Defined results: a null or empty text is one piece that holds ``end_id``
alone; rows that repeat are packed each for itself; texts of any length are
encoded whole; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import functools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.common import ship, text_of, written

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
WINDOW = 2048
END_ID = 1
#: A length is dealt in the root of (all pieces / ROOT_SHARE) groups.
ROOT_SHARE = 200
#: Characters outside the ranges whose classes every version of Unicode shares.
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")


# --- encoding ---------------------------------------------------------------

class Encoder:
    def __init__(self, path: str, ranks_path: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids of the whole text, as little-endian 32-bit integers."""
        if not (UNUSUAL.search(text) or any(s in text for s in self.special)):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except ValueError:  # a run of about a million blanks is too long for it
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str) -> Encoder:
    """One for each Python worker, kept between its tasks."""
    return Encoder(path, ranks_path)


def _piece_batches(path: str, ranks_path: str, window: int, end_id: int, with_ids: bool):
    def run(batches):
        encode = encoder(path, ranks_path).encode
        end = end_id.to_bytes(4, "little")
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("id").to_pylist(), b.column("text")):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    part = ids[4 * start:4 * (start + window)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), n,
                                 part if with_ids else None))
            cols = list(zip(*rows)) or [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays.append(pa.array(cols[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
    return run


def pieces(docs: DataFrame, path: str, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
           window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The cut token sequences: ``doc_id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens`` and, if asked for, ``ids`` (little-endian
    32-bit integers)."""
    ship(docs.sparkSession)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        text_of(f"`{text_col}`").alias("text"))
            .mapInArrow(_piece_batches(path, ranks_path, window, end_id, with_ids),
                        schema + (", ids binary" if with_ids else "")))


# --- the plan ---------------------------------------------------------------

def closest_multiset(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to use each length so that the sum comes closest to ``room``
    from below."""
    reach, mask = 1, (1 << (room + 1)) - 1
    steps = []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length) if length else 0
        k = 1
        while left > 0:
            k = min(k, left)
            steps.append((reach, length, k))
            reach |= (reach << (k * length)) & mask
            left -= k
            k *= 2
        if reach >> room:
            break
    at, used = reach.bit_length() - 1, {}
    for before, length, k in reversed(steps):
        if not before >> at & 1:
            at -= k * length
            used[length] = used.get(length, 0) + k
    return used


def minimum_bin_slack(counts: dict[int, int], window: int) -> list[tuple[int, dict[int, int]]]:
    """(how many sequences, {length: how often in each}) that use up ``counts``."""
    counts = {length: n for length, n in counts.items() if n}
    plan = []
    while counts:
        longest = max(counts)
        rest = dict(counts)
        rest[longest] -= 1
        used = closest_multiset({k: n for k, n in rest.items() if n}, window - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in used.items())
        plan.append((times, used))
        for k, n in used.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return plan


def _ranges(plan) -> dict[str, np.ndarray]:
    """The plan by (length, first piece number), sorted."""
    rows, taken, sequence = [], {}, 0
    for times, used in plan:
        offset = 0
        for length in sorted(used, reverse=True):
            rows.append(((length << 44) + taken.get(length, 0), used[length], sequence, offset))
            taken[length] = taken.get(length, 0) + times * used[length]
            offset += length * used[length]
        sequence += times
    rows.sort()
    cols = list(zip(*rows)) or [()] * 4
    return {n: np.array(c, np.int64) for n, c in zip(("key", "used", "sequence", "offset"), cols)}


def _place_batches(shared):
    def run(batches):
        r = shared.value
        for b in batches:
            length = b.column("length").to_numpy()
            number = b.column("number").to_numpy()
            i = np.searchsorted(r["key"], (length << 44) + number, side="right") - 1
            within = number - (r["key"][i] & ((1 << 44) - 1))
            used = r["used"][i]
            seq = r["sequence"][i] + within // used
            offset = r["offset"][i] + within % used * length
            keep = [n for n in b.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in keep], pa.array(seq), pa.array(offset)],
                [*keep, "sequence_id", "offset"])
    return run


def numbered(df: DataFrame, key: str, order: list[str], root_share: int = ROOT_SHARE) -> DataFrame:
    """``df`` with ``number``, 0, 1, ... within each value of ``key``."""
    # Groups and rows in a group grow alike, with the root of the rows.
    salts = max(1, math.isqrt(df.count() // root_share))
    salted = df.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    before = (salted.groupBy(key, "salt").agg(F.count(F.lit(1)).alias("n"))
              .select(key, "salt", (F.sum("n").over(
                  Window.partitionBy(key).orderBy("salt")) - F.col("n")).alias("before")))
    rank = F.row_number().over(Window.partitionBy(key, "salt").orderBy(*order))
    return (salted.withColumn("rank", rank).join(before, [key, "salt"])
            .withColumn("number", F.col("before") + F.col("rank") - 1)
            .drop("salt", "rank", "before"))


def pack(docs: DataFrame, path: str, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False,
         root_share: int = ROOT_SHARE) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, if asked for, ``ids``."""
    cut = written(pieces(docs, path, ranks_path, id_col, text_col, window, end_id, with_ids), "packing-pieces", wide=True)
    counts = {r["length"]: r["n"]
              for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(_ranges(minimum_bin_slack(counts, window)))
    order = ["doc_id", "start", "ids_crc32"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    ranked = numbered(cut, "length", order, root_share).select(*cut.columns, "number")
    return ranked.mapInArrow(_place_batches(shared), schema + ", sequence_id long, `offset` long")
