"""SimHash near-duplicates with Golay-code fuzzy hashing.

Every text gets a 64-bit SimHash of its word shingles. Fingerprints link when
they differ in at most ``MAX_BITS`` = 4 bits. Links are found through keys:

* A fingerprint is cut into segments of 22, 21 and 21 bits, each a word of the
  binary Golay code (23, 12, 7) with zeros in front. ``keys(w)`` are the
  indices of all codewords within distance 4 of ``w``: one if the nearest
  codeword is within distance 2, else six. Two words that differ in at most
  two bits share an index (any four points lie in one block of the Steiner
  system S(4, 7, 23); a test goes through all cases).
* Pigeonhole: with at most 4 errors in 3 segments, two segments have at most
  2 together. Either one of the two is equal and the other has at most 2
  errors (key: the equal segment's bits and the other's index), or each has
  one and the third has at most 2 (key: the three indices). All keys have 33
  or 36 bits, so buckets stay small up to billions of texts.
* Each bucket is verified on the whole fingerprints. A bucket passes on a
  spanning set of its links, never all its pairs.
* Buckets above ``MAX_RUN`` fingerprints (dense groups of near copies) are
  linked another, also exact way: two fingerprints differ in at most 4 bits
  if and only if some point is within 2 bits of both. Each fingerprint of such
  a bucket is dealt to its 2081 points; a point has at most 2081 of them.

Equal fingerprints are joined before all this, so groups of copies never meet
in a bucket. Components are found by star contraction of the links.

Defined results: a null text counts as empty; texts without a word have the
fingerprint zero and link like any other; a text with fewer words than a
shingle is one shingle; equal rows link; a null id never becomes a component's
id unless it holds no other (then null); texts of any length are hashed whole,
a block of words at a time; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ship, text_of, written

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of one key that are compared pair by pair.
MAX_RUN = 256
#: A key is dealt apart when one task alone holds so many of its fingerprints.
HOT_IN_TASK = 64
#: Fingerprints that one task gives keys (about 185 each) or points (2081).
KEY_ROWS, POINT_ROWS = 20_000, 2_000
#: Lengths of the segments, from the lowest bit.
SEGMENTS = (22, 21, 21)
#: Generator polynomial of the Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0b101011100011
#: Bytes of a text that are hashed at once.
_BLOCK = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


# --- fingerprints -----------------------------------------------------------

def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of the text, a block of bytes that ends at a blank at a time."""
    at = 0
    while at < len(text):
        m = _BLANK.search(text, at + _BLOCK)
        end = m.start() if m else len(text)
        yield text[at:end].lower().split()
        at = end


def shingle_hashes(tokens: list[bytes], words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each shingle of the words, repeats included; of fewer words
    than a shingle has, of all of them."""
    import xxhash
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([digest(joined, SEED)], "<u8")
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-1]))[: len(tokens) - words + 1].tolist()
    stops = (ends[words - 1:] - 1).tolist()
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), "<u8", len(starts))


def simhash(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    counts, total, held = np.zeros(64, np.int64), 0, []

    def count(hashes: np.ndarray) -> int:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts[:] += bits.sum(axis=0, dtype=np.int64)
        return len(hashes)

    for tokens in _word_blocks(text):
        held += tokens
        if len(held) >= words:
            total += count(shingle_hashes(held, words))
            held = held[len(held) - words + 1:]
    if not total and held:
        total = count(shingle_hashes(held, words))
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprint_batches(words: int):
    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            fps = np.fromiter((simhash(t.as_py(), words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("content"), pa.array(fps.view(np.int64))],
                ["id", "content", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, content, fp) of every row; ``fp`` holds the 64 bits as a signed
    long, ``content`` tells rows that share an id apart (a hash of the text)."""
    ship(docs.sparkSession)
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       text_of(f"`{text_col}`").alias("text"))
    return (base.select("id", F.xxhash64("text").alias("content"), "text")
            .mapInArrow(_fingerprint_batches(words), "id long, content long, fp long"))


# --- Golay keys -------------------------------------------------------------

def _syndromes(w: np.ndarray) -> np.ndarray:
    """Remainder of the 23-bit words by the generator polynomial."""
    r = w.copy()
    for bit in range(22, 10, -1):
        r ^= np.where((r >> np.uint64(bit)) & np.uint64(1),
                      np.uint64(GENERATOR << (bit - 11)), np.uint64(0))
    return r


@functools.lru_cache(maxsize=1)
def _error_table() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error patterns of weight at most 4 to the codewords
    within that distance (filled up with the nearest), and their number."""
    bits = [1 << i for i in range(23)]
    patterns = {0: [0]}
    table = [[] for _ in range(2048)]

    def weight(n: int) -> np.ndarray:
        if n == 0:
            return np.zeros(1, np.uint64)
        low = weight(n - 1)
        out = {int(x) | b for x in low for b in bits if b > int(x)}
        patterns[n] = sorted(out)
        return np.array(patterns[n], np.uint64)
    weight(4)
    for n in range(5):
        p = np.array(patterns[n], np.uint64)
        for e, s in zip(patterns[n], _syndromes(p).tolist()):
            table[int(s)].append(e)
    count = np.array([len(t) for t in table], np.int64)
    full = np.array([t + t[:1] * (6 - len(t)) for t in table], np.uint64)
    return full, count


def golay_indices(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) indices (the 12 message bits) of the codewords within distance 4
    of each 23-bit word, and how many of them differ (1 or 6)."""
    errors, count = _error_table()
    s = _syndromes(w).astype(np.int64)
    return (w[:, None] ^ errors[s]) >> np.uint64(11), count[s]


def segments(fp: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for n in SEGMENTS:
        out.append((fp >> np.uint64(at)) & np.uint64((1 << n) - 1))
        at += n
    return out


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for each key of each fingerprint; the key's kind is in its
    top bits."""
    seg = segments(fp)
    coded = [golay_indices(s) for s in seg]
    rows, keys = [], []

    def add(kind: int, valid: np.ndarray, value: np.ndarray) -> None:
        r, c = np.nonzero(valid)
        rows.append(r)
        keys.append(value[r, c] | np.uint64(kind << 58))

    slot = np.arange(6)
    for kind, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        index, n = coded[j]
        add(kind, slot[None, :] < n[:, None], (seg[i][:, None] << np.uint64(12)) | index)
    (a, na), (b, nb), (c, nc) = coded
    x, y, z = (v.ravel() for v in np.meshgrid(slot, slot, slot, indexing="ij"))
    for k in range(0, len(fp), 4096):
        s = slice(k, k + 4096)
        valid = ((x < na[s, None]) & (y < nb[s, None]) & (z < nc[s, None]))
        value = ((a[s][:, x] << np.uint64(24)) | (b[s][:, y] << np.uint64(12)) | c[s][:, z])
        r, col = np.nonzero(valid)
        rows.append(r + k)
        keys.append(value[r, col] | np.uint64(6 << 58))
    return np.concatenate(rows), np.concatenate(keys)


def ball(fp: np.ndarray) -> np.ndarray:
    """(n, 2081) points within 2 bits of each fingerprint."""
    return fp[:, None] ^ _ball_masks()[None, :]


@functools.lru_cache(maxsize=1)
def _ball_masks() -> np.ndarray:
    bit = [1 << i for i in range(64)]
    return np.array([0, *bit, *[a | b for i, a in enumerate(bit) for b in bit[:i]]], np.uint64)


def _key_batches(batches):
    for b in batches:
        fp = b.column("fp").to_numpy().view(np.uint64)
        for k in range(0, len(fp), 2048):
            part = fp[k:k + 2048]
            rows, keys = fuzzy_keys(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(part[rows].view(np.int64))],
                ["key", "fp"])


def _hot_key_batches(least: int):
    """Keys that one task's fingerprints share ``least`` times or more."""
    def run(batches):
        seen, held = [], 0
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for k in range(0, len(fp), 2048):
                seen.append(fuzzy_keys(fp[k:k + 2048])[1])
                held += len(seen[-1])
                if held > 1 << 23:
                    yield from _frequent(seen, least)
                    seen, held = [], 0
        if seen:
            yield from _frequent(seen, least)
    return run


def _frequent(seen, least):
    keys, n = np.unique(np.concatenate(seen), return_counts=True)
    yield pa.RecordBatch.from_arrays([pa.array(keys[n >= least].view(np.int64))], ["key"])


def _ball_batches(batches):
    for b in batches:
        fp = b.column("fp").to_numpy().view(np.uint64)
        for k in range(0, len(fp), 256):
            part = fp[k:k + 256]
            points = ball(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(points.ravel().view(np.int64)),
                 pa.array(np.repeat(part, points.shape[1]).view(np.int64))], ["key", "fp"])


# --- links ------------------------------------------------------------------

def _spanning(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links of at most ``most`` bits that connect what all such links do."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= most
    left, out = set(range(len(fps))), []
    while left:
        todo = [left.pop()]
        while todo and left:
            i = todo.pop()
            for j in [j for j in np.nonzero(near[i])[0].tolist() if j in left]:
                left.discard(j)
                todo.append(j)
                out.append((i, j))
    return out


def _link_runs(most: int, max_run: int):
    """Rows sorted by (key, fp) -> links; fingerprints of longer runs come
    out as (fp, null) for the other way. Holds one run of ``max_run`` rows."""
    def run(batches):
        key, held, long_run = None, [], False

        def done(out):
            if not long_run and len(held) > 1:
                fps = np.array(held, np.int64).view(np.uint64)
                if len(held) == 2:
                    if int(np.bitwise_count(fps[0] ^ fps[1])) <= most:
                        out.append((held[0], held[1]))
                else:
                    out += [(held[i], held[j]) for i, j in _spanning(fps, most)]

        def batch(out):
            out = sorted(set(out), key=lambda x: (x[0], x[1] is not None, x[1] or 0))
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())],
                ["a", "b"])

        for b in batches:
            out = []
            keys, fps = b.column("key").to_numpy(), b.column("fp").to_numpy()
            # Keys that occur once in the batch, away from its ends, link nothing.
            same = keys[1:] == keys[:-1]
            keep = np.ones(len(keys), bool)
            if len(keys) > 2:
                keep[1:-1] = same[1:] | same[:-1]
            for k, fp in zip(keys[keep].tolist(), fps[keep].tolist()):
                if k != key:
                    done(out)
                    key, held, long_run = k, [], False
                if long_run:
                    out.append((fp, None))
                elif len(held) == max_run:
                    out += [(x, None) for x in [*held, fp]]
                    long_run = True
                else:
                    held.append(fp)
            yield batch(out)
        out = []
        done(out)
        yield batch(out)
    return run


def links(fps: DataFrame, most: int = MAX_BITS, max_run: int = MAX_RUN,
          hot_in_task: int = HOT_IN_TASK) -> DataFrame:
    """Links (a, b) that connect all fingerprints (distinct, column ``fp``)
    with at most ``most`` differing bits; not each such pair, but a path."""
    if not 0 <= most <= 4:
        raise ValueError("these keys find links of at most 4 bits")
    fps = _spread(fps.select("fp"), KEY_ROWS)
    hot = written(fps.mapInArrow(_hot_key_batches(hot_in_task), "key long").distinct(),
                  "simhash-hot")
    keyed = fps.mapInArrow(_key_batches, "key long, fp long")
    cold = keyed
    some_hot = bool(hot.limit(1).count())
    if some_hot:
        cold = keyed.join(hot, "key", "left_anti")
    found = written(
        cold.repartition("key").sortWithinPartitions("key", "fp")
        .mapInArrow(_link_runs(most, max_run), "a long, b long"), "simhash-links", wide=True)
    pairs = found.filter(F.col("b").isNotNull())
    dense = found.filter(F.col("b").isNull()).select(F.col("a").alias("fp"))
    if some_hot:
        dense = dense.unionByName(keyed.join(hot, "key", "left_semi").select("fp"))
    dense = written(dense.distinct(), "simhash-dense")
    if dense.limit(1).count():
        points = (_spread(dense, POINT_ROWS).mapInArrow(_ball_batches, "key long, fp long")
                  .repartition("key").sortWithinPartitions("key", "fp"))
        stars = points.mapInArrow(_link_points(most), "a long, b long")
        pairs = pairs.unionByName(stars.distinct())
    return pairs


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a written table of short rows, dealt out to tasks that make
    many rows of each of theirs."""
    return df.repartition(max(1, -(-df.count() // rows)))


def _link_points(most: int):
    """Rows sorted by (point, fp) -> links within ``most`` bits. At 4 bits
    all fingerprints of a point link, so each links to the point's first."""
    def stars(batches):
        key = first = None
        for b in batches:
            keys, fps = b.column("key").to_numpy(), b.column("fp").to_numpy()
            if not len(keys):
                continue
            new = np.concatenate(([keys[0] != key], keys[1:] != keys[:-1]))
            lead = fps.copy()
            if not new[0]:
                lead[0] = first
            at = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
            lead = lead[at]
            key, first = keys[-1], lead[-1]
            pairs = np.unique(np.stack([lead, fps], 1)[lead != fps], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def verified(batches):
        key, held = None, []
        for b in batches:
            out = set()
            for k, fp in zip(b.column("key").to_pylist(), b.column("fp").to_pylist()):
                if k != key:
                    key, held = k, []
                out.update((x, fp) for x in held if ((x ^ fp) & (2 ** 64 - 1)).bit_count() <= most)
                held.append(fp)
            out = sorted(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())],
                ["a", "b"])
    return stars if most == 4 else verified


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); ``root`` is the
    component's smallest node. Alternates large and small stars until nothing
    changes; each round is a written table."""
    edges = written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "simhash-edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.*").filter("u <> v").distinct())
        after = written(small, "simhash-edges")
        print_of = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
        if edges.agg(*print_of).first() == after.agg(*print_of).first():
            break
        edges = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _rooted(docs: DataFrame, id_col: str, text_col: str, words: int, most: int, max_run: int = MAX_RUN,
            hot_in_task: int = HOT_IN_TASK) -> tuple[DataFrame, DataFrame]:
    """The signed rows (id, content, fp), and (fp, least, root): the component
    of every fingerprint and its smallest id."""
    signed = written(fingerprints(docs, id_col, text_col, words), "simhash-fp", wide=True)
    fps = written(signed.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    nodes = components(links(fps, most, max_run, hot_in_task))
    rooted = (fps.join(nodes, fps["fp"] == nodes["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    return signed, written(rooted, "simhash-roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, most: int = MAX_BITS, max_run: int = MAX_RUN,
                    hot_in_task: int = HOT_IN_TASK) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``content``, ``fp`` and
    ``component_id``, the smallest id that links reach."""
    signed, rooted = _rooted(docs, id_col, text_col, words, most, max_run, hot_in_task)
    named = (rooted.groupBy("root").agg(F.min("least").alias("component_id"))
             .join(rooted.select("root", "fp"), "root").select("fp", "component_id"))
    return signed.join(named, "fp").select("id", "content", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = SHINGLE_WORDS, most: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id
    (nulls last), of its rows one with the smallest content hash."""
    signed, rooted = _rooted(docs, id_col, text_col, words, most)
    kept = (signed.join(rooted.select("fp", "root"), "fp").groupBy("root", "id", "content").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "content", "n")).alias("b"))
            .select("b.id", "b.content", "b.n"))
    kept = written(kept, "simhash-kept")
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
            .withColumn("rid", F.col(f"row.`{id_col}`").cast("long"))
            .withColumn("rcontent", F.xxhash64(text_of(f"row.`{text_col}`"))))
    out = rows.join(kept, (F.col("rcontent") == F.col("content")) & F.col("rid").eqNullSafe(F.col("id")),
                    "left_semi")
    if kept.filter("n > 1").limit(1).count():
        out = out.dropDuplicates(["rid", "rcontent"])
    return out.select("row.*")
