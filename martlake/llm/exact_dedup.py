"""Exact deduplication by grace hashing.

Records are partitioned by the hash of their content into buckets, level by
level, until each bucket fits the memory of one task; there an open-addressing
table compares complete contents.

1. Each input partition is read in order of id through a bounded table. A
   repeat of a content that the table holds leaves only its id and its
   leader's number. A group of copies that holds a third of all rows is
   thereby down to one leader for each partition before anything is shuffled.
   Leaders and repeats are written to spill files in the shared folder.
2. Bucket sizes are measured on the spill files. Buckets above the limit are
   split by a further hash; a bucket that cannot be split since all its
   leaders have one hash is salted, and what its parts leave is taken again.
3. Every bucket is dealt to one task and resolved in its table.

Texts are equal when they are identical after each run of blanks became one
space. Hashes only deal rows out and find slots; equality is decided on the
complete contents.

Defined results: a null text counts as empty; empty texts are equal to each
other; of equal texts the row with the smallest id stays (a null id counts as
the largest), among equal ids one row; rows that repeat wholly are copies; an
empty table gives an empty result; further columns are carried, never read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.common import BLANKS, ship, text_of, written

#: Bytes of content that one task's table holds, and that a bucket aims at.
TABLE_BYTES = 64 << 20
BUCKET_BYTES = 8 << 20


class ContentTable:
    """Open-addressing hash table (linear probing) over complete contents."""

    def __init__(self, slots: int = 1024):
        self._slots = [-1] * slots
        self._hashes: list[int] = []
        self._contents: list[bytes] = []
        self.values: list[int] = []
        self.bytes = 0

    def put(self, h: int, content: bytes, value: int) -> int:
        """The value stored with ``content``; stores ``value`` if it is new."""
        slots, mask = self._slots, len(self._slots) - 1
        i = h & mask
        while (k := slots[i]) >= 0:
            if self._hashes[k] == h and self._contents[k] == content:
                return self.values[k]
            i = (i + 1) & mask
        slots[i] = len(self.values)
        self._hashes.append(h)
        self._contents.append(content)
        self.values.append(value)
        self.bytes += len(content) + 100
        if 3 * len(self.values) > 2 * len(slots):
            self._grow()
        return value

    def _grow(self) -> None:
        slots = [-1] * (4 * len(self._slots))
        mask = len(slots) - 1
        for k, h in enumerate(self._hashes):
            i = h & mask
            while slots[i] >= 0:
                i = (i + 1) & mask
            slots[i] = k
        self._slots = slots


def _split_leaders(table_bytes: int):
    """Rows of one partition -> leaders with their row, repeats without."""
    def run(batches):
        table = ContentTable()
        for b in batches:
            rids = b.column("rid").to_pylist()
            hashes = b.column("h").to_pylist()
            contents = b.column("content").cast(pa.binary()).to_pylist()
            leads, shas = [], []
            for rid, h, content in zip(rids, hashes, contents):
                if table.bytes > table_bytes:
                    table = ContentTable()
                lead = table.put(h, content, rid)
                leads.append(lead)
                shas.append(hashlib.sha256(content).hexdigest() if lead == rid else None)
            is_lead = pa.array([a == r for a, r in zip(leads, rids)], pa.bool_())
            full = pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("id"), pa.array(leads, pa.int64()), b.column("h"),
                 pa.array(list(map(len, contents)), pa.int64()), pa.array(shas, pa.string()),
                 b.column("row")],
                ["rid", "id", "lead", "h", "nbytes", "sha", "row"])
            yield full.filter(is_lead)
            rest = full.filter(pc.invert(is_lead))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns[:-1], pa.nulls(rest.num_rows, b.column("row").type)],
                rest.schema.names)
    return run


def _resolve_buckets(with_rows: bool):
    """Leaders sorted by bucket -> each leader's root, one table a bucket."""
    def run(batches):
        path, table = None, None
        for b in batches:
            roots = []
            rids = b.column("rid").to_pylist()
            for p, rid, h, content in zip(
                    b.column("path").to_pylist(), rids, b.column("h").to_pylist(),
                    b.column("content").cast(pa.binary()).to_pylist()):
                if p != path:
                    path, table = p, ContentTable()
                roots.append(table.put(h, content, rid))
            out = [b.column("rid"), pa.array(roots, pa.int64()), b.column("id")]
            names = ["rid", "root", "id"]
            if with_rows:
                out = [*out, b.column("h"), b.column("nbytes"), b.column("row")]
                names = [*names, "h", "nbytes", "row"]
            out = pa.RecordBatch.from_arrays(out, names)
            if with_rows:
                out = out.filter(pa.array([a == r for a, r in zip(rids, roots)], pa.bool_()))
            yield out
    return run


def _content(text) -> F.Column:
    return F.regexp_replace(text, BLANKS, " ")


def _spill(docs: DataFrame, id_col: str, text_col: str, table_bytes: int) -> DataFrame:
    """The spill files: every row's (rid, id, lead), the leaders' rows too."""
    ship(docs.sparkSession)
    base = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
            .select(F.monotonically_increasing_id().alias("rid"),
                    F.col(f"row.`{id_col}`").cast("long").alias("id"),
                    _content(text_of(f"row.`{text_col}`")).alias("content"), "row")
            .withColumn("h", F.xxhash64("content"))
            .sortWithinPartitions(F.col("id").asc_nulls_last(), "rid"))
    schema = T.StructType([
        T.StructField("rid", T.LongType()), T.StructField("id", T.LongType()),
        T.StructField("lead", T.LongType()), T.StructField("h", T.LongType()),
        T.StructField("nbytes", T.LongType()), T.StructField("sha", T.StringType()),
        T.StructField("row", base.schema["row"].dataType)])
    return written(base.mapInArrow(_split_leaders(table_bytes), schema), "dedup-spill", wide=True)


def _bucket_paths(leaders: DataFrame, bucket_bytes: int, table_bytes: int):
    """``leaders`` with a ``path`` whose buckets fit a table, and whether
    buckets of a single hash were salted (they need another round)."""
    total = leaders.agg(F.coalesce(F.sum("nbytes"), F.lit(0)).alias("b")).first()["b"]
    fan = max(1, -(-int(total) // bucket_bytes))
    out = leaders.withColumn("path", F.pmod(F.col("h"), F.lit(fan)).cast("string"))
    level = 0
    while True:
        level += 1
        large = (out.groupBy("path")
                 .agg(F.sum("nbytes").alias("b"), F.count(F.lit(1)).alias("n"),
                      (F.min("h") == F.max("h")).alias("one"))
                 .filter((F.col("b") > table_bytes) & (F.col("n") > 2)))
        large = written(large.select("path", "b", "n", "one"), "dedup-large")
        kinds = {r["one"] for r in large.select("one").distinct().collect()}
        if False in kinds:
            cut = (large.filter(~F.col("one"))
                   .select("path", F.ceil(F.col("b") / bucket_bytes).alias("fan")))
            out = (out.join(cut, "path", "left")
                   .withColumn("path", F.when(F.col("fan").isNull(), F.col("path")).otherwise(
                       F.concat_ws(".", "path", F.pmod(F.xxhash64("h", F.lit(level)), "fan"))))
                   .drop("fan"))
            continue
        if True in kinds:
            salt = large.select("path", F.least(F.ceil(F.col("b") / bucket_bytes),
                                                F.ceil(F.col("n") / 2)).alias("fan"))
            out = (out.join(salt, "path", "left")
                   .withColumn("path", F.when(F.col("fan").isNull(), F.col("path")).otherwise(
                       F.concat_ws("~", "path", F.pmod(F.xxhash64("rid"), "fan"))))
                   .drop("fan"))
        return out, True in kinds


def _resolve(leaders: DataFrame, text_col: str, with_rows: bool, bucket_bytes: int,
             table_bytes: int):
    """One round: (rid, root, id[, h, nbytes, row]) and whether it was salted."""
    paths, salted = _bucket_paths(leaders, bucket_bytes, table_bytes)
    dealt = (paths.withColumn("content", _content(text_of(f"row.`{text_col}`")))
             .repartition("path")
             .sortWithinPartitions("path", F.col("id").asc_nulls_last(), "rid"))
    if not with_rows:
        dealt = dealt.drop("row", "nbytes")
    fields = [T.StructField(n, T.LongType()) for n in ("rid", "root", "id")]
    if with_rows:
        fields += [T.StructField("h", T.LongType()), T.StructField("nbytes", T.LongType()),
                   leaders.schema["row"]]
    return dealt.mapInArrow(_resolve_buckets(with_rows), T.StructType(fields)), salted


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     bucket_bytes: int = BUCKET_BYTES,
                     table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``keep_id``, ``group_size``,
    ``kept`` and ``sha`` (of the normalised text)."""
    spill = _spill(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")),
                   id_col, text_col, table_bytes)
    leaders = spill.filter(F.col("rid") == F.col("lead"))
    roots = None
    while True:
        found, salted = _resolve(leaders.select("rid", "id", "h", "nbytes", "row"), text_col,
                                 False, bucket_bytes, table_bytes)
        found = written(found, "dedup-roots", wide=True).select("rid", "root")
        if roots is None:
            roots = found
        else:
            step = found.select(F.col("rid").alias("root"), F.col("root").alias("next"))
            roots = written(roots.join(step, "root").select("rid", F.col("next").alias("root")),
                            "dedup-roots")
        if not salted:
            break
        leaders = leaders.join(found.select(F.col("root").alias("rid")).distinct(), "rid",
                               "left_semi")
    # Counted by leader first, so that no group of copies meets in one task.
    per_lead = (spill.groupBy("lead").agg(F.count(F.lit(1)).alias("n"), F.max("sha").alias("sha"),
                                          F.min("id").alias("least")))
    by_root = (per_lead.join(roots.withColumnRenamed("rid", "lead"), "lead")
               .select("lead", "root", "n", "sha", "least"))
    totals = by_root.groupBy("root").agg(F.sum("n").alias("group_size"),
                                         F.min("least").alias("keep_id"))
    resolved = by_root.select("lead", "root", "sha").join(totals, "root")
    return (spill.select("rid", "id", "lead").join(resolved, "lead")
            .select("id", "keep_id", "group_size", (F.col("rid") == F.col("root")).alias("kept"),
                    "sha"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          bucket_bytes: int = BUCKET_BYTES,
                          table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The kept rows of ``docs`` with all their columns; the rows travel with
    the contents, so no join brings them back."""
    spill = _spill(docs, id_col, text_col, table_bytes)
    leaders = (spill.filter(F.col("rid") == F.col("lead"))
               .select("rid", "id", "h", "nbytes", "row"))
    while True:
        found, salted = _resolve(leaders, text_col, True, bucket_bytes, table_bytes)
        if not salted:
            return found.select("row.*")
        leaders = written(found, "dedup-left", wide=True).select("rid", "id", "h", "nbytes", "row")
