"""Change history, point-in-time reads and apply-changes (H1-H6, J5, J9,
J10, W3-W5).

The reference keeps history with row-level triggers inside one database
transaction. Here the input is the *change set* — (key, change_time, seq,
op, payload) with op in I/U/D — and the history table is derived from it in
one distributed plan:

* I or U opens a row at its change time; the row is closed by the key's
  next change (``valid_to`` = next change time, NULL while open);
* D closes the open row and is recorded with the closed row's payload as
  ``valid_from = valid_to`` (a zero-length row, never visible to a
  point-in-time read); a delete with nothing before it keeps its own payload;
* ``version`` counts the I/U changes since the key's last insert (a D row
  carries the version it deleted).

Ordering within a key is (change_time, seq); seq breaks ties between changes
at the same time (two updates inside one transaction give a zero-length row).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.operators.sequence import DEFAULT_BUCKET_ROWS, has_hot_key, hot_key_buckets, ordered_scan

HISTORY_OPS = ("I", "U", "D")


def build_history(changes: DataFrame, key: str, ts: str, seq: str, op: str, payload,
                  max_bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Change set -> SCD-2 history rows.

    One job counts the rows of each key (reading only the key). Where no key
    has more than ``max_bucket_rows``, all is one scan, one shuffle and one
    sort: three windows over the key. Else hot keys are split by time
    (:mod:`martlake.operators.sequence`); the results are equal.
    """
    payload = list(payload)
    return _scanned(changes.select(key, ts, seq, op, *payload), key, ts, seq, op, payload, max_bucket_rows)


def _scanned(c: DataFrame, key: str, ts: str, seq: str, op: str, payload: list[str], max_bucket_rows: int,
             seed: str | None = None) -> DataFrame:
    """History of the changes ``c``. A row with a ``seed`` stands for all rows
    of its key up to it, of which the seed is the version."""
    live, own, opens = (F.col(op) != "D").cast("int"), F.col(op) != "D", F.col(op) == "I"
    if seed is not None:
        is_seed = F.col(seed).isNotNull()
        live = F.coalesce(F.col(seed), live)
        own, opens = F.when(is_seed, F.col(seed) > 0).otherwise(own), opens & ~is_seed
    # What a delete closes: the latest row before it that is no delete.
    closed = F.when(own, F.struct(ts, seq, *payload))
    base_src = F.when(opens, F.col("_live_cum") - 1).otherwise(F.lit(0))
    if has_hot_key(c, key, max_bucket_rows):
        c = hot_key_buckets(c.withColumn("_live", live), key, ts, max_bucket_rows)
        c = ordered_scan(c, key, [ts, seq], None, sums={"_live_cum": F.col("_live")},
                         maxes={"_closed": closed}, leads={"_next_ts": F.col(ts)}, keep_bucket=True)
        # The live count just before the latest insert needs the running one.
        c = ordered_scan(c, key, [ts, seq], None, maxes={"_base": base_src})
    else:
        w = Window.partitionBy(key).orderBy(ts, seq)
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        c = (c.withColumn("_live_cum", F.sum(live).over(run))
             .withColumn("_closed", F.last(closed, ignorenulls=True).over(run))
             .withColumn("_next_ts", F.lead(ts).over(w))
             .withColumn("_base", F.max(base_src).over(run)))
    deleted = (F.col(op) == "D") & F.col("_closed").isNotNull()
    return c.select(
        key, *[F.when(deleted, F.col(f"_closed.{p}")).otherwise(F.col(p)).alias(p) for p in payload],
        (F.col("_live_cum") - F.col("_base")).cast("int").alias("version"),
        F.col(ts).alias("valid_from"),
        F.when(F.col(op) == "D", F.col(ts)).otherwise(F.col("_next_ts")).alias("valid_to"),
        F.col(op).alias("operation"),
        F.col(seq).alias("change_seq"))


def merge_history(history: DataFrame, changes: DataFrame, key: str, ts: str, seq: str, op: str, payload,
                  max_bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """H1 / W3 / W4 kept up: the history after further ``changes``, equal to
    :func:`build_history` over all changes there ever were.

    The new changes of most keys follow all old ones. Then only the key's last
    row is scanned with them: it may be closed, and it carries the version and
    the payload that a delete closes. A key with a late change, one that falls
    between old rows, is scanned anew from its own rows, which hold all that
    its changes said. Rows of other keys, and all but the last rows of most
    touched keys, pass through one join with the touched keys.
    """
    payload = list(payload)
    columns = [key, *payload, "version", "valid_from", "valid_to", "operation", "change_seq"]
    new = changes.select(F.col(key).alias("_k"), F.struct(F.col(ts), F.col(seq)).alias("_at"))
    touched = new.groupBy("_k").agg(F.min("_at").alias("_first"))
    at = F.struct(F.col("valid_from").alias(ts), F.col("change_seq").alias(seq))
    old = history.select(*columns).join(touched, F.col(key).eqNullSafe(F.col("_k")), "left")
    # The last row of each touched key: one aggregate, combined map-side.
    hit = F.col("_first").isNotNull()
    last = (old.where(hit).groupBy(F.col(key).alias("_lk")).agg(F.max(at).alias("_last"), F.first("_first").alias("_f"))
            .select("_lk", "_last", (F.col("_f") <= F.col("_last")).alias("_late")))
    marked = old.join(last, F.col(key).eqNullSafe(F.col("_lk")), "left")
    scanned = hit & (F.col("_late") | (at == F.col("_last")))
    kept = marked.where(~F.coalesce(scanned, F.lit(False))).select(*columns)
    again = marked.where(scanned).select(
        key, F.col("valid_from").alias(ts), F.col("change_seq").alias(seq), F.col("operation").alias(op), *payload,
        F.when(~F.col("_late"), F.col("version")).alias("_seed"))
    fresh = changes.select(key, ts, seq, op, *payload, F.lit(None).cast("int").alias("_seed"))
    return kept.unionByName(
        _scanned(again.unionByName(fresh), key, ts, seq, op, payload, max_bucket_rows, "_seed").select(*columns))


def _bucket(key: str, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def write_history(history: DataFrame, path: str, key: str, buckets: int) -> None:
    """A history as a table of ``buckets`` folders by hash of the key."""
    history.withColumn("bucket", _bucket(key, buckets)).write.mode("overwrite").partitionBy("bucket").parquet(path)


def touched_buckets(history: DataFrame, changes: DataFrame, key: str, buckets: int) -> DataFrame:
    """The rows of the written ``history`` that share a bucket with a change;
    the other buckets' files are not read."""
    hit = [r[0] for r in changes.select(_bucket(key, buckets)).distinct().collect()]  # at most ``buckets`` numbers
    return history.where(F.col("bucket").isin(hit) if hit else F.lit(False))


def merge_into_history(spark, path: str, changes: DataFrame, key: str, ts: str, seq: str, op: str, payload, buckets: int,
                       max_bucket_rows: int = DEFAULT_BUCKET_ROWS) -> None:
    """:func:`merge_history` into the table that :func:`write_history` made.
    Only folders of buckets with a change are read and replaced, each at the
    commit of the job; all others keep their files."""
    old = touched_buckets(spark.read.parquet(path), changes, key, buckets).drop("bucket")
    merged = merge_history(old, changes, key, ts, seq, op, payload, max_bucket_rows)
    (merged.withColumn("bucket", _bucket(key, buckets)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))


def visible_at(t) -> F.Column:
    """J5 predicate: ``valid_from <= t AND (valid_to IS NULL OR valid_to > t)``."""
    t = F.lit(t) if not isinstance(t, F.Column) else t
    return (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))


def state_at(history: DataFrame, key: str, t) -> DataFrame:
    """One row per key valid at ``t`` (the latest by valid_from
    and change sequence when several qualify). ``max_by`` combines map-side."""
    cols = [c for c in history.columns if c != key]
    best = F.max_by(F.struct(*cols), F.struct("valid_from", "change_seq"))
    return (history.where(visible_at(t)).groupBy(key).agg(best.alias("_r"))
            .select(key, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def history_of_key(changes: DataFrame, key: str, ts: str, seq: str, op: str, payload, value) -> DataFrame:
    """H2: the history of one key, newest first (O5); only that key's changes
    are scanned and ordered."""
    own = changes.where(F.col(key) == F.lit(value))
    return (build_history(own, key, ts, seq, op, payload)
            .orderBy(F.desc("valid_from"), F.desc("version"), F.desc("change_seq")))


def asof_lookup(history: DataFrame, probes: DataFrame, key: str, t: str,
                payload, max_bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """J5 for many probes: for each (key, t) probe the history row visible
    at t, or NULLs.

    Probes and history starts are merged into one ordered stream per key; a
    running max of (valid_from, seq, row) carried along the stream gives, at
    each probe, the latest row that started at or before it. It is a window
    over the key, or, where a key has more than ``max_bucket_rows`` rows, the
    scan that splits hot keys by time. No range join and no pairs of rows are
    formed.
    """
    payload = list(payload)
    row = F.struct(F.col("valid_from"), F.col("change_seq"), F.col("version"),
                   F.col("valid_to"), *[F.col(p) for p in payload])
    h = history.select(F.col(key), F.col("valid_from").alias("_t"), F.lit(0).alias("_kind"),
                       row.alias("_row"))
    p = probes.select(F.col(key), F.col(t).alias("_t"), F.lit(1).alias("_kind"),
                      F.lit(None).cast(h.schema["_row"].dataType).alias("_row"))
    merged = h.unionByName(p)
    if has_hot_key(merged, key, max_bucket_rows):
        scanned = ordered_scan(hot_key_buckets(merged, key, "_t", max_bucket_rows), key,
                               ["_t", "_kind"], None, maxes={"_last": F.col("_row")})
    else:
        run = (Window.partitionBy(key).orderBy("_t", "_kind")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        scanned = merged.withColumn("_last", F.max("_row").over(run))
    hit = scanned.where(F.col("_kind") == 1)
    ok = F.col("_last").isNotNull() & (F.col("_last.valid_to").isNull() |
                                        (F.col("_last.valid_to") > F.col("_t")))
    return hit.select(F.col(key), F.col("_t").alias(t),
                      *[F.when(ok, F.col(f"_last.{c}")).alias(c)
                        for c in ["valid_from", "version"] + payload])


def apply_changes(current: DataFrame, updates: DataFrame, key: str, order: str) -> DataFrame:
    """H5: merge updates into a table without a lakehouse MERGE: union both
    and keep the latest row per key (``max_by`` on the order column, ties
    to the update)."""
    cols = [c for c in current.columns if c != key]
    u = (current.withColumn("_src", F.lit(0))
         .unionByName(updates.select(*current.columns).withColumn("_src", F.lit(1))))
    best = F.max_by(F.struct(*cols), F.struct(F.col(order), F.col("_src")))
    return u.groupBy(key).agg(best.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def write_keyed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A table with one row per key as ``buckets`` folders by hash of the key,
    a few files each."""
    (df.withColumn("bucket", _bucket(key, buckets)).hint("rebalance", F.col("bucket"))
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def apply_changes_to(spark, path: str, updates: DataFrame, key: str, order: str, buckets: int) -> None:
    """H5 on a kept table: :func:`apply_changes` into the table that
    :func:`write_keyed` made. Only folders of buckets with an updated key are
    read and replaced, each at the commit of the job; all others keep their
    files. A rerun of the same updates changes no row. Updates without a row
    touch nothing; a NULL key is a key of its own."""
    old = touched_buckets(spark.read.parquet(path), updates, key, buckets).drop("bucket")
    (apply_changes(old, updates, key, order).withColumn("bucket", _bucket(key, buckets))
     .hint("rebalance", F.col("bucket")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))


def with_default_columns(df: DataFrame, columns: dict) -> DataFrame:
    """H6: add columns ``{name: (type, default)}``; existing rows read the
    default (as ``ADD COLUMN ... DEFAULT`` does)."""
    out = df
    for name, (typ, default) in columns.items():
        if name in df.columns:
            out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default).cast(typ)))
        else:
            out = out.withColumn(name, F.lit(default).cast(typ))
    return out


def pending(manifest: DataFrame, applied: DataFrame, key: str) -> DataFrame:
    """Entries of the manifest that are not successfully applied, in
    key order (anti join)."""
    return manifest.join(applied.select(key).distinct(), key, "left_anti").orderBy(key)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose foreign key has no parent; a NULL key refers to
    nothing and is no orphan."""
    return (child.where(F.col(child_key).isNotNull())
            .join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti"))


def write_version(df: DataFrame, path: str, version: int) -> None:
    """H7: ``df`` as one version of a table partitioned by ``version``; a
    rerun rewrites that version alone."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={int(version)}")


MANIFEST = "version int, operation string, base int, committed_at timestamp_ntz, schema string"


def commit_version(df: DataFrame, path: str, version: int, operation: str, committed_at: str) -> None:
    """H7 / H8: ``df`` as a version, and its line in the manifest beside the
    data: the operation (create, append or replace), the version that a reader
    begins with (itself unless it appends), the commit time that is passed, and
    the columns. The line is written last, so a version without one is not
    there for :func:`read_version`; a rerun rewrites both."""
    spark, path = df.sparkSession, path.rstrip("/")
    if operation not in ("create", "append", "replace"):
        raise ValueError(f"unknown operation {operation!r}")
    before = {r["version"]: r for r in _manifest(spark, path, version - 1)} if version > 1 else {}
    if operation == "append" and not before:
        raise ValueError("append to a table without versions")
    base = before[max(before)]["base"] if operation == "append" else version
    write_version(df, path, version)
    (spark.createDataFrame([(version, operation, base, df.schema.json())], "version int, operation string, base int, schema string")
     .withColumn("committed_at", F.lit(committed_at).cast("timestamp_ntz")).select("version", "operation", "base", "committed_at", "schema")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifest/line={version}"))


def _manifest(spark, path: str, upto: int | None = None) -> list:
    """The manifest's lines up to a version: one small row for each version."""
    lines = spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/_manifest/line=*")
    lines = lines if upto is None else lines.where(F.col("version") <= upto)
    return sorted(lines.collect(), key=lambda r: r["version"])


def read_version(spark, path: str, version: int | None = None) -> DataFrame:
    """H7: the table as of ``version`` (the latest without one). The manifest
    is resolved before the scan: the versions from the base that holds there on,
    with all columns that these versions have; rows of a version that lacks a
    column read null. What a replacing version replaced is not read."""
    lines = _manifest(spark, path, version)
    if not lines or (version is not None and lines[-1]["version"] != version):
        raise ValueError(f"no version {version} in {path}")
    lines = [r for r in lines if r["version"] >= lines[-1]["base"]]
    fields = {}
    for r in lines:
        for f in T.StructType.fromJson(json.loads(r["schema"])).fields:
            fields[f.name] = T.StructField(f.name, f.dataType, True)
    schema = T.StructType([*fields.values(), T.StructField("version", T.IntegerType())])
    root = path.rstrip("/")
    return (spark.read.schema(schema).option("basePath", root)
            .parquet(*[f"{root}/version={r['version']}" for r in lines]))


def version_log(spark, path: str) -> DataFrame:
    """H8: (version, operation, committed_at, rows, total) by version: the rows
    it brought and those that a reader of it sees."""
    root = path.rstrip("/")
    lines = spark.read.schema(MANIFEST).parquet(f"{root}/_manifest/line=*").drop("schema")
    counts = (spark.read.schema("version int").option("basePath", root).parquet(f"{root}/version=*")
              .groupBy("version").agg(F.count(F.lit(1)).alias("rows")))
    rows = lines.join(counts, "version", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    total = F.sum("rows").over(Window.partitionBy("base").orderBy("version"))
    return rows.withColumn("total", total).select("version", "operation", "committed_at", "rows", "total").orderBy("version")


def as_of_version(table: DataFrame, version: int, column: str = "version") -> DataFrame:
    """H7: the rows of all versions up to ``version`` (a filter on the
    partition column, so later versions are not read)."""
    return table.where(F.col(column) <= F.lit(version))


def version_counts(table: DataFrame, column: str = "version") -> DataFrame:
    """H8: rows by version, in order."""
    return table.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(column)
