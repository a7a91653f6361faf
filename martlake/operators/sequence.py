"""Ordered per-key scans (lead, running sum, running max) that split hot keys.

A plain ``Window.partitionBy(key).orderBy(t)`` sorts every row of a key in
one task; a key holding a third of the data would run in a single task.
Here each key is cut into consecutive *buckets* of its order column, so the
window is ``partitionBy(key, bucket)``:

1. inside each (key, bucket): lead / inclusive running aggregates;
2. per (key, bucket): first row and bucket totals — an aggregate that
   combines map-side; the per-key window over these summaries has one row
   per non-empty bucket of the key;
3. one equi-join on (key, bucket) brings the carry-ins (offset of the
   running aggregates, first row of the next bucket) back to the rows.

The result is identical to the single-window version.

Bucketing (:func:`hot_key_buckets`): a key with at most ``max_rows`` rows
is one bucket. A *hot* key (more rows) gets a time width chosen so that a
bucket holds about ``max_rows`` of its rows on average; a bucket that is
still too large (a burst) is cut again with its own width, as often as it
takes. Hot groups are found by one aggregate per level; there are at most
``rows / max_rows`` of them, so their (key, bucket, start, width) table is
small — it is written once, its size checked, and broadcast only below
``MAX_HOT_KEYS``. Rows sharing one timestamp cannot be split by time and stay
together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.session import written

DEFAULT_BUCKET_ROWS = 1_000_000
MAX_HOT_KEYS = 1_000_000


def _micros(ts_col: str) -> Column:
    return F.unix_micros(F.col(ts_col).cast("timestamp"))


def has_hot_key(df: DataFrame, key: str, max_rows: int = DEFAULT_BUCKET_ROWS) -> bool:
    """Whether a key has more than ``max_rows`` rows (one job over the key
    column, counts combined map-side)."""
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_rows)
    return bool(hot.limit(1).count())


def hot_key_buckets(df: DataFrame, key: str, ts_col: str,
                    max_rows: int = DEFAULT_BUCKET_ROWS, levels: int | None = None) -> DataFrame:
    """Add ``_bk``, a bucket non-decreasing in ``ts_col`` within a key.

    Ordinary keys (at most ``max_rows`` rows) stay whole. A hot key is cut
    into time buckets of about ``max_rows`` rows on average; a bucket that
    still holds more (a burst) is cut again with its own, finer width, until
    none is left that time can cut (or ``levels`` times). The bucket is then
    an array path ``[b1, b2, ...]`` (arrays order lexicographically). When no
    key is hot, no join is added.
    """
    us = _micros(ts_col)
    span = (F.col("_hi") - F.col("_lo") + 1).cast("double")
    out = df.withColumn("_bk", F.array().cast("array<long>"))
    cuts = 0
    while levels is None or cuts < levels:
        hot = (out.groupBy(key, "_bk")
               .agg(F.count(F.lit(1)).alias("_n"), F.min(us).alias("_lo"), F.max(us).alias("_hi"))
               .where((F.col("_n") > F.lit(max_rows)) & (F.col("_hi") > F.col("_lo")))
               .select(key, "_bk", "_lo",
                       F.greatest(F.lit(1), F.ceil(span * F.lit(float(max_rows)) / F.col("_n")))
                       .cast("long").alias("_w")))
        # at most rows / max_rows groups: written once and counted, so the
        # broadcast below has a checked size
        hot = written(hot, "hot-keys")
        n_hot = hot.count()
        if n_hot == 0:
            break
        cuts += 1
        side = hot.withColumnRenamed(key, "_hk").withColumnRenamed("_bk", "_hbk")
        side = F.broadcast(side) if n_hot <= MAX_HOT_KEYS else side
        sub = F.when(F.col("_w").isNull(), F.lit(0).cast("long")) \
            .otherwise(F.floor((us - F.col("_lo")) / F.col("_w")))
        out = (out.join(side, out[key].eqNullSafe(side["_hk"]) & (out["_bk"] == side["_hbk"]), "left")
               .drop("_hk", "_hbk")
               .withColumn("_bk", F.concat(F.col("_bk"), F.array(sub)))
               .drop("_lo", "_w"))
    if not cuts:
        return df.withColumn("_bk", F.lit(0).cast("long"))
    return out


def ordered_scan(df: DataFrame, key: str, order: list[str], bucket: Column | None,
                 sums: dict | None = None, maxes: dict | None = None,
                 leads: dict | None = None, keep_bucket: bool = False) -> DataFrame:
    """Add per-key ordered aggregates.

    sums:  {out: column} inclusive running sum over (order)
    maxes: {out: column} inclusive running max (any orderable type)
    leads: {out: column} value of the next row of the key (NULL at the end)
    ``bucket`` must be non-decreasing along ``order`` within a key. Pass
    ``bucket=None`` to use the ``_bk`` column that the frame has, for instance
    one kept by a previous scan (``keep_bucket=True``).
    """
    sums, maxes, leads = sums or {}, maxes or {}, leads or {}
    b = df if bucket is None else df.withColumn("_bk", bucket)
    base_cols = [c for c in df.columns if c != "_bk"]
    w_in = Window.partitionBy(key, "_bk").orderBy(*order)
    w_run = w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = b
    for out, c in sums.items():
        inner = inner.withColumn(f"_s_{out}", F.sum(c).over(w_run))
    for out, c in maxes.items():
        inner = inner.withColumn(f"_m_{out}", F.max(c).over(w_run))
    for out, c in leads.items():
        inner = inner.withColumn(f"_l_{out}", F.lead(c).over(w_in))
        inner = inner.withColumn(f"_lh_{out}", F.lead(F.lit(1)).over(w_in))

    # per-bucket summaries (map-side combined)
    aggs = [F.sum(c).alias(f"_bs_{o}") for o, c in sums.items()]
    aggs += [F.max(c).alias(f"_bm_{o}") for o, c in maxes.items()]
    if leads:
        first = F.struct(*[F.col(o) for o in order],
                         *[F.col(c).alias(f"v_{o}") if isinstance(c, str) else c.alias(f"v_{o}")
                           for o, c in leads.items()])
        aggs.append(F.min(first).alias("_first"))
    summ = b.groupBy(key, "_bk").agg(*aggs)
    w_b = Window.partitionBy(key).orderBy("_bk")
    w_prev = w_b.rowsBetween(Window.unboundedPreceding, -1)
    carry = [key, "_bk"]
    carry += [F.coalesce(F.sum(f"_bs_{o}").over(w_prev), F.lit(0)).alias(f"_cs_{o}") for o in sums]
    carry += [F.max(f"_bm_{o}").over(w_prev).alias(f"_cm_{o}") for o in maxes]
    if leads:
        carry.append(F.lead("_first").over(w_b).alias("_next_first"))
    carried = summ.select(*carry).withColumnRenamed(key, "_ck").withColumnRenamed("_bk", "_cbk")

    # null-safe on the key: rows with a NULL key form one group, as in a window
    j = inner.join(carried, inner[key].eqNullSafe(carried["_ck"]) & (inner["_bk"] == carried["_cbk"]))
    outs = []
    for o in sums:
        outs.append((F.col(f"_cs_{o}") + F.col(f"_s_{o}")).alias(o))
    for o in maxes:
        outs.append(F.greatest(F.col(f"_cm_{o}"), F.col(f"_m_{o}")).alias(o))
    for o in leads:
        outs.append(F.when(F.col(f"_lh_{o}").isNotNull(), F.col(f"_l_{o}"))
                    .otherwise(F.col(f"_next_first.v_{o}")).alias(o))
    return j.select(*base_cols, *(["_bk"] if keep_bucket else []), *outs)
