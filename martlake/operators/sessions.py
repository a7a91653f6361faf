"""Sessions of hot users, in batch.

A session is a run of one user's events of which none lies ``gap`` or more
behind the one before. Its first and last time, count and sum are all that is
needed to join it to the next, so sessions can be built in pieces:

1. each user is one bucket, a user with very many events several buckets of
   time (:mod:`martlake.operators.sequence`), and the events of a bucket are
   cut into pieces by the gaps within it;
2. only the first and the last piece of a bucket can go on in its neighbours;
   these, at most two for each bucket, are joined along the user;
3. the pieces between them are whole sessions already.

So no task orders all events of a hot user, and the result is that of one
window over the user.

Events without a time belong to no session; a null user is a user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.numeric import money_sum, to_double
from martlake.operators.sequence import DEFAULT_BUCKET_ROWS, has_hot_key, hot_key_buckets


def _numbered(df: DataFrame, keys: list[str], first: str, last: str, gap_us: int) -> DataFrame:
    """``df`` with ``_sid``, the number of the session within ``keys``."""
    w = Window.partitionBy(*keys).orderBy(first, last)
    before = F.max(last).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col(first) - before < gap_us, 0).otherwise(1)
    return (df.withColumn("_new", new)
            .withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new"))


def _joined(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys, "_sid").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"),
                                         F.sum("_n").alias("_n"), F.sum("_v").alias("_v"))


def sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", value: str = "value", gap_minutes: int = 10,
             max_bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """(user, session_start, session_end, n_events, total_value); the end is
    ``gap_minutes`` behind the last event, as session windows have it."""
    gap_us = gap_minutes * 60_000_000
    e = events.where(F.col(ts).isNotNull()).select(user, ts, value)
    hot = has_hot_key(e, user, max_bucket_rows)
    e = hot_key_buckets(e, user, ts, max_bucket_rows) if hot else e.withColumn("_bk", F.lit(0))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    # Events of one time are one row, however many there are.
    e = (e.groupBy(user, "_bk", us.alias("_first")).agg(F.count(F.lit(1)).alias("_n"), money_sum(value).alias("_v"))
         .withColumn("_last", F.col("_first")))
    pieces = _joined(_numbered(e, [user, "_bk"], "_first", "_last", gap_us), [user, "_bk"])
    if hot:
        last_piece = F.max("_sid").over(Window.partitionBy(user, "_bk"))
        pieces = pieces.withColumn("_end", (F.col("_sid") == 1) | (F.col("_sid") == last_piece))
        ends = _numbered(pieces.where("_end").drop("_sid", "_end"), [user], "_first", "_last", gap_us)
        whole = pieces.where(~F.col("_end")).select(user, "_first", "_last", "_n", "_v")
        pieces = whole.unionByName(_joined(ends, [user]).select(user, "_first", "_last", "_n", "_v"))

    def time(c):
        return F.timestamp_micros(c).cast("timestamp_ntz")
    return pieces.select(user, time(F.col("_first")).alias("session_start"),
                         time(F.col("_last") + gap_us).alias("session_end"),
                         F.col("_n").alias("n_events"), to_double("_v").alias("total_value"))
