"""Streaming queries over the files of ``events``, each checked against its
plain batch query in SQL (T1-T5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.operators import sessions as SE
from martlake.plans.registry import query
from martlake.session import scratch_path
from martlake.sources import tables as T
from martlake.streaming import events as ST


def _source(d) -> str:
    """The given table as a stream's source: a pattern, which may match a file
    or a folder (a plain path must be a folder)."""
    return f"{d.rstrip('/')}/events.parque[t]"


def _read(spark, path):
    return spark.read.parquet(path)


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_ingest(spark, d):
    """File arrival ingested to completion (availableNow)."""
    s = ST.event_stream(spark, _source(d)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return _read(spark, ST.run_to_parquet(s, "ingest"))


@query("stream_tumbling", f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type,
       COUNT(*) AS n_events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2, 3""")
def stream_tumbling(spark, d):
    """Hourly tumbling windows with a 10-minute watermark."""
    return _read(spark, ST.run_to_parquet(ST.tumbling_counts(ST.closed_stream(spark, _source(d))), "tumbling"))


@query("stream_sliding", f"""
WITH w AS (
  SELECT time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * o AS window_start, event_type, value
  FROM events, (VALUES (0), (1)) t(o))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type,
       COUNT(*) AS n_events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM w GROUP BY 1, 2, 3""")
def stream_sliding(spark, d):
    """1-hour windows sliding by 30 minutes."""
    return _read(spark, ST.run_to_parquet(ST.sliding_counts(ST.closed_stream(spark, _source(d))), "sliding"))


SESSION_SQL = """
WITH g AS (
  SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                      < INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS new_s FROM events),
s AS (SELECT *, SUM(new_s) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                  ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 10 MINUTE AS session_end,
       COUNT(*) AS n_events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM s GROUP BY user_id, sid"""


@query("stream_session", SESSION_SQL)
def stream_session(spark, d):
    """Per-user sessions with a 10-minute gap."""
    return _read(spark, ST.run_to_parquet(ST.sessions(ST.closed_stream(spark, _source(d))), "session"))


@query("session_batch", SESSION_SQL)
def session_batch(spark, d):
    """T3 in batch: sessions in pieces, which splits users with very many events."""
    return SE.sessions(T.events(spark, d))


@query("session_batch_pieces", SESSION_SQL)
def session_batch_pieces(spark, d):
    """T3 in batch with small pieces: a user of over eight events is several."""
    return SE.sessions(T.events(spark, d), max_bucket_rows=8)


@query("stream_classify", """
SELECT event_id, ts, user_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
       CASE WHEN value / 10.0 > 30 THEN 'high temperature'
            WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) > 70 THEN 'high humidity'
            ELSE 'normal' END AS condition
FROM events""")
def stream_classify(spark, d):
    """Threshold classification on the stream."""
    return _read(spark, ST.run_to_parquet(ST.classify(ST.event_stream(spark, _source(d))), "classify"))


@query("stream_routing", """
SELECT event_id, ts, user_id, event_type, value, props,
       COALESCE(event_type <> 'error' AND value > 1.0, false) AS valid FROM events""")
def stream_routing(spark, d):
    """T4 / Q6: both sides of the per-batch valid/invalid routing."""
    s = ST.event_stream(spark, _source(d)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    good, bad = ST.route_valid_invalid(s, (F.col("event_type") != "error") & (F.col("value") > 1.0))
    sides = [_read(spark, p).drop("batch_id").withColumn("valid", F.lit(ok)) for p, ok in ((good, True), (bad, False))]
    return sides[0].unionByName(sides[1])


def _in_two_halves(spark, d):
    """The events as two files for each task: those of even ids and, arriving
    after them, those of odd ids, which are late but for the last windows."""
    folder = scratch_path(spark, "halves")
    e = T.events(spark, d)
    e.where("event_id % 2 = 0").write.parquet(f"{folder}/even")
    return f"{folder}/*", lambda: e.where("event_id % 2 <> 0").write.parquet(f"{folder}/odd")


LATE_SQL = """
e AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS w FROM events),
m AS (SELECT MAX(ts) AS latest FROM events WHERE event_id % 2 = 0),
f AS (SELECT e.*, event_id % 2 <> 0 AND w + INTERVAL 1 HOUR + INTERVAL 10 MINUTE <= latest AS late FROM e, m)"""


@query("stream_in_time", f"""
WITH {LATE_SQL}
SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, event_type, COUNT(*) AS n_events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM f WHERE NOT late GROUP BY w, event_type""")
def stream_in_time(spark, d):
    """Windows of the events in time, where half of them arrive later."""
    source, arrive = _in_two_halves(spark, d)
    return ST.windows_with_late_rows(spark, source, arrivals=[arrive])[0]


@query("stream_late_rows", f"""
WITH {LATE_SQL}
SELECT event_id, ts, user_id, event_type, value, props FROM f WHERE late""")
def stream_late_rows(spark, d):
    """The late ones of the same events, as a dead letter."""
    source, arrive = _in_two_halves(spark, d)
    return ST.windows_with_late_rows(spark, source, arrivals=[arrive])[1]


@query("stream_distinct", "SELECT DISTINCT event_id, ts, user_id, event_type, value, props FROM events")
def stream_distinct(spark, d):
    """Files that are delivered twice change nothing."""
    folder = scratch_path(spark, "twice")
    e = T.events(spark, d)
    for name in ("first", "again"):
        e.write.parquet(f"{folder}/{name}")
    s = ST.distinct_events(ST.event_stream(spark, f"{folder}/*"))
    return _read(spark, ST.run_to_parquet(s.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "distinct"))
