"""History, point-in-time, apply-changes and table-version queries (H1-H8,
J5, J9, J10, W3-W5, O5).

The change set is derived from ``events``: key = user_id, change time = ts,
sequence = event_id, op = I for 'signup', D for 'error', U otherwise;
payload = (event_type, value).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.operators import history as H
from martlake.plans.registry import query
from martlake.plans.sql_helpers import PRODUCTS, with_
from martlake.session import scratch_path
from martlake.sources import tables as T

STATE_TS = "2024-01-15 12:00:00"
HISTORY_KEY = 7


def changes(spark, d):
    e = T.events(spark, d)
    op = (F.when(F.col("event_type") == "signup", "I")
          .when(F.col("event_type") == "error", "D").otherwise("U"))
    return e.select("user_id", "ts", "event_id", op.alias("op"), "event_type", "value")


def history(spark, d):
    return H.build_history(changes(spark, d), "user_id", "ts", "event_id", "op",
                           ["event_type", "value"])


CHANGES_SQL = """
ch AS (SELECT user_id, ts, event_id,
              CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
              event_type, value FROM events),
s AS (SELECT *, SUM(CASE WHEN op <> 'D' THEN 1 ELSE 0 END) OVER w AS live_cum,
             LAST_VALUE(CASE WHEN op <> 'D' THEN event_id END IGNORE NULLS) OVER w AS closed_seq,
             LAST_VALUE(CASE WHEN op <> 'D' THEN event_type END IGNORE NULLS) OVER w AS closed_type,
             LAST_VALUE(CASE WHEN op <> 'D' THEN value END IGNORE NULLS) OVER w AS closed_value,
             LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
      FROM ch WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, MAX(CASE WHEN op = 'I' THEN live_cum - 1 ELSE 0 END) OVER
                (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS base FROM s),
hist AS (SELECT user_id, CASE WHEN op = 'D' AND closed_seq IS NOT NULL THEN closed_type ELSE event_type END AS event_type,
                CASE WHEN op = 'D' AND closed_seq IS NOT NULL THEN closed_value ELSE value END AS value, CAST(live_cum - base AS INTEGER) AS version,
                ts AS valid_from, CASE WHEN op = 'D' THEN ts ELSE next_ts END AS valid_to,
                op AS operation, event_id AS change_seq FROM b)"""


@query("history_build", with_(CHANGES_SQL) + "SELECT * FROM hist")
def history_build(spark, d):
    """SCD-2 rows from the change set."""
    return history(spark, d)


@query("history_of_key", with_(CHANGES_SQL) + f"""
SELECT * FROM hist WHERE user_id = {HISTORY_KEY}
ORDER BY valid_from DESC, version DESC, change_seq DESC""")
def history_of_key(spark, d):
    """The listing of one key, newest first."""
    return H.history_of_key(changes(spark, d), "user_id", "ts", "event_id", "op",
                            ["event_type", "value"], HISTORY_KEY)


@query("state_at", with_(CHANGES_SQL) + f"""
SELECT user_id, event_type, value, version, valid_from, valid_to, operation, change_seq
FROM hist
WHERE valid_from <= TIMESTAMP '{STATE_TS}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{STATE_TS}')
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY valid_from DESC, change_seq DESC) = 1""")
def state_at(spark, d):
    """Every key's state at one timestamp."""
    return H.state_at(history(spark, d), "user_id", F.expr(f"TIMESTAMP_NTZ '{STATE_TS}'"))


def probes(spark, d):
    e = T.events(spark, d)
    return (e.select("user_id", (F.date_trunc("day", "ts") + F.expr("INTERVAL 12 HOURS"))
                     .cast("timestamp_ntz").alias("probe_ts")).distinct())


@query("asof_lookup", with_(CHANGES_SQL) + """
, p AS (SELECT DISTINCT user_id, date_trunc('day', ts) + INTERVAL 12 HOUR AS probe_ts FROM events)
, c AS (SELECT p.user_id, p.probe_ts, h.*, ROW_NUMBER() OVER (
          PARTITION BY p.user_id, p.probe_ts ORDER BY h.valid_from DESC, h.change_seq DESC) AS rn
        FROM p LEFT JOIN hist h ON h.user_id = p.user_id AND h.valid_from <= p.probe_ts)
SELECT user_id, probe_ts,
       CASE WHEN ok THEN valid_from END AS valid_from, CASE WHEN ok THEN version END AS version,
       CASE WHEN ok THEN event_type END AS event_type, CASE WHEN ok THEN value END AS value
FROM (SELECT *, valid_from IS NOT NULL AND (valid_to IS NULL OR valid_to > probe_ts) AS ok
      FROM c WHERE rn = 1)""")
def asof_lookup(spark, d):
    """J5 for many probes (each user, each active day at noon)."""
    return H.asof_lookup(history(spark, d), probes(spark, d), "user_id", "probe_ts",
                         ["event_type", "value"])


BUCKETS = 16
_UPDATED_SQL = with_(CHANGES_SQL) + f"""
, cur AS (SELECT user_id, value, valid_from AS changed_at FROM hist
          WHERE valid_from <= TIMESTAMP '{STATE_TS}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{STATE_TS}')
          QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY valid_from DESC, change_seq DESC) = 1)
, upd AS (SELECT user_id, value, ts AS changed_at FROM events
          WHERE ts > TIMESTAMP '{STATE_TS}' AND event_type = 'purchase')
, u AS (SELECT *, 0 AS src FROM cur UNION ALL SELECT *, 1 FROM upd)
SELECT user_id, value, changed_at FROM u
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY changed_at DESC, src DESC) = 1"""


def _state_and_updates(spark, d):
    cur = (H.state_at(history(spark, d), "user_id", F.expr(f"TIMESTAMP_NTZ '{STATE_TS}'"))
           .select("user_id", "value", F.col("valid_from").alias("changed_at")))
    e = T.events(spark, d)
    upd = (e.where((F.col("ts") > F.expr(f"TIMESTAMP_NTZ '{STATE_TS}'")) &
                   (F.col("event_type") == "purchase"))
           .select("user_id", "value", F.col("ts").alias("changed_at")))
    return cur, upd


@query("apply_updates", _UPDATED_SQL)
def apply_updates(spark, d):
    """H5: later purchase values applied to the state at a timestamp."""
    return H.apply_changes(*_state_and_updates(spark, d), "user_id", "changed_at")


@query("apply_updates_kept", _UPDATED_SQL)
def apply_updates_kept(spark, d):
    """H5 kept up: the state as a table, the updates applied to it in two
    deliveries; equals one merge of all."""
    cur, upd = _state_and_updates(spark, d)
    path = scratch_path(spark, "kept-state")
    H.write_keyed(cur, path, "user_id", BUCKETS)
    for k in range(2):
        H.apply_changes_to(spark, path, upd.where(F.pmod("user_id", F.lit(2)) == k), "user_id", "changed_at", BUCKETS)
    return spark.read.parquet(path).drop("bucket")


@query("add_column_default", with_(PRODUCTS) + """
SELECT *, CAST(10 AS INTEGER) AS reorder_level, CAST(50 AS INTEGER) AS reorder_quantity,
       true AS is_active FROM products""")
def add_column_default(spark, d):
    """H6: new columns whose existing rows read the default."""
    return H.with_default_columns(T.products(spark, d), {
        "reorder_level": ("int", 10), "reorder_quantity": ("int", 50), "is_active": ("boolean", True)})


def _versioned(spark, d):
    path = scratch_path(spark, "versioned-orders")
    o = T.table(spark, d, "orders")
    H.write_version(o.where(F.year("o_orderdate") <= 1996), path, 1)
    H.write_version(o.where(F.year("o_orderdate") == 1997), path, 2)
    H.write_version(o.where(F.year("o_orderdate") >= 1998).withColumn("o_discount", F.lit(0.0)), path, 3)
    return spark.read.option("mergeSchema", True).parquet(path)


@query("version_as_of", """
SELECT *, CAST(NULL AS DOUBLE) AS o_discount, CASE WHEN year(o_orderdate) <= 1996 THEN 1 ELSE 2 END AS version
FROM orders WHERE year(o_orderdate) <= 1997""")
def version_as_of(spark, d):
    """H7: rows appended in three versions, the last with a further column;
    read as of version 2."""
    return H.as_of_version(_versioned(spark, d), 2)


@query("version_latest", """
SELECT *, CASE WHEN year(o_orderdate) >= 1998 THEN CAST(0.0 AS DOUBLE) END AS o_discount,
       CASE WHEN year(o_orderdate) <= 1996 THEN 1 WHEN year(o_orderdate) = 1997 THEN 2 ELSE 3 END AS version FROM orders""")
def version_latest(spark, d):
    """H7: all versions; older rows lack the column that came later."""
    return _versioned(spark, d)


@query("version_history", """
SELECT CASE WHEN year(o_orderdate) <= 1996 THEN 1 WHEN year(o_orderdate) = 1997 THEN 2 ELSE 3 END AS version,
       COUNT(*) AS rows FROM orders GROUP BY 1""")
def version_history(spark, d):
    """H8: rows by version."""
    return H.version_counts(_versioned(spark, d))


@query("orphan_rows_with_nulls", """
WITH c AS (SELECT CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS o_custkey FROM orders)
SELECT o_custkey, COUNT(*) AS orders FROM c
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0) GROUP BY o_custkey""")
def orphan_rows_with_nulls(spark, d):
    """Orders without a customer refer to nothing and are no orphans;
    those of customers that are missing are."""
    o = T.table(spark, d, "orders").select(
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"))
    c = T.table(spark, d, "customer").where(F.col("c_custkey") % 5 != 0)
    return H.orphans(o, c, "o_custkey", "c_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))


@query("pending_batches", """
WITH m AS (SELECT DISTINCT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS batch FROM lineitem),
a AS (SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS batch FROM orders)
SELECT batch FROM m WHERE batch NOT IN (SELECT batch FROM a) ORDER BY batch""")
def pending_batches(spark, d):
    """Monthly shipment batches (the manifest) whose month has no order
    batch applied yet (the success log), in batch order (anti join)."""
    def month_key(c):
        return (F.year(c) * 100 + F.month(c)).cast("int").alias("batch")
    manifest = T.table(spark, d, "lineitem").select(month_key("l_shipdate")).distinct()
    applied = T.table(spark, d, "orders").select(month_key("o_orderdate"))
    return H.pending(manifest, applied, "batch")


@query("orphan_rows", """
SELECT 'lineitem.l_orderkey' AS relation, COUNT(*) AS orphans FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem.l_partkey', COUNT(*) FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'orders.o_custkey', COUNT(*) FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def orphan_rows(spark, d):
    """Foreign-key orphan report (anti joins)."""
    li, o = T.table(spark, d, "lineitem"), T.table(spark, d, "orders")
    p, c = T.table(spark, d, "part"), T.table(spark, d, "customer")
    parts = [("lineitem.l_orderkey", H.orphans(li, o, "l_orderkey", "o_orderkey")),
             ("lineitem.l_partkey", H.orphans(li, p, "l_partkey", "p_partkey")),
             ("orders.o_custkey", H.orphans(o, c, "o_custkey", "c_custkey"))]
    out = None
    for name, frame in parts:
        r = frame.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(name).alias("relation"), "orphans")
        out = r if out is None else out.unionByName(r)
    return out


@query("history_merge", with_(CHANGES_SQL) + "SELECT * FROM hist")
def history_merge(spark, d):
    """H1 / W3 / W4 kept up: a history of the changes up to a time, merged
    twice, with later changes and with late ones of any time, equals the
    history of all changes."""
    c = changes(spark, d)
    late = F.col("event_id") % 97 == 0
    early = F.col("ts") <= F.expr(f"TIMESTAMP_NTZ '{STATE_TS}'")
    names = ("user_id", "ts", "event_id", "op", ["event_type", "value"])
    path = scratch_path(spark, "kept-history")
    H.write_history(H.build_history(c.where(early & ~late), *names), path, "user_id", BUCKETS)
    for part in (c.where(~early & ~late), c.where(late)):
        H.merge_into_history(spark, path, part, *names, buckets=BUCKETS)
    return spark.read.parquet(path).drop("bucket")


def _replaced(spark, d):
    """Orders created and appended to, then replaced by a wider table that is
    appended to again."""
    path = scratch_path(spark, "replaced-orders")
    o = T.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    year = F.year("o_orderdate")
    wide = o.withColumn("o_year", year)
    for version, (operation, rows) in enumerate([
            ("create", o.where(year <= 1995)), ("append", o.where(year == 1996)),
            ("replace", wide.where(year >= 1997)), ("append", wide.where(year == 1992))], 1):
        H.commit_version(rows, path, version, operation, f"2024-03-0{version} 12:00:00")
    return path


@query("version_before_replace", """
SELECT o_orderkey, o_totalprice, o_orderdate, CASE WHEN year(o_orderdate) <= 1995 THEN 1 ELSE 2 END AS version
FROM orders WHERE year(o_orderdate) <= 1996""")
def version_before_replace(spark, d):
    """H7: as of the version before a replacing one."""
    return H.read_version(spark, _replaced(spark, d), 2)


@query("version_after_replace", """
SELECT o_orderkey, o_totalprice, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS o_year,
       CASE WHEN year(o_orderdate) = 1992 THEN 4 ELSE 3 END AS version
FROM orders WHERE year(o_orderdate) >= 1997 OR year(o_orderdate) = 1992""")
def version_after_replace(spark, d):
    """H7: the latest version hides what the replacing one replaced."""
    return H.read_version(spark, _replaced(spark, d))


@query("version_commits", """
WITH c AS (
  SELECT 1 AS version, 'create' AS operation, COUNT(*) FILTER (year(o_orderdate) <= 1995) AS rows FROM orders
  UNION ALL SELECT 2, 'append', COUNT(*) FILTER (year(o_orderdate) = 1996) FROM orders
  UNION ALL SELECT 3, 'replace', COUNT(*) FILTER (year(o_orderdate) >= 1997) FROM orders
  UNION ALL SELECT 4, 'append', COUNT(*) FILTER (year(o_orderdate) = 1992) FROM orders)
SELECT version, operation, TIMESTAMP '2024-02-29 12:00:00' + INTERVAL 1 DAY * version AS committed_at, rows,
       CAST(SUM(rows) OVER (PARTITION BY version >= 3 ORDER BY version) AS BIGINT) AS total FROM c""")
def version_commits(spark, d):
    """H8: versions with operation, commit time and rows."""
    return H.version_log(spark, _replaced(spark, d))
