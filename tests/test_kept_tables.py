"""Tables that are kept up by deltas: history, versions, monthly sums; each
equals a rebuild, and what a delta does not touch is neither read nor written."""

import glob
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from martlake.operators import history as H

SCHEMA = "k int, t long, seq int, op string, a double, b string"
NAMES = ("k", "t", "seq", "op", ["a", "b"])


def frame(spark, rows):
    return (spark.createDataFrame(rows, SCHEMA).withColumn("t", F.col("t").cast("timestamp").cast("timestamp_ntz")))


def changes(rng, n, first=0):
    return [(rng.choice([None, 0, 0, 0, *range(1, 25)]), 1_700_000_000 + rng.randint(0, 400), first + i, rng.choice("IUUUD"),
             rng.choice([None, float(i)]), rng.choice([None, "x", "y"])) for i in range(n)]


def listed(df):
    return sorted(map(repr, df.select("k", "a", "b", "version", "valid_from", "valid_to", "operation", "change_seq").collect()))


@pytest.mark.parametrize("max_rows", [20, 1_000_000])
def test_merged_history_equals_a_rebuild(spark, max_rows):
    rng = random.Random(max_rows)
    rows = changes(rng, 600)
    rows.sort(key=lambda r: (r[1], r[2]))
    late, rest = [r for r in rows if r[2] % 9 == 0], [r for r in rows if r[2] % 9]
    parts = [rest[:200], rest[200:], late]
    history = H.build_history(frame(spark, parts[0]), *NAMES)
    for n, part in enumerate(parts[1:], 2):
        history = H.merge_history(history, frame(spark, part), *NAMES, max_bucket_rows=max_rows)
        history = spark.createDataFrame(history.collect(), history.schema)
        assert listed(history) == listed(H.build_history(frame(spark, sum(parts[:n], [])), *NAMES))


def test_deletes_first_and_no_changes(spark):
    rows = [(1, 10, 1, "D", 1.0, "own"), (1, 20, 2, "D", 2.0, "own too"), (2, 10, 3, "U", 3.0, "u"), (2, 10, 4, "D", 4.0, "x")]
    history = H.build_history(frame(spark, rows[:1] + rows[2:3]), *NAMES)
    merged = H.merge_history(history, frame(spark, rows[1:2] + rows[3:]), *NAMES)
    assert listed(merged) == listed(H.build_history(frame(spark, rows), *NAMES))
    assert listed(H.merge_history(merged, frame(spark, []), *NAMES)) == listed(merged)
    late = [(1, 5, 9, "I", 9.0, "late")]       # now the deletes close something
    assert listed(H.merge_history(merged, frame(spark, late), *NAMES)) == listed(H.build_history(frame(spark, rows + late), *NAMES))
    assert listed(H.merge_history(history.limit(0), frame(spark, rows), *NAMES)) == listed(H.build_history(frame(spark, rows), *NAMES))


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/bucket=*/*.parquet")}


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    rng = random.Random(5)
    path, rows = str(tmp_path / "history"), changes(rng, 400)
    H.write_history(H.build_history(frame(spark, rows), *NAMES), path, "k", 8)
    before = files(path)
    new = [(7, 1_800_000_000, 900, "U", 1.0, "n"), (7, 1_600_000_000, 901, "I", 1.0, "n"), (77, 1_800_000_000, 902, "I", 1.0, "n")]
    delta = frame(spark, new)
    old = H.touched_buckets(spark.read.parquet(path), delta, "k", 8)
    hit = {r[0] for r in delta.select(H._bucket("k", 8)).distinct().collect()}
    scan = old._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#", scan) and len(hit) < len({os.path.dirname(f) for f in before})
    assert {r[0] for r in old.select("bucket").distinct().collect()} <= hit
    H.merge_into_history(spark, path, delta, *NAMES, buckets=8)
    after = files(path)
    kept = {f for f in before if not any(f"bucket={b}/" in f for b in hit)}
    assert kept and {f: after.get(f) for f in kept} == {f: before[f] for f in kept}
    assert listed(spark.read.parquet(path)) == listed(H.build_history(frame(spark, rows + new), *NAMES))


def test_updates_replace_only_touched_buckets(spark, tmp_path):
    """Old and new keys, ties to the update, older updates, repeats, a NULL
    key; other buckets keep their files; a rerun and no updates change nothing."""
    path, schema = str(tmp_path / "state"), "k int, v string, at int"
    rows = lambda df: sorted(map(repr, df.select("k", "v", "at").collect()))
    current = spark.createDataFrame([(i, f"v{i}", 5) for i in range(60)] + [(None, "none", 5)], schema)
    new = spark.createDataFrame([(3, "tie", 5), (4, "late", 1), (5, "x", 8), (5, "y", 9), (700, "new", 2), (None, "some", 6)], schema)
    want = rows(H.apply_changes(current, new, "k", "at"))
    H.write_keyed(current.repartition(5), path, "k", 32)
    before = files(path)
    H.apply_changes_to(spark, path, new, "k", "at", 32)
    hit = {r[0] for r in new.select(H._bucket("k", 32)).distinct().collect()}
    kept = {f for f in before if not any(f"bucket={b}/" in f for b in hit)}
    assert kept and {f: files(path).get(f) for f in kept} == {f: before[f] for f in kept}
    assert not {f for f in before if f not in kept and f.endswith(".parquet")} & set(files(path))
    assert rows(spark.read.parquet(path)) == want
    H.apply_changes_to(spark, path, new, "k", "at", 32)
    assert rows(spark.read.parquet(path)) == want
    again = files(path)
    H.apply_changes_to(spark, path, new.limit(0), "k", "at", 32)
    assert {f: n for f, n in files(path).items() if "bucket=" in f} == {f: n for f, n in again.items() if "bucket=" in f}


def test_versions_replace_and_commit_times(spark, tmp_path):
    p = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a")], "id int, v string")
    wide = spark.createDataFrame([(3, "c", 0.5)], "id int, v string, d double")
    with pytest.raises(ValueError):
        H.commit_version(one, p, 1, "append", "2024-01-01")
    H.commit_version(one, p, 1, "create", "2024-01-01")
    for _ in range(2):   # a rerun rewrites its version
        H.commit_version(spark.createDataFrame([(2, "b")], "id int, v string"), p, 2, "append", "2024-01-02")
    H.commit_version(wide, p, 3, "replace", "2024-01-03")
    H.commit_version(one, p, 4, "append", "2024-01-04")
    H.write_version(one, p, 5)   # not committed: not there
    rows = lambda v=None: sorted((r.id, r.version) for r in H.read_version(spark, p, v).collect())
    assert rows(1) == [(1, 1)] and rows(2) == [(1, 1), (2, 2)] and rows(3) == [(3, 3)] and rows() == [(1, 4), (3, 3)]
    assert H.read_version(spark, p, 2).columns == ["id", "v", "version"]
    latest = H.read_version(spark, p)
    assert latest.columns == ["id", "v", "d", "version"] and {r.d for r in latest.collect()} == {0.5, None}
    assert all("version=1" not in f and "version=2" not in f for f in latest.inputFiles())
    assert [(r.version, r.operation, str(r.committed_at)[:10], r.rows, r.total) for r in H.version_log(spark, p).collect()] == [
        (1, "create", "2024-01-01", 1, 1), (2, "append", "2024-01-02", 1, 2), (3, "replace", "2024-01-03", 1, 1),
        (4, "append", "2024-01-04", 1, 2)]
    with pytest.raises(ValueError):
        H.read_version(spark, p, 9)


SALES = "sale_date date, customer_id int, category string, quantity double, price double"


def sales_rows(rng, n):
    return [(f"2024-{rng.randint(1, 6):02d}-{rng.randint(1, 28):02d}", rng.randint(1, 9), rng.choice("ab"), float(rng.randint(1, 5)),
             rng.randint(1, 999) / 100) for _ in range(n)]


def test_monthly_table_equals_a_rebuild(spark, tmp_path):
    from martlake.operators import sales as S
    rng = random.Random(6)
    customers = spark.createDataFrame([(i, "east" if i % 2 else "west") for i in range(1, 10)], "customer_id int, region string")
    make = lambda rows: spark.createDataFrame([(*r,) for r in rows], SALES.replace("date,", "string,", 1)).withColumn(
        "sale_date", F.to_date("sale_date"))
    first, path = sales_rows(rng, 300), str(tmp_path / "monthly")
    second = [("2024-03-05", *r[1:]) for r in sales_rows(rng, 20)] + [("2024-09-01", 1, "c", 1.0, 1.0)]
    S.write_monthly(S.monthly_base(customers, make(first), as_double=False), path)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/year=*/month=*/*.parquet")}
    S.refresh_monthly(spark, path, S.monthly_base(customers, make(second), as_double=False))
    got = S.read_monthly(spark, path)
    want = S.monthly_base(customers, make(first + second), as_double=False)
    key = lambda df: sorted(map(repr, df.select("year", "month", "category", "region", "n_transactions", F.col("total_quantity").cast("double"),
                                                F.col("revenue").cast("double")).collect()))
    assert key(got) == key(want)
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/year=*/month=*/*.parquet")}
    kept = {f for f in before if "month=3/" not in f}
    assert kept and {f: after.get(f) for f in kept} == {f: before[f] for f in kept}
    undone = S.monthly_base(customers, make(second), as_double=False)
    S.refresh_monthly(spark, path, undone, sign=-1)
    assert key(S.read_monthly(spark, path)) == key(S.monthly_base(customers, make(first), as_double=False))
