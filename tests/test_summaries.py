"""Sessions in pieces, top words by summaries, and table checksums: what is
merged from parts against the whole, and what is shuffled for it."""

import random

import pytest
from pyspark.sql import functions as F

from martlake.operators import sessions as SE
from martlake.operators import text as TX
from martlake.sources import files as FS


def plain_sessions(rows, gap):
    out = {}
    for user, at, value in sorted((r for r in rows if r[1] is not None), key=lambda r: (repr(r[0]), r[1])):
        own = out.setdefault(user, [])
        if own and at - own[-1][1] < gap:
            own[-1] = (own[-1][0], at, own[-1][2] + 1, own[-1][3] + value)
        else:
            own.append((at, at, 1, value))
    return sorted(((u, a, b + gap, n, v) for u, own in out.items() for a, b, n, v in own), key=repr)


@pytest.mark.parametrize("max_rows", [1, 7, 100, 1_000_000])
def test_sessions_at_any_piece_size(spark, max_rows):
    rng = random.Random(max_rows)
    rows = [(rng.choice([None, 0, 0, 0, 1, 2, 3]), rng.choice([None, *([rng.randint(0, 40_000)] * 20)]), float(rng.randint(0, 9)))
            for _ in range(500)] + [(0, 600 * i, 1.0) for i in range(60)] + [(9, 5, 1.0)] * 40
    df = spark.createDataFrame(rows, "user_id int, s int, value double").withColumn(
        "ts", F.timestamp_seconds("s").cast("timestamp_ntz")).repartition(3)
    got = SE.sessions(df, max_bucket_rows=max_rows).select(
        "user_id", *[F.unix_seconds(F.col(c).cast("timestamp")).alias(c) for c in ("session_start", "session_end")], "n_events", "total_value")
    assert sorted(map(tuple, got.collect()), key=repr) == plain_sessions(rows, 600)


def test_a_hot_user_is_several_tasks(spark):
    """A third of all events in one user: no group of a window holds them."""
    from martlake.operators.sequence import hot_key_buckets
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("user_id"),
                                  F.timestamp_seconds(F.col("id") * 7).cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value"))
    sizes = hot_key_buckets(df, "user_id", "ts", 100).groupBy("user_id", "_bk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 200 < 1000
    got = SE.sessions(df, max_bucket_rows=100).where("user_id = 0").collect()
    assert [(r.n_events, r.total_value) for r in got] == [(1000, 1000.0)]


def test_sessions_of_no_events(spark):
    assert SE.sessions(spark.createDataFrame([], "user_id int, ts timestamp_ntz, value double")).count() == 0


@pytest.mark.parametrize("size", [1, 3, 64, 1 << 16])
def test_top_words_by_summary_equal_top_words(spark, size):
    rng = random.Random(size)
    words = [f"w{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(3000)]
    df = spark.createDataFrame([(" ".join(words[i:i + 30]),) for i in range(0, 3000, 30)] + [(None,), ("",)], "text string").repartition(3)
    for k in (1, 5, 20, 1000):
        want = TX.top_words(TX.word_counts(df), k).collect()
        assert TX.top_words_by_summary(df, k, summary_size=size).collect() == want
    assert TX.top_words_by_summary(df.limit(0), 5).count() == 0


def test_only_words_of_chosen_buckets_are_shuffled(spark, monkeypatch):
    """20 frequent words among 20,000 that come once."""
    text = " ".join(["often%d" % (i % 20) for i in range(4000)] + ["rare%d" % i for i in range(20_000)])
    df = spark.createDataFrame([(text,)], "text string")
    seen = []

    def kept(frame, name):
        seen.append((name, frame.count()))
        return frame
    monkeypatch.setattr(TX, "written", kept)
    got = TX.top_words_by_summary(df, 20)
    assert {r["word"] for r in got.collect()} == {f"often{i}" for i in range(20)}
    assert seen[1] == ("word-candidates", 20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "CartesianProduct" not in plan


def test_checksums_tell_rows_not_their_order(spark, tmp_path):
    schema = "a int, b string, c double, d timestamp_ntz, e array<float>"
    rows = [(1, "x", 0.1, None, [1.5, None]), (2, None, -0.0, None, None), (2, "", 1e-320, None, []), (1, "x", 0.1, None, [1.5, None])]
    df = spark.createDataFrame(rows, schema)
    profile = lambda d: tuple(FS.table_profile(d).first())
    assert profile(df) == profile(df.repartition(3).orderBy("c"))
    for i, j, v in ((0, 0, 3), (1, 1, ""), (2, 1, None), (0, 2, 0.1 + 2 ** -54), (0, 4, [1.5]), (1, 2, 0.0)):
        other = [list(r) for r in rows]
        other[i][j] = v
        if other[i] != list(rows[i]) or repr(other[i]) != repr(list(rows[i])):
            assert profile(spark.createDataFrame(other, schema)) != profile(df), (i, j, v)
    assert profile(spark.createDataFrame(rows[:3], schema)) != profile(df)
    assert profile(df.limit(0)) == (0, "0")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    files = FS.table_profile(spark.read.parquet(str(tmp_path / "t")), by_file=True).collect()
    assert sum(r["rows"] for r in files) == 4 and str(sum(int(r["checksum"]) for r in files)) == profile(df)[1]
    sizes = {r["path"].rsplit("/", 1)[1]: r["bytes"] for r in FS.file_sizes(spark, str(tmp_path / "t/*.parquet")).collect()}
    assert all(sizes[r["path"].rsplit("/", 1)[1]] == r["bytes"] for r in files)
