"""Edge semantics on literal frames (NULLs, ties, empty input, constant
columns) that the generated tables cannot show."""

import math
import random
import re
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlake.operators import cleaning as C
from martlake.operators import currency as CUR
from martlake.operators import features as X
from martlake.operators import history as H
from martlake.operators import quality as Q
from martlake.operators import text as TX
from martlake.operators.sequence import ordered_scan
from martlake.operators.stats import exact_quantiles, mode_value, quantiles_multi


def _linear_quantile(vals, p):
    vals = sorted(vals)
    pos = p * (len(vals) - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    if lo == hi:
        return vals[lo]
    return (hi - pos) * vals[lo] + (pos - lo) * vals[hi]


# ---- statistics ---------------------------------------------------------------

def test_exact_quantiles_match_brute_force(spark):
    rng = random.Random(7)
    # a third of all rows hold one value (hot value) plus spread values
    vals = [500.0] * 3000 + [round(rng.uniform(0, 1000), 2) for _ in range(6000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    row = exact_quantiles(df, "x", probs).collect()[0]
    for i, p in enumerate(probs):
        assert row[i] == pytest.approx(_linear_quantile(vals, p), abs=1e-9)


def test_quantiles_multi_columns_and_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 10.0), (None, 20.0), (4.0, None)],
                               "a double, b double")
    r = quantiles_multi(df, {"ma": ("a", 0.5), "mb": ("b", 0.5)}).collect()[0]
    assert r.ma == 2.0 and r.mb == 15.0


def test_quantile_all_null_is_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]).collect()[0][0] is None


def test_mode_smallest_on_ties_and_all_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert mode_value(df, "c").collect()[0][0] == "a"
    nulls = spark.createDataFrame([(None,)], "c string")
    assert mode_value(nulls, "c").collect()[0][0] is None


# ---- cleaning -----------------------------------------------------------------

def test_clean_column_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "` Product Name` int, `price ` int")
    assert C.clean_column_names(df).columns == ["product_name", "price"]
    bad = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        C.clean_column_names(bad)


def test_distinct_treats_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert C.drop_duplicates(df).count() == 2


def test_keep_first_with_null_keys(spark):
    df = spark.createDataFrame([(3, None, "c"), (1, None, "a"), (2, "k", "b"), (5, "k", "z")],
                               "id int, k string, v string")
    out = {(r.k, r.id, r.v) for r in C.keep_first(df, ["k"], "id").collect()}
    assert out == {(None, 1, "a"), ("k", 2, "b")}


def test_fill_order_drop_then_statistic(spark):
    # price median must be taken AFTER the rows with NULL name are dropped
    df = spark.createDataFrame(
        [(None, 100.0, None), ("a", None, "x"), ("b", 1.0, None), ("c", 3.0, "x")],
        "name string, price double, cat string")
    out = C.handle_missing_values(df, {"name": "drop", "price": "median", "cat": "mode",
                                       "nope": "mean", "cat2": "weird"})
    rows = sorted(out.collect(), key=lambda r: r.name)
    assert [r.name for r in rows] == ["a", "b", "c"]
    assert rows[0].price == 2.0            # median of 1 and 3, not of 1, 3, 100
    assert rows[1].cat == "x"


def test_fill_zero_empty_and_non_numeric_mean(spark):
    df = spark.createDataFrame([(None, None), (2, "x")], "n int, s string")
    out = C.handle_missing_values(df, {"n": "zero", "s": "empty_string"}).collect()
    assert sorted((r.n, r.s) for r in out) == [(0, ""), (2, "x")]
    same = C.handle_missing_values(df, {"s": "mean"})       # warns, skipped
    assert sorted(same.collect(), key=str) == sorted(df.collect(), key=str)


def test_normalize_constant_column_gives_null(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "id int, c double, v double")
    out = X.normalize_numeric_columns(df)
    assert "id_normalized" not in out.columns
    rows = sorted(out.collect(), key=lambda r: r.id)
    assert rows[0].c_normalized is None and rows[1].v_normalized == 1.0


def test_outliers_extreme_value_replaced_by_median_of_all(spark):
    vals = [10.0, 11.0, 12.0, 13.0, 1000.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    out = {r.id: r for r in X.handle_outliers(df, "iqr", 1.5).collect()}
    assert out[4].x_outlier and out[4].x == 12.0       # median includes the outlier
    assert not out[0].x_outlier


def test_zscore_constant_column_flags_nothing(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, None)], "id int, x double")
    out = X.handle_outliers(df, "zscore", 1.5).collect()
    assert not any(r.x_outlier for r in out)


def test_word_count_feature(spark):
    df = spark.createDataFrame([("a b  c",), ("",), ("   ",), (None,)], "d string")
    got = [r[0] for r in df.select(X.word_count("d")).collect()]
    assert got == [3, 0, 0, None]


def test_features_null_price_not_expensive(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, 3.0, "a"), (3, None, None)],
                               "product_id int, price double, category string")
    out = {r.product_id: r for r in X.generate_features(df).collect()}
    assert out[2].is_expensive and not out[1].is_expensive and not out[3].is_expensive
    assert out[3].category_avg_price is None and out[1].category_avg_price == 2.0


# ---- currency -----------------------------------------------------------------

def test_currency_rounding_and_modes(spark):
    rates = CUR.rates_frame(spark, {"USD": 1.0, "CZK": 25.5})
    df = spark.createDataFrame([(1.005,), (2.0,)], "price double")
    out = CUR.enrich_with_currency(df, rates, "price", ["USD"], "EUR").collect()
    assert sorted(r.price_USD for r in out) == [1.01, 2.0]
    with pytest.raises(ValueError):
        CUR.enrich_with_currency(df, rates, "price", ["XXX"], "EUR", strict=True)
    tol = CUR.enrich_with_currency(df, rates, "price", ["XXX"], "EUR", strict=False)
    assert tol.columns == ["price", "price_currency"]


def test_only_the_product_is_rounded(spark):
    rates = CUR.rates_frame(spark, {"JPY": 160.25, "USD": 1.123456})
    df = spark.createDataFrame([(12.345,), (0.004,)], "price double")
    out = {r.price: (r.price_JPY, r.price_USD) for r in
           CUR.enrich_with_currency(df, rates, "price", ["JPY", "USD"], "EUR").collect()}
    assert out == {12.345: (1978.29, 13.87), 0.004: (0.64, 0.0)}


def test_many_rate_rows_and_code_order(spark):
    rows = [("USD", 1.0 + i / 1e4) for i in range(1200)] + [("CZK", 25.0)]
    rates = spark.createDataFrame(rows, "currency string, rate double").repartition(5)
    assert CUR.available_currencies(rates, "EUR") == ["CZK", "USD", "EUR"]
    assert CUR.available_currencies(rates, "USD") == ["CZK", "USD"]


def test_money_below_a_cent(spark):
    from martlake.operators import sales as S
    df = spark.createDataFrame([("a", 0.004, 3.0, 0.004), ("a", 0.004, 2.0, 0.004)],
                               "category string, price double, quantity double, total double")
    r = S.category_stats(df).first()
    assert (r.revenue, r.total_sales_amount) == (0.02, 0.008)


def test_a_customer_listed_twice_counts_once(spark):
    from martlake.operators import sales as S
    cust = spark.createDataFrame([(1, "n", "s"), (2, "n", "s"), (2, "n", "s")], "customer_id int, region string, segment string")
    sales = spark.createDataFrame([(1, "c", 1.0, 1.0, 1.0), (2, "c", 1.0, 1.0, 2.0)],
                                  "customer_id int, category string, price double, quantity double, total double")
    assert S.region_stats(cust, sales).first().number_of_customers == 2
    assert S.segment_category_customers(cust, sales).first().number_of_customers == 2


def test_null_foreign_key_is_no_orphan(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert [r.fk for r in H.orphans(child, parent, "fk", "pk").collect()] == [2, 2]


def test_pii_names_are_joined_without_a_separator(spark):
    import hashlib
    df = spark.createDataFrame([("a@b", "Jan", "Novak")], "email string, first_name string, last_name string")
    r = Q.anonymize_pii(df).first()
    assert r.hashed_name == hashlib.sha256(b"JanNovak").hexdigest()


def test_delete_keeps_the_closed_rows_payload(spark):
    rows = [(1, "2024-01-01 00:00:00", 1, "I", 5.0), (1, "2024-01-02 00:00:00", 2, "D", None),
            (2, "2024-01-01 00:00:00", 3, "D", 7.0)]
    ch = (spark.createDataFrame(rows, "k int, t string, seq int, op string, price double")
          .withColumn("t", F.to_timestamp_ntz("t")))
    for limit in (1, 100):
        h = {r.change_seq: r.price for r in H.build_history(ch, "k", "t", "seq", "op", ["price"], limit).collect()}
        assert h == {1: 5.0, 2: 5.0, 3: 7.0}


def test_quantiles_narrow_and_widen_their_brackets(spark, monkeypatch):
    from martlake.operators import stats as ST
    rng = random.Random(5)
    vals = [rng.gauss(0, 1) for _ in range(4000)] + [0.5] * 1000
    df = spark.createDataFrame([(v,) for v in vals] + [(None,), (float("nan"),)], "x double").repartition(4)
    monkeypatch.setattr(ST, "ACCURACY", 20)
    monkeypatch.setattr(ST, "MAX_BRACKET", 50)
    probs = [0.0, 0.01, 0.5, 0.77, 1.0]
    row = exact_quantiles(df, "x", probs).first()
    assert [row[i] for i in range(5)] == pytest.approx([_linear_quantile(vals, p) for p in probs], abs=1e-12)


def test_rates_document_without_rates_key(spark):
    docs = spark.createDataFrame([('{"base": "EUR"}',), ('{"rates": {"USD": 1.1}}',)], "value string")
    assert [(r.currency, r.rate) for r in CUR.rates_from_documents(docs).collect()] == [("USD", 1.1)]


# ---- quality ------------------------------------------------------------------

def test_strict_level_raises_basic_does_not(spark):
    df = spark.createDataFrame([("ab", -1.0, None), ("widget", 10001.0, "X")],
                               "product_name string, price double, category string")
    with pytest.raises(ValueError):
        Q.enforce(Q.validate(df, "strict", ["Y"]), "strict")
    msgs = Q.enforce(Q.validate(df, "basic"), "basic")
    assert len(msgs) == 2


def test_boundaries_of_strict_price(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 10000.0, 10000.01, None)], "price double")
    rep = {r.rule: r.failures for r in Q.rule_report(df, Q.strict_rules([], "price", "price", "price")[:1]).collect()}
    assert rep["suspicious_price"] == 2


def test_split_valid_null_is_invalid(spark):
    df = spark.createDataFrame([(1, 100), (2, None), (None, 5), (-1, 3)], "id int, value int")
    ok, bad = Q.split_valid(df, Q.record_is_valid())
    assert ok.count() == 1 and bad.count() == 3


def test_observation_counts_without_extra_job(spark):
    df = spark.range(10)
    o_df, obs = Q.observed(df, "c")
    o_df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 10


# ---- history ------------------------------------------------------------------

def _changes(spark):
    rows = [(1, "2024-01-01 00:00:00", 1, "I", 10.0), (1, "2024-01-02 00:00:00", 2, "U", 11.0),
            (1, "2024-01-02 00:00:00", 3, "U", 12.0), (1, "2024-01-03 00:00:00", 4, "D", 12.0),
            (1, "2024-01-04 00:00:00", 5, "I", 20.0), (2, "2024-01-01 12:00:00", 6, "I", 5.0)]
    return (spark.createDataFrame(rows, "k int, t string, seq int, op string, price double")
            .withColumn("t", F.to_timestamp_ntz("t")))


def test_history_versions_ties_and_delete(spark):
    h = H.build_history(_changes(spark), "k", "t", "seq", "op", ["price"], max_bucket_rows=2)
    rows = {r.change_seq: r for r in h.collect()}
    assert [rows[s].version for s in (1, 2, 3, 4, 5)] == [1, 2, 3, 3, 1]
    assert rows[2].valid_from == rows[2].valid_to          # same-time update: zero length
    assert rows[4].valid_from == rows[4].valid_to          # delete: zero length
    assert rows[3].valid_to == rows[4].valid_from
    assert rows[5].valid_to is None


def test_state_at_boundaries(spark):
    h = H.build_history(_changes(spark), "k", "t", "seq", "op", ["price"])
    at = lambda ts: {r.k: r.price for r in H.state_at(h, "k", F.expr(f"TIMESTAMP_NTZ '{ts}'")).collect()}
    assert at("2024-01-02 00:00:00") == {1: 12.0, 2: 5.0}    # exactly at valid_from
    assert at("2024-01-03 00:00:00") == {2: 5.0}             # exactly at the delete
    assert at("2024-01-04 00:00:00")[1] == 20.0


def test_asof_lookup_equals_point_reads(spark):
    h = H.build_history(_changes(spark), "k", "t", "seq", "op", ["price"], max_bucket_rows=2)
    probes = (spark.createDataFrame([(1, "2024-01-01 06:00:00"), (1, "2024-01-03 00:00:00"),
                                     (1, "2024-01-05 00:00:00"), (2, "2023-12-31 00:00:00")],
                                    "k int, p string").withColumn("p", F.to_timestamp_ntz("p")))
    got = {(r.k, str(r.p)): r.price for r in H.asof_lookup(h, probes, "k", "p", ["price"]).collect()}
    assert got[(1, "2024-01-01 06:00:00")] == 10.0
    assert got[(1, "2024-01-03 00:00:00")] is None
    assert got[(1, "2024-01-05 00:00:00")] == 20.0
    assert got[(2, "2023-12-31 00:00:00")] is None


def test_ordered_scan_equals_single_window_on_hot_key(spark):
    rng = random.Random(3)
    rows = [(0 if i % 3 else rng.randint(1, 20), i, rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t long, v int")
    w = Window.partitionBy("k").orderBy("t")
    ref = {r.t: (r.s, r.m, r.n) for r in df.select(
        "t", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
        F.lead("t").over(w).alias("n")).collect()}
    got = ordered_scan(df, "k", ["t"], F.floor(F.col("t") / 97), sums={"s": F.col("v")},
                       maxes={"m": F.col("v")}, leads={"n": F.col("t")})
    assert {r.t: (r.s, r.m, r.n) for r in got.collect()} == ref


def test_apply_changes_latest_wins(spark):
    cur = spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 1)], "k int, v double, ts int")
    upd = spark.createDataFrame([(1, 9.0, 2), (3, 3.0, 5)], "k int, v double, ts int")
    out = {r.k: r.v for r in H.apply_changes(cur, upd, "k", "ts").collect()}
    assert out == {1: 9.0, 2: 2.0, 3: 3.0}


# ---- text -----------------------------------------------------------------------

def _words(spark, text, tok):
    df = spark.createDataFrame([(text,)], "text string")
    return {r.word: r["count"] for r in TX.word_counts(df, "text", tok).collect()}


def test_four_tokenisations_disagree(spark):
    s = "It's a kůň, it's   a KŮŇ!"
    assert _words(spark, s, "ws") == {"it's": 2, "a": 2, "kůň,": 1, "kůň!": 1}
    assert _words(spark, s, "case")["It's"] == 1
    assert _words(spark, s, "stripped") == {"its": 2, "a": 2, "kůň": 2}
    assert _words(spark, s, "nonword") == {"it": 2, "s": 2, "a": 2, "kůň": 2}
    assert _words(spark, "", "ws") == {} and _words(spark, "   ", "nonword") == {}


def test_ngrams_stay_inside_text(spark):
    df = spark.createDataFrame([("the cat sat",), ("dog",)], "text string")
    got = {r.ngram: r["count"] for r in TX.ngram_counts(df, "text", 2, True).collect()}
    assert got == {"cat sat": 1}


def _plain_ngrams(texts, n, stop):
    """Counts of n-grams by a plain loop over words of letters a to z."""
    out = {}
    for t in texts:
        w = [x for x in re.findall("[a-z]+", (t or "").lower()) if x not in stop]
        for i in range(len(w) - n + 1):
            g = " ".join(w[i:i + n])
            out[g] = out.get(g, 0) + 1
    return out


def test_ngrams_equal_a_plain_loop(spark):
    texts = [None, "", "The of", "cat", "a cat sat", "cat sat on the mat, cat sat on it", "Cat SAT on the mat!"] \
        + ["cat sat mat " * 50] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for n, drop, size in ((1, True, 200), (2, False, 200), (3, True, 200), (3, True, TX.PIECE_BYTES)):
        want = _plain_ngrams(texts, n, TX.STOP_WORDS if drop else ())
        got = TX.ngram_counts(df, "text", n, drop, piece_bytes=size).collect()
        assert {r.ngram: r["count"] for r in got} == want and len(got) == len(want), (n, drop, size)
    assert TX.ngram_counts(df.limit(0), "text", 3).collect() == []


def test_ngrams_are_counted_in_pieces_without_lambdas(spark):
    """However few file splits there are, a task counts a bounded piece of
    text, and what runs for each n-gram is generated code."""
    df = spark.createDataFrame([("cat sat mat " * 100,)] * 64, "text string").coalesce(1)
    assert TX.in_pieces(df, "text", 4800).rdd.getNumPartitions() == 16
    assert TX.in_pieces(df, "text").rdd.getNumPartitions() == 1 and TX.in_pieces(df, "text").count() == 64
    assert TX.in_pieces(df.limit(0), "text").count() == 0
    rows = TX.ngrams(TX.in_pieces(df, "text", 4800), F.split("text", " "), 3)
    sizes = [len(p) for p in rows.rdd.glom().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * sum(sizes) / 16, sizes
    plan = TX.ngram_counts(df, "text", 3, piece_bytes=4800)._jdf.queryExecution().executedPlan().toString()
    generate = [x for x in plan.splitlines() if "Generate " in x]
    assert len(generate) == 1 and "lambda" not in generate[0] and "RoundRobinPartitioning" in plan, plan


# ---- streaming ------------------------------------------------------------------

def test_late_event_beyond_watermark_is_dropped(spark, tmp_path):
    from martlake.streaming import events as ST
    src = tmp_path / "events"
    src.mkdir()
    schema = ST.EVENTS_SCHEMA
    first = [(1, "2024-01-01 10:05:00", 1, "view", 1.0, "{}"), (2, "2024-01-01 12:30:00", 1, "view", 1.0, "{}")]
    late = [(3, "2024-01-01 10:10:00", 1, "view", 5.0, "{}")]   # 2h late after the watermark moved
    mk = lambda rows: spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string") \
        .withColumn("ts", F.to_timestamp_ntz("ts")).select(*[c.split()[0] for c in schema.split(", ")])
    mk(first).coalesce(1).write.parquet(str(src / "a"))   # one file is one micro-batch
    stream = ST.event_stream(spark, str(src / "*"), max_files_per_trigger=1)
    agg = ST.tumbling_counts(stream)
    from martlake.session import scratch_path
    out, ck = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    q = agg.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck) \
        .outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    mk(late).coalesce(1).write.parquet(str(src / "b"))
    q = agg.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck) \
        .outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    res = {str(r.window_start): r.n_events for r in spark.read.parquet(out).collect()}
    assert res.get("2024-01-01 10:00:00") == 1          # the late row was not counted


def _event_rows(spark, rows):
    """(event_id, ts or None, value) as events."""
    return spark.createDataFrame([(i, t, 1, "view", v, "{}") for i, t, v in rows],
                                 "event_id long, ts string, user_id long, event_type string, value double, props string") \
        .withColumn("ts", F.to_timestamp_ntz("ts"))


def test_files_that_arrive_one_after_the_other(spark, tmp_path):
    """Each arrival is one micro-batch; rows without a time pass through."""
    from martlake.streaming import events as ST
    rows = [(i, None if i % 10 == 0 else f"2024-01-01 0{i // 100}:{i % 60:02d}:00", 1.0) for i in range(400)]
    df = _event_rows(spark, rows).repartition(3)

    def part(i):
        return lambda: df.where((F.col("event_id") / 100).cast("int") == i).write.parquet(str(tmp_path / f"part-{i}"))
    part(0)()
    out = ST.run_to_parquet(ST.event_stream(spark, str(tmp_path / "*")), "arrivals-test", arrivals=[part(i) for i in (1, 2, 3)])
    got = spark.read.schema(ST.EVENTS_SCHEMA).parquet(out)
    assert (got.count(), got.where("ts IS NULL").count()) == (400, 40)
    closed = ST.closed_stream(spark, str(tmp_path / "*"))
    counts = spark.read.parquet(ST.run_to_parquet(ST.tumbling_counts(closed, "1 minute"), "closed-test"))
    assert counts.agg(F.sum("n_events")).first()[0] == 360
    none = str(tmp_path / "none")
    df.limit(0).write.parquet(none)
    empty = ST.run_to_parquet(ST.tumbling_counts(ST.closed_stream(spark, none)), "empty-test")
    assert spark.read.schema("window_start timestamp_ntz").parquet(empty).count() == 0


def test_late_rows_are_kept_beside_the_windows(spark, tmp_path):
    from martlake.streaming import events as ST
    first = [(1, "2024-01-01 10:05:00", 1.0), (2, "2024-01-01 12:09:00", 1.0)]
    second = [(3, "2024-01-01 10:10:00", 5.0), (4, "2024-01-01 11:59:00", 5.0), (5, "2024-01-01 13:30:00", 5.0), (6, None, 1.0)]
    third = [(7, "2024-01-01 12:01:00", 7.0), (8, "2024-01-01 13:31:00", 7.0)]
    arrive = [lambda r=r, n=n: _event_rows(spark, r).repartition(2).write.parquet(str(tmp_path / n))
              for n, r in (("b", second), ("c", third))]
    _event_rows(spark, first).write.parquet(str(tmp_path / "a"))
    windows, late = ST.windows_with_late_rows(spark, str(tmp_path / "*"), arrivals=arrive)
    assert {(r.window_start.hour, r.n_events, r.total_value) for r in windows.collect()} == {
        (10, 1, 1.0), (11, 1, 5.0), (12, 1, 1.0), (13, 2, 12.0)}
    assert sorted(r.event_id for r in late.collect()) == [3, 6, 7]


def test_events_delivered_again_count_once(spark, tmp_path):
    from martlake.streaming import events as ST
    df = _event_rows(spark, [(i, f"2024-01-01 10:{i:02d}:00", 1.0) for i in range(40)])
    again = lambda n: (lambda: df.repartition(2).write.parquet(str(tmp_path / n)))
    again("a")()
    stream = ST.distinct_events(ST.event_stream(spark, str(tmp_path / "*")))
    out = ST.run_to_parquet(stream, "distinct-test", arrivals=[again("b"), again("c")])
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == list(range(40))


def test_small_and_large_rates_keep_their_digits(spark):
    from martlake.operators import currency as CUR
    df = spark.createDataFrame([(1e7,), (0.5,), (None,)], "price double")
    rates = CUR.rates_frame(spark, {"A": 0.0000392123, "B": 0.000000001234, "C": 1e6})
    got = CUR.enrich_with_currency(df, rates, "price", ["A", "B", "C"]).collect()
    assert [tuple(r)[2:] for r in got] == [(392.12, 0.01, 1e13), (0.0, 0.0, 500000.0), (None, None, None)]


# ---- sources / sinks -----------------------------------------------------------

def test_extract_csv_missing_and_malformed(spark, tmp_path):
    from martlake.sources import files as FS
    assert FS.extract_csv(spark, str(tmp_path), "nope.csv") is None
    p = tmp_path / "p.csv"
    p.write_text("id,price\n1,2.5\n2,abc\n")
    df = FS.extract_csv(spark, str(tmp_path), "p.csv", "id int, price double")
    rows = sorted(df.collect(), key=lambda r: r.id)
    assert rows[0].price == 2.5 and rows[1].price is None and rows[1]._corrupt_record


def test_jdbc_types_and_options_without_a_database():
    """The type rule and the reader's options; no database is
    opened here."""
    from pyspark.sql import types as PT
    from martlake.sources import jdbc as J
    assert J.sql_type(PT.LongType()) == "BIGINT" and J.sql_type(PT.IntegerType()) == "INTEGER"
    assert J.sql_type(PT.DoubleType()) == "FLOAT" and J.sql_type(PT.StringType()) is None
    schema = PT.StructType.fromDDL("id bigint, n int, price double, name string, at timestamp")
    assert J.column_types(schema) == "id BIGINT, n INTEGER, price FLOAT"
    opts = J.read_options("jdbc:x:y", query="SELECT id FROM t", partition_column="id", lower_bound=0,
                          upper_bound=9, num_partitions=3)
    assert opts == {"url": "jdbc:x:y", "dbtable": "(SELECT id FROM t) q", "partitionColumn": "id",
                    "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    assert J.read_options("u", "t", properties={"user": "a"}) == {"url": "u", "user": "a", "dbtable": "t"}
    with pytest.raises(ValueError):
        J.load_data(None, "u", "t", "sometimes")


def test_versions_of_a_table(spark, tmp_path):
    p = str(tmp_path / "vt")
    H.write_version(spark.createDataFrame([(1, "a")], "id int, v string"), p, 1)
    for _ in range(2):  # a rerun rewrites its version
        H.write_version(spark.createDataFrame([(2, "b")], "id int, v string"), p, 2)
    H.write_version(spark.createDataFrame([(3, "c", 0.1)], "id int, v string, d double"), p, 3)
    t = spark.read.option("mergeSchema", True).parquet(p)
    assert sorted(r.id for r in H.as_of_version(t, 2).collect()) == [1, 2]
    assert t.columns == ["id", "v", "d", "version"] and t.count() == 3
    assert [(r.version, r.rows) for r in H.version_counts(t).collect()] == [(1, 1), (2, 1), (3, 1)]


def test_dead_letter_append_and_load_verification(spark, tmp_path):
    from martlake.sources import sinks as K
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, price double")
    rules = [("negative_price", F.col("price") < 0), ("missing_price", F.col("price").isNull())]
    err = str(tmp_path / "errors")
    ok = Q.route_dead_letter(df, rules, err)
    Q.route_dead_letter(df, rules, err)                      # a rerun of the same batch
    Q.route_dead_letter(df, rules, err, batch="1")
    assert [r.id for r in ok.collect()] == [1]
    bad = spark.read.parquet(err)
    assert bad.count() == 4
    assert {r.failed_rules for r in bad.collect()} == {"negative_price", "missing_price"}
    K.save_table(ok, "verify_ok", path=str(tmp_path / "t"))
    assert K.verify_load(spark, "verify_ok", 1)


def test_csv_table_insert_values_and_inferred_read(spark, tmp_path):
    from martlake.sources import files as FS
    from martlake.sources import sinks as K
    loc = str(tmp_path / "csvtab")
    K.create_database(spark, "martlake_test_db")
    K.create_external_csv_table(spark, "martlake_test_db.sales_csv", "id INT, product STRING, price DOUBLE", loc)
    K.insert_values(spark, "martlake_test_db.sales_csv", [(1, "Notebook", 25000.0), (2, "Mobil", 12000.5)])
    got = sorted((r.id, r.product, r.price) for r in spark.table("martlake_test_db.sales_csv").collect())
    assert got == [(1, "Notebook", 25000.0), (2, "Mobil", 12000.5)]
    inferred = FS.read_csv_inferred(spark, loc)
    assert dict(inferred.dtypes)["price"] == "double"


def test_booleans_to_double_and_plain_limit(spark):
    from martlake.operators.sales import first_rows
    df = spark.createDataFrame([(True, 1), (False, 2), (None, 3)], "is_expensive boolean, n int")
    out = X.booleans_to_double(df)
    assert [r.is_expensive for r in out.orderBy("n").collect()] == [1.0, 0.0, None]
    assert first_rows(df, 2).count() == 2


def test_history_hot_key_split_equals_plain_windows(spark):
    """One key holds about a third of the rows; with small buckets its
    history must equal the single-window computation."""
    from martlake.operators.sequence import hot_key_buckets
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        k = 0 if i % 3 == 0 else rng.randint(1, 40)
        op = rng.choice(["I", "U", "U", "U", "D"])
        rows.append((k, 1_700_000_000 + rng.randint(0, 500_000), i, op, float(i)))
    ch = (spark.createDataFrame(rows, "k int, t long, seq int, op string, v double")
          .withColumn("t", F.col("t").cast("timestamp").cast("timestamp_ntz")))
    bk = hot_key_buckets(ch, "k", "t", 50)
    assert bk.where("k = 0").select("_bk").distinct().count() > 5
    h = H.build_history(ch, "k", "t", "seq", "op", ["v"], max_bucket_rows=50)
    w = Window.partitionBy("k").orderBy("t", "seq")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    ref = (ch.withColumn("live", F.sum(F.when(F.col("op") != "D", 1).otherwise(0)).over(run))
           .withColumn("nxt", F.lead("t").over(w))
           .withColumn("base", F.max(F.when(F.col("op") == "I", F.col("live") - 1).otherwise(0)).over(run))
           .select("seq", (F.col("live") - F.col("base")).cast("int").alias("version"),
                   F.when(F.col("op") == "D", F.col("t")).otherwise(F.col("nxt")).alias("valid_to")))
    got = {r.change_seq: (r.version, r.valid_to) for r in h.collect()}
    assert got == {r.seq: (r.version, r.valid_to) for r in ref.collect()}


def test_required_columns_check_runs_no_job(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, price double")
    assert Q.required_columns_missing(df, ["id", "price"]) == []
    assert Q.required_columns_missing(df, ["id", "category", "price"]) == ["category"]


def test_hot_key_burst_is_split_again(spark):
    """Most of a hot key's rows fall into one short burst; the second level
    cuts that burst into buckets of about max_rows rows."""
    from martlake.operators.sequence import hot_key_buckets
    rows = [(0, 1_700_000_000 + i * 1000) for i in range(20)]             # sparse tail
    rows += [(0, 1_800_000_000 + i) for i in range(600)]                  # burst
    rows += [(1, 1_700_000_000 + i) for i in range(10)]                   # ordinary key
    df = (spark.createDataFrame(rows, "k int, t long")
          .withColumn("t", F.col("t").cast("timestamp").cast("timestamp_ntz")))
    one = hot_key_buckets(df, "k", "t", 50, levels=1)
    two = hot_key_buckets(df, "k", "t", 50)
    biggest = lambda d: max(r["count"] for r in d.groupBy("k", "_bk").count().collect())
    assert biggest(one) > 500 and biggest(two) <= 120
    assert hot_key_buckets(df, "k", "t", 10_000).schema["_bk"].dataType.typeName() == "long"


def test_ordered_scan_keeps_null_keys(spark):
    """Rows whose key is NULL form one group, as in a plain window."""
    rows = [(None if i % 4 == 0 else i % 3, i, i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t long, v int")
    w = Window.partitionBy("k").orderBy("t")
    ref = {r.t: (r.s, r.n) for r in df.select(
        "t", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.lead("t").over(w).alias("n")).collect()}
    got = ordered_scan(df, "k", ["t"], F.floor(F.col("t") / 17), sums={"s": F.col("v")},
                       leads={"n": F.col("t")})
    assert {r.t: (r.s, r.n) for r in got.collect()} == ref
    ch = (spark.createDataFrame([(None, "2024-01-01 00:00:00", 1, "I", 1.0),
                                 (None, "2024-01-02 00:00:00", 2, "U", 2.0)],
                                "k int, t string, seq int, op string, v double")
          .withColumn("t", F.to_timestamp_ntz("t")))
    h = H.build_history(ch, "k", "t", "seq", "op", ["v"], max_bucket_rows=1)
    assert sorted(r.version for r in h.collect()) == [1, 2]
