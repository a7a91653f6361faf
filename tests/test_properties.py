"""Property tests: distributed statistics equal brute force on random data."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlake.operators import cleaning as C
from martlake.operators.stats import exact_quantiles, mode_value

SETTINGS = dict(max_examples=15, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda i: i / 4)),
                  min_size=0, max_size=60)
probs = st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.33, 0.5, 0.75, 0.9, 1.0]),
                 min_size=1, max_size=4, unique=True)


def _brute(vals, p):
    xs = sorted(v for v in vals if v is not None)
    if not xs:
        return None
    pos = p * (len(xs) - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    if lo == hi:
        return xs[lo]
    return (hi - pos) * xs[lo] + (pos - lo) * xs[hi]


@settings(**SETTINGS)
@given(vals=values, ps=probs)
def test_quantiles_equal_brute_force(spark, vals, ps):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    row = exact_quantiles(df, "x", ps).collect()[0]
    for i, p in enumerate(ps):
        want = _brute(vals, p)
        assert (row[i] is None and want is None) or abs(row[i] - want) < 1e-12


@settings(**SETTINGS)
@given(vals=st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])), max_size=40))
def test_mode_equal_brute_force(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = mode_value(df, "c").collect()[0][0]
    counts = {}
    for v in vals:
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
    want = min(counts, key=lambda k: (-counts[k], k)) if counts else None
    assert got == want


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.integers(0, 1000), st.sampled_from(["x", "y", None]),
                               st.integers(0, 3)), max_size=40, unique_by=lambda r: r[0]))
def test_keep_first_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "id int, k string, v int")
    got = {(r.k, r.id, r.v) for r in C.keep_first(df, ["k"], "id").collect()}
    best = {}
    for i, k, v in rows:
        if k not in best or i < best[k][0]:
            best[k] = (i, v)
    assert got == {(k, i, v) for k, (i, v) in best.items()}
