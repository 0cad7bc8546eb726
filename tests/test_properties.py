"""Property tests: bucket alignment/idempotence, histogram
totals, dedup never grows, one row per key, as-of never looks back."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delaycast.functions import timeops as T
from delaycast.operators import dedup as D
from delaycast.operators import joins as J
from delaycast.operators import stats as A

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
EPOCH = dt.datetime(1970, 1, 1)
micros = st.integers(min_value=1_600_000_000_000_000, max_value=1_800_000_000_000_000)


@SETTINGS
@given(st.lists(micros, min_size=1, max_size=40), st.sampled_from([60, 600, 3600]),
       st.sampled_from(["half_up", "half_even", "floor"]))
def test_bucket_alignment_and_idempotence(spark, values, width, mode):
    df = spark.createDataFrame([(v,) for v in values], "us long").select(F.timestamp_micros("us").alias("t"))
    b = df.select(T.epoch_micros("t").alias("us"), T.epoch_micros(T.time_bucket("t", width, mode)).alias("b"))
    b2 = df.select(T.time_bucket(T.time_bucket("t", width, mode), width, mode).alias("x"),
                   T.time_bucket("t", width, mode).alias("y"))
    w = width * 1_000_000
    for r in b.collect():
        assert r.b % w == 0
        if mode == "floor":
            assert 0 <= r.us - r.b < w
        else:
            assert abs(r.us - r.b) <= w // 2
    assert all(r.x == r.y for r in b2.collect())


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60),
       st.integers(1, 30))
def test_histogram_counts_sum_to_rows(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    h = A.histogram(df, "x", bins).collect()
    n = sum(1 for v in values if v is not None)
    assert len(h) == bins
    assert sum(r.cnt for r in h) == n


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 2)), min_size=1, max_size=50))
def test_dedup_never_grows_and_one_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v int")
    assert D.dedup_rows(df).count() <= len(rows)
    first = D.first_by_key(df, ["k"], ["t", "v"]).collect()
    assert len(first) == len({r[0] for r in rows})
    for r in first:
        assert (r.t, r.v) == min((t, v) for k, t, v in rows if k == r.k)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 100_000)), min_size=1, max_size=30),
       st.lists(st.tuples(st.integers(0, 2), st.integers(0, 100_000)), min_size=0, max_size=30),
       st.sampled_from([600, 3600, 86_400]), st.sampled_from([2, 2_000_000]))
def test_asof_next_is_earliest_not_before(spark, left, right, bucket, per_bucket):
    base = dt.datetime(2024, 1, 1)
    L = spark.createDataFrame([(i, k, base + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(left)],
                              "i int, k int, t timestamp")
    R = spark.createDataFrame([(k, base + dt.timedelta(seconds=s), j) for j, (k, s) in enumerate(right)],
                              "k int, rt timestamp, j int")
    got = {r.i: r.next_j for r in J.asof_next(L, R, ["k"], "t", "rt", ["j"], ["j"], bucket_seconds=bucket,
                                                max_rows_per_bucket=per_bucket).collect()}
    assert len(got) == len(left)
    for i, (k, s) in enumerate(left):
        cands = [(rs, j) for j, (rk, rs) in enumerate(right) if rk == k and rs >= s]
        assert got[i] == (min(cands)[1] if cands else None)
