"""Heavy groups: the plan's largest task, and the same rows whichever way is taken."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from delaycast.operators import joins as J


@pytest.fixture
def plain_shuffles(spark):
    """No broadcast, no run-time splitting or merging of partitions: what the plan itself does."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _largest_task(df):
    """Rows of the largest last task (all columns asked for, so that no step is pruned away)."""
    at = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns)))
    return max(r.n for r in at.collect())


def _positions(spark, n=4000):
    """Four fifths of the rows in bucket 7, some with a null bucket, the rest spread."""
    b = F.when(F.col("id") % 10 < 8, 7).when(F.col("id") % 10 == 8, None).otherwise((F.col("id") % 50).cast("int"))
    return spark.range(n).select(F.col("id"), b.cast("int").alias("b"), F.lit(1).alias("_bk"), F.lit(2).alias("_place"))


def test_heavy_bucket_is_spread_and_rows_stay(plain_shuffles):
    spark = plain_shuffles
    left = _positions(spark)
    right = spark.createDataFrame([(7, 1, 5.0), (7, 2, 6.0), (9, 1, 9.0), (19, 1, 1.0), (None, 1, 3.0)],
                                  "b int, o int, v double")
    small = J.bucket_enrich(left, right, "b", "b", ["v"], "r_", order=["o"])
    big = J.bucket_enrich(left, right, "b", "b", ["v"], "r_", order=["o"], max_broadcast_bytes=0,
                          max_rows_per_bucket=200)
    assert big.columns == small.columns == ["id", "b", "_bk", "_place", "r_v"]
    key = lambda r: r.id
    rows = sorted(big.collect(), key=key)
    assert rows == sorted(small.collect(), key=key) and len(rows) == 4000
    assert {r.r_v for r in rows if r.b == 7} == {6.0} and {r.r_v for r in rows if r.b is None} == {None}
    unsplit = J.bucket_enrich(left, right, "b", "b", ["v"], "r_", order=["o"], max_broadcast_bytes=0)
    assert _largest_task(unsplit) >= 3200                       # the bucket in one task
    assert _largest_task(big) < 1000                            # 16 places of some 200 rows, a few may meet
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "SortMergeJoin" in plan


def test_heavy_bucket_with_several_feeds(plain_shuffles):
    spark = plain_shuffles
    left = _positions(spark)
    right = spark.createDataFrame([(7, "o", 1, 5.0), (7, "f", 2, 6.0), (9, "o", 1, 9.0)],
                                  "b int, kind string, o int, v double")
    for mode in ("latest", "mean"):
        feeds = {"o_": (F.col("kind") == "o", ["v"], ["o"]), "f_": (F.col("kind") == "f", ["v"], ["o"])}
        small = J.bucket_enrich_multi(left, right, "b", "b", feeds, mode=mode)
        big = J.bucket_enrich_multi(left, right, "b", "b", feeds, mode=mode, max_broadcast_bytes=0,
                                    max_rows_per_bucket=100)
        assert sorted(big.collect(), key=lambda r: r.id) == sorted(small.collect(), key=lambda r: r.id)
        assert _largest_task(big) < 1000


def test_empty_sides(spark):
    left = spark.createDataFrame([], "id int, b int")
    right = spark.createDataFrame([], "b int, o int, v double")
    assert J.bucket_enrich(left, right, "b", "b", ["v"], "r_", order=["o"], max_broadcast_bytes=0).count() == 0
    some = spark.createDataFrame([(1, 2), (2, None)], "id int, b int")
    got = J.bucket_enrich(some, right, "b", "b", ["v"], "r_", order=["o"], max_broadcast_bytes=0, max_rows_per_bucket=1)
    assert sorted((r.id, r.r_v) for r in got.collect()) == [(1, None), (2, None)]


def test_count_at_most(spark):
    df = spark.createDataFrame([([], 3), ([3], 3), ([1, 3, 5, 7, 9], 0), ([1, 3, 5, 7, 9], 6), ([1, 3], 9)], "a array<int>, x int")
    got = [r.n for r in df.select(J.count_at_most(F.col("a"), F.col("x"), 1000).alias("n")).collect()]
    assert got == [0, 1, 0, 3, 2]


def _burst(seed, one_time):
    """One key of 2,000 left rows, four fifths of them in one second (or at one time), and 300 right rows, most of them there too."""
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1, 12)

    def when(hot):
        if rnd.random() < hot:
            return base + dt.timedelta(microseconds=0 if one_time else rnd.randint(0, 999_999))
        return base + dt.timedelta(seconds=rnd.randint(-90_000, 90_000))
    left = [(i, 1, when(0.8)) for i in range(2000)] + [(9000, 2, base), (9001, 1, None), (9002, None, base)]
    right = [(1, when(0.5), 10_000 + j) for j in range(300)]
    return left, right


@pytest.mark.parametrize("one_time", [False, True])
def test_asof_burst_is_cut_by_depth(plain_shuffles, one_time):
    spark, limit = plain_shuffles, 100
    left, right = _burst(3, one_time)
    L = spark.createDataFrame(left, "lid int, k int, t timestamp")
    R = spark.createDataFrame(right, "k int, rt timestamp, rid int")
    out = J.asof_next(L, R, ["k"], "t", "rt", ["rid"], ["rid"], max_rows_per_bucket=limit)
    want = {}
    for lid, k, t in left:
        later = [(rt, rid) for rk, rt, rid in right if rk == k and t is not None and rt >= t]
        want[lid] = min(later)[1] if later else None
    rows = out.collect()
    assert len(rows) == len(left) and {r.lid: r.next_rid for r in rows} == want
    whole = J.asof_next(L, R, ["k"], "t", "rt", ["rid"], ["rid"])
    assert {r.lid: r.next_rid for r in whole.collect()} == want
    assert _largest_task(whole) >= 1600                             # a day of the key in one window
    assert _largest_task(out) <= 4 * limit                          # a task holds a few pieces, none above the limit


def test_depth_cuts_leave_no_piece_above_the_limit(spark):
    left, _ = _burst(5, False)
    rows = spark.createDataFrame([(k, i if i % 3 else 77) for i, k, t in left if k == 1], "k int, v bigint")
    cuts = J.depth_cuts(rows, ["k"], "v", 90).first()
    assert cuts["_cuts"] == sorted(set(cuts["_cuts"])) and list(cuts["_many"]) == [77]
    vals = [r.v for r in rows.collect() if r.v != 77]
    edges = [float("-inf"), *cuts["_cuts"], float("inf")]
    assert max(sum(a <= v < b for v in vals) for a, b in zip(edges, edges[1:])) <= 90
    assert J.depth_cuts(rows, ["k"], "v", 5000).count() == 0        # nothing heavy: nothing cut
