"""Every registered query against its DuckDB oracle (sf0.001), and plan
shape checks (no cartesian products, filters and projections pushed down)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from delaycast.plans.queries import ORACLES, QUERIES  # noqa: E402  (optional subpackages have their own tests)
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
STREAMING = {"stream_enrich", "stream_dedup", "stream_replay"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    q, o = QUERIES, ORACLES
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql())
    assert set(o) <= set(q)
    assert set(q) - set(o) <= {"model_score"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMING])
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF).toPandas()
    orc = ORACLES.get(name)
    if orc is None:
        assert len(sdf) > 0
        return
    odf = duck.execute(orc).df()
    sc, sr = rows_of(sdf)
    oc, orows = rows_of(odf)
    assert sc == oc
    assert len(sr) == len(orows)
    assert sr == orows


@pytest.mark.parametrize("name", ["lookback_hour", "lookback_day", "stream_dedup", "stream_enrich"])
def test_table_as_a_folder_of_part_files(spark, tmp_path, name):
    # one part with rows, one without: the name of the file is no longer that of the table
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    ev.where("event_id < 0").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    one, parts = (QUERIES[name](spark, d).toPandas() for d in (SF, str(tmp_path)))
    assert len(one) > 0 and rows_of(one) == rows_of(parts)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_delay" in df.columns


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMING | {"model_score"}])
def test_no_cartesian_products(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_route_filter_and_projection_pushed_to_scan(spark):
    plan = E.queries()["route_track"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_key_range_pushes_implied_time_range(spark):
    plan = E.queries()["key_range_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThanOrEqual(ts," in plan


_TYPES = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
          "TimestampNTZType()": "TIMESTAMP", "BooleanType()": "BOOLEAN", "DateType()": "DATE"}


@pytest.mark.parametrize("name", [n for n in ORACLES if n not in STREAMING])
def test_output_types_match_oracle(spark, duck, name):
    spark_types = {f.name: _TYPES.get(repr(f.dataType), repr(f.dataType))
                   for f in QUERIES[name](spark, SF).schema.fields}
    rel = duck.sql(ORACLES[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}


def test_asof_partitions_by_key_and_time_bucket(spark):
    plan = E.queries()["next_stop_lookup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_k0" in plan and "_b" in plan.split("hashpartitioning(_k0", 1)[1][:40]


def test_flagship_streams_the_large_side_through_one_broadcast_join(spark):
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
    assert plan.count("FileScan") == 2                     # clicks + one pass over the weather-like feeds
