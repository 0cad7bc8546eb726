"""The table in key order: rows of a range, files opened for it, edge cases."""
import os
import shutil

import pytest
from pyspark.sql import functions as F

from delaycast.sources import clustered as CL

SCHEMA = "row_key string, first int, file string, v double"


def _rows():
    rows = [(f"2024-01-{1 + i % 28:02d} 10:00:{i % 60:02d}_{i}", i, "x", float(i)) for i in range(800)]
    return rows + rows[:5] + [(None, -1, None, None), ("", -2, "y", 0.0)]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    CL.write_clustered(spark.createDataFrame(_rows(), SCHEMA), path, "row_key", files=20)
    return path


@pytest.mark.parametrize("start, stop", [("2024-01-1", "2024-01-2"), ("2024-01-05", "2024-01-06"), (None, "2024-01-03"),
                                         ("2024-01-28", None), ("2024-01-05 10:00:04_4", "2024-01-05 10:00:04_5"),
                                         ("3", None), ("2024-02", "2024-01"), ("", "1"), (None, None)])
def test_rows_of_a_range(spark, table, start, stop):
    want = [r for r in _rows() if (start is None and stop is None) or r[0] is not None
            and (start is None or r[0] >= start) and (stop is None or r[0] < stop)]
    for most in (CL.MOST_FILES, 1):                              # file list, and the folder with a filter
        out = CL.scan_clustered(spark, table, "row_key", start, stop, most_files=most)
        assert out.columns == ["row_key", "first", "file", "v"]
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_a_short_bound_opens_few_files(spark, table):
    total = len(spark.read.parquet(table).inputFiles())
    assert total == 20
    assert len(CL.scan_clustered(spark, table, "row_key", "2024-01-05", "2024-01-06").inputFiles()) <= 3
    assert len(CL.scan_clustered(spark, table, "row_key", "2024-01-1", "2024-01-2").inputFiles()) <= 9


def test_without_zones_the_filter_is_used(spark, table):
    want = CL.scan_clustered(spark, table, "row_key", "2024-01-05", "2024-01-07").count()
    moved = table + "_copy"
    shutil.copytree(table, moved, ignore=shutil.ignore_patterns(CL.ZONES))
    assert not os.path.exists(f"{moved}/{CL.ZONES}")
    assert CL.scan_clustered(spark, moved, "row_key", "2024-01-05", "2024-01-07").count() == want > 0


def test_empty_table_and_a_heavy_key(spark, tmp_path):
    empty = str(tmp_path / "e")
    CL.write_clustered(spark.createDataFrame([], SCHEMA), empty, "row_key", files=4)
    assert CL.scan_clustered(spark, empty, "row_key", "a", "b").count() == 0
    heavy = str(tmp_path / "h")
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, "k").otherwise(F.col("id").cast("string")).alias("row_key"),
                                    F.col("id").alias("n"))
    CL.write_clustered(rows, heavy, "row_key", files=12)
    at = spark.read.parquet(heavy).groupBy("_metadata.file_name").count()
    assert at.agg(F.max("count")).first()[0] < 400               # the key alone has 667 rows
    assert CL.scan_clustered(spark, heavy, "row_key", "k", "l").count() == 667
