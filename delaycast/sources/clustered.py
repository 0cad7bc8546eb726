"""Keyed table in key order (S8, P14): a key range reads the files that can hold it, whatever the bounds look like."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import row_hash
from .readers import keyed_scan

ZONES = "_zones"            # inside the table's folder; Spark's readers pass over names that begin with "_"
MOST_FILES = 10_000         # a range of more files is read as the folder with a filter: the same rows, more footers opened


def write_clustered(df: DataFrame, path: str, key_col: str, files: int | None = None, mode: str = "errorifexists") -> None:
    """Write ``df`` in some ``files`` files (default: the shuffle partitions) of consecutive key ranges, each sorted by key.

    Equal keys may fill several files (a hash of the row cuts them further), so a key that holds a third
    of all rows is not one task; rows that equal each other in every column stay in one file. Null keys are stored with the first
    keys and found by no range. The first and last key of every file are written last, to ``ZONES``: if a job dies
    before that, ranges are read as the folder with a filter.
    """
    spark = df.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(files, F.col(key_col), row_hash(df)).sortWithinPartitions(key_col)
    rows.write.mode(mode).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(key_col).alias("first"), F.max(key_col).alias("last"), F.count(F.lit(1)).alias("rows")
    ).coalesce(1).write.parquet(f"{path}/{ZONES}")              # one row a file


def scan_clustered(spark: SparkSession, path: str, key_col: str, start: str | None = None, stop: str | None = None,
                   most_files: int = MOST_FILES) -> DataFrame:
    """Rows with ``start <= key < stop`` (None: no bound); only files whose keys reach into the range are opened.

    The driver learns the names of at most ``most_files`` files. A table without ``ZONES``, or a range of more files, is
    read as the folder with the same filter.
    """
    whole = spark.read.parquet(path)
    if start is None and stop is None:
        return whole
    try:
        zones = spark.read.parquet(f"{path}/{ZONES}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return keyed_scan(whole, key_col, start, stop)
    if start is not None:
        zones = zones.where(F.col("last") >= F.lit(start))
    if stop is not None:
        zones = zones.where(F.col("first") < F.lit(stop))
    names = [r.file for r in zones.select("file").limit(most_files + 1).collect()]
    if not names:
        return whole.where(F.lit(False))
    some = whole if len(names) > most_files else spark.read.schema(whole.schema).parquet(*[f"{path}/{n}" for n in names])
    return keyed_scan(some, key_col, start, stop)
