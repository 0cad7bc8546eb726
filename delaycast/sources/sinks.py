"""Sinks (K1-K9): keyed upsert tables, column families, stream sinks.

The keyed store of the reference (one row per key, re-put overwrites) is a
Parquet table: rows are reduced to the latest per key before the write, and
micro-batches land in a folder named by batch id so a replayed batch
overwrites its own output instead of doubling it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, StructType, TimestampNTZType, TimestampType

from ..operators.dedup import latest_by_key


def keyed_upsert(df: DataFrame, key_col: str, order: list[str]) -> DataFrame:
    """K1/K2 rule: one row per key, the newest by ``order`` wins."""
    return latest_by_key(df, [key_col], order)


_ORDERED = (BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType)


def _total_order(df: DataFrame, key_col: str, order: list[str]) -> list[str]:
    """``order``, then every other comparable column: equal orders never depend on the order of rows."""
    rest = [f.name for f in df.schema.fields if isinstance(f.dataType, _ORDERED) and f.name not in (key_col, *order)]
    return [*order, *sorted(rest)]


def _stored(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet (any other fault is raised)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# ---------------------------------------------------------------- commits of a keyed table

def _side(path: str, name: str) -> str:
    """A file or folder that belongs to the table at ``path`` but is no part of it."""
    return f"{path.rstrip('/')}_commit/{name}"


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, and ``path`` as it takes it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _read_json(spark: SparkSession, path: str) -> dict | None:
    fs, at = _files(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    """The whole file or none of it: written under another name, then renamed."""
    fs, at = _files(spark, path)
    part = _files(spark, f"{path}.{uuid.uuid4().hex[:12]}.part")[1]
    stream = fs.create(part)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()
    fs.delete(at, False)
    if not fs.rename(part, at):
        raise OSError(f"{path} cannot be written")


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _files(spark, path)
    fs.delete(at, True)


def finish_commit(spark: SparkSession, path: str) -> bool:
    """Put the load that is committed but not yet in place into the table at ``path``; True if there was one.

    Doing so again changes nothing: the staged folder holds the touched partitions whole.
    """
    pending = _read_json(spark, _side(path, "pending.json"))
    if pending is None:
        return False
    w = spark.read.schema(StructType.fromJson(pending["schema"])).parquet(pending["staging"]).write.mode("overwrite")
    if pending["partition_by"]:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*pending["partition_by"])
    w.parquet(path)
    if pending["folded"] is not None:
        _write_json(spark, _side(path, "folded.json"), {"upto": pending["folded"]})
    _delete(spark, _side(path, "pending.json"))
    _delete(spark, _side(path, "staging"))
    return True


def touched_rows(old: DataFrame, new: DataFrame, partition_by: list[str], most: int = 10_000) -> DataFrame:
    """The rows of ``old`` in the partitions of ``new``. Up to ``most`` of them are named in the
    filter, which then prunes the folders that the scan lists; beyond that a join finds them."""
    values = new.select(*partition_by).distinct()
    named = values.limit(most + 1).collect()
    if len(named) <= most:
        for c in partition_by:
            of_c = sorted({r[c] for r in named if r[c] is not None})
            null = F.col(c).isNull() if any(r[c] is None for r in named) else F.lit(False)
            old = old.where((F.col(c).isin(of_c) | null) if of_c else null)
        if len(partition_by) == 1:
            return old
    same = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in partition_by]
    return old.join(values.select(*[F.col(c).alias(f"_t_{c}") for c in partition_by]), same, "left_semi")


def write_keyed(df: DataFrame, path: str, key_col: str, order: list[str],
                partition_by: list[str] | None = None, folded: int | None = None) -> None:
    """K1/K2: upsert by key. Stored rows of other keys stay; of one key the newest by
    ``order`` stays (ties by the other columns), whichever load brings it, so loads may
    overlap, come late or run again. Rows with a null key are not stored: split them off before.

    Only the partitions that the new rows touch are read and rewritten (a key has one
    partition value). Their new state is staged beside the table, in ``{path}_commit``; one
    small file, ``pending.json``, commits it, and ``finish_commit`` puts it in place. A load
    that dies before that file is there leaves the table as it was; one that dies after it
    is finished by the next ``write_keyed`` or ``read_keyed``. One load at a time.
    """
    spark = df.sparkSession
    finish_commit(spark, path)
    _delete(spark, _side(path, "staging"))  # of a load that died before it was committed
    keep = _total_order(df, key_col, order)
    new = keyed_upsert(df.where(F.col(key_col).isNotNull()), key_col, keep).select(*df.columns)
    new.write.parquet(_side(path, "staging/new"))
    new = spark.read.schema(df.schema).parquet(_side(path, "staging/new"))
    old = _stored(spark, path, df.schema)
    if old is not None:
        old = touched_rows(old, new, partition_by) if partition_by else old
        new = old.select(*df.columns).unionByName(new)
    keyed_upsert(new, key_col, keep).select(*df.columns).write.parquet(_side(path, "staging/all"))
    _write_json(spark, _side(path, "pending.json"), {"staging": _side(path, "staging/all"), "partition_by": partition_by,
                                                     "schema": json.loads(df.schema.json()), "folded": folded})
    finish_commit(spark, path)


def read_keyed(spark: SparkSession, path: str, key_col: str, order: list[str]) -> DataFrame:
    """Read a keyed table (S8 source) after finishing a committed load; batches written
    more than once are reduced to the latest row per key again."""
    finish_commit(spark, path)
    df = spark.read.parquet(path)
    return keyed_upsert(df, key_col, _total_order(df, key_col, order))


# ---------------------------------------------------------------- batch folders of a stream

def batches_after(spark: SparkSession, src: str, upto: int) -> list[int]:
    """The numbers of the batch folders (``batch_id=N``) under ``src`` that come after ``upto``, ascending."""
    fs, at = _files(spark, src)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
    ids = [int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id=")]
    return sorted(i for i in ids if i > upto and fs.exists(_files(spark, f"{src}/batch_id={i}/_SUCCESS")[1]))


def folded_upto(spark: SparkSession, dst: str) -> int:
    """The last batch that the table at ``dst`` holds, -1 if none."""
    ledger = _read_json(spark, _side(dst, "folded.json"))
    return -1 if ledger is None else ledger["upto"]


def fold_batches(spark: SparkSession, src: str, dst: str, key_col: str, order: list[str],
                 partition_by: list[str] | None = None, least: int = 1, delete: bool = False) -> int:
    """K3: fold the batch folders of a stream into the keyed table ``dst`` if there are at
    least ``least`` new ones; how many were folded.

    The ledger of folded batches is part of the same commit, so a batch is folded once,
    however often this runs or the stream repeats it. With ``delete`` the folders of
    folded batches go.
    """
    finish_commit(spark, dst)
    new = batches_after(spark, src, folded_upto(spark, dst))
    if new and len(new) >= least:
        df = spark.read.parquet(*[f"{src}/batch_id={i}" for i in new])
        write_keyed(df, dst, key_col, order, partition_by, folded=new[-1])
    done = folded_upto(spark, dst)
    for i in batches_after(spark, src, -1) if delete else []:
        if i <= done:
            _delete(spark, f"{src}/batch_id={i}")
    return len(new) if len(new) >= least else 0


def current_rows(spark: SparkSession, src: str, dst: str, key_col: str, order: list[str]) -> DataFrame | None:
    """One row per key of the table ``dst`` and the batch folders not yet folded; None if there are none of either."""
    finish_commit(spark, dst)
    parts = [f"{src}/batch_id={i}" for i in batches_after(spark, src, folded_upto(spark, dst))]
    frames = [spark.read.parquet(*parts)] if parts else []
    fs, at = _files(spark, dst)
    if fs.exists(at):
        frames.append(spark.read.parquet(dst))
    if not frames:
        return None
    out = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1].select(*frames[0].columns))
    return keyed_upsert(out, key_col, _total_order(out, key_col, order)).select(*out.columns)


def folding_writer(src: str, dst: str, key_col: str, order: list[str], partition_by: list[str] | None = None, every: int = 16):
    """K3: ``foreachBatch`` function that writes a batch folder under ``src`` and, whenever ``every``
    of them wait, folds them into ``dst``; so no reader meets more than ``every`` folders."""
    write = batch_writer(src, key_col, order)

    def write_and_fold(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if batch_id > folded_upto(spark, dst):  # else a repeated batch that the table holds
            write(batch_df, batch_id)
        fold_batches(spark, src, dst, key_col, order, partition_by, least=every, delete=True)
    return write_and_fold


def compact_keyed(spark: SparkSession, src: str, dst: str, key_col: str, order: list[str],
                  partition_by: list[str] | None = None) -> None:
    """Fold the batch folders that a stream wrote into one latest-per-key table,
    partitioned (e.g. by date) for pruning; re-running changes nothing."""
    fold_batches(spark, src, dst, key_col, order, partition_by)


def to_families(df: DataFrame, families: dict[str, list[str]], key_col: str) -> DataFrame:
    """K4: group flat columns into one struct per column family."""
    return df.select(F.col(key_col), *[F.struct(*cols).alias(fam) for fam, cols in families.items()])


def from_families(df: DataFrame, families: list[str]) -> DataFrame:
    """Inverse of K4: families back to flat columns."""
    keep = [c for c in df.columns if c not in families]
    return df.select(*keep, *[F.col(f"{fam}.*") for fam in families])


def cells_to_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """K5 reader: a store that wrote every value as text with "None" for null
    is mapped back to nulls (types come from ``try_cast`` by the caller)."""
    cols = cols or df.columns
    return df.select(*[F.when(F.col(c).cast("string") == "None", None).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def batch_writer(path: str, key_col: str | None = None, order: list[str] | None = None,
                 fmt: str = "parquet"):
    """K3: ``foreachBatch`` function writing each micro-batch on the executors
    to ``{path}/batch_id={id}`` (overwrite => a replay after a restart
    replaces the same batch, no duplicates). With ``key_col`` the batch is
    reduced to the latest row per key first (ties by the other columns)."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        out = keyed_upsert(batch_df, key_col, _total_order(batch_df, key_col, order or [])) if key_col else batch_df
        out.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def fan_out(*writers):
    """Several sinks fed by one query and one source read per batch."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            for w in writers:
                w(batch_df, batch_id)
        finally:
            batch_df.unpersist()
    return write


def peek_writer(n: int = 1):
    """K8: show the first ``n`` rows of each batch (debug)."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.limit(n).show(truncate=False)
    return write


def start_stream(df: DataFrame, checkpoint: str, sink: str = "parquet", path: str | None = None,
                 foreach_batch=None, trigger: dict | None = None, query_name: str | None = None,
                 output_mode: str = "append"):
    """K6/K7/K3 + T6/T10: start a query with an explicit checkpoint location
    (restart resumes from the stored offsets and state)."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def save_model(model, path: str) -> None:
    """K9: persist a fitted ``PipelineModel`` (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
