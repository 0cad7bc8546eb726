"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaycast.session import durable as stored  # noqa: F401  (written once to the shared folder: later steps start from the files)

#: The white space between words: blank and the five control characters from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


#: Rows of an Arrow batch.
BATCH_ROWS = 2000
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, wherever the driver found it, and set the batch size of
    the session (once for each application)."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp()}/{root.name}.zip"  # Spark sends it from the driver to the executors
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(archive)
        # a worker and its JVM each hold a batch of whole texts: thousands of long ones are too many
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        _shipped.add(sc.applicationId)


def lean(run: Callable) -> Callable:
    """`run` for mapInPandas; at its end the worker, which later tasks use again, gives back the
    memory that it no longer needs."""
    def held(frames):
        yield from run(frames)
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)

    return held


def keep_freed(size: int = 128 << 20) -> None:
    """Let the allocator of this worker keep up to `size` freed bytes for its next arrays: taking the memory of
    each array from the system anew costs more than the sums in it. `lean` gives them back when the task ends."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD, its largest value
        libc.mallopt(-1, size)  # M_TRIM_THRESHOLD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, taken: list[str]) -> str:
    """`name`, or with underscores after it, so that no column of `taken` has that name."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def spared(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`df` with its columns named like one of `names` under free names, and what gives them their names back."""
    names, given = list(names), {}
    for c in df.columns:
        if c.lower() in {n.lower() for n in names}:
            given[c] = free_name(f"{c}_", [*df.columns, *names, *given.values()])
    return df.withColumnsRenamed(given), lambda done: done.withColumnsRenamed({new: old for old, new in given.items()})


def text_key(text) -> F.Column:
    """16 bytes that stand for a whole text (the first half of its SHA-256)."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32))


def sorted_groups(frames: Iterator[pd.DataFrame], keys: list[str], rows: int = 0) -> Iterator[pd.DataFrame]:
    """Cut batches that arrive sorted by `keys` into frames that hold whole groups.

    Only one group is ever carried over from batch to batch. With `rows`, small
    groups are handed out together, about that many rows at a time.
    """
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        changed = np.zeros(len(frame), dtype=bool)
        for k in keys:
            v = frame[k].to_numpy()
            changed[1:] |= v[1:] != v[:-1]
        if held:
            last = held[-1].iloc[-1]
            changed[0] = any(last[k] != frame[k].iloc[0] for k in keys)
        starts = np.flatnonzero(changed)
        if not len(starts):
            held.append(frame)
            continue
        cut = starts[-1]
        if rows == 0:
            edges = [0, *[s for s in starts if s > 0]]
            for a, b in zip(edges, [*edges[1:], None]):
                if b is None:
                    break
                part = frame.iloc[a:b]
                if a == 0 and held and not changed[0]:
                    part = pd.concat([*held, part])
                    held = []
                elif a == 0 and held:
                    yield pd.concat(held)
                    held = []
                yield part
            if held:  # the batch starts a new group and holds only that
                yield pd.concat(held)
            held = [frame.iloc[edges[-1]:]]
        else:
            held.append(frame.iloc[:cut])
            if sum(map(len, held)) >= rows:
                yield pd.concat(held)
                held = []
            rest = frame.iloc[cut:]
            if held and sum(map(len, held)) == 0:
                held = []
            held.append(rest)
    if held:
        yield pd.concat(held)
