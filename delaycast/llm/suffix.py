"""Removal of long repeated substrings by hashes of anchors, which stand in for a sort of suffixes.

Only strings around an anchor are compared. The anchor of a string of
`length` bytes is the least of its K-byte substrings by a fixed hash (the
leftmost of equals), so equal strings have their anchors at the same place, and
a string can only occur twice if its anchor does. Sampled splitters
range-partition them by the anchor's leading bytes and hash, so no group of equal
strings lies across a boundary of buckets; every bucket groups the strings by
hashes of tokens, one after the other, and checks their bytes. Classes of a
frequent anchor are compared by sums over digests instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from .hashing import Sums
from .kit import free_name, lean, sorted_groups, stored

#: Bytes of an anchor.
K = 40
#: Long texts are searched for anchors in pieces of so many starts.
PIECE = 1 << 20
_POSITION = np.uint64((1 << 22) - 1)
#: Classes of strings of one anchor beyond which they are compared by sums, and places before the anchor that are compared at once.
SPLIT_AT, SPLIT_PLACES = 2000, 8


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Of each window of `width` values, the place of the least one (leftmost of equals, by their upper 42 bits)."""
    n = len(values) - width + 1
    packed = (values & ~_POSITION) | np.arange(len(values), dtype=np.uint64)
    blocks = -(-len(packed) // width)
    grid = np.full(blocks * width, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    grid[: len(packed)] = packed
    grid = grid.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(tail[:n], head[width - 1: width - 1 + n]) & _POSITION).astype(np.int64)


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, place, first and last start of the strings that each anchor stands for."""
    found = []
    for at in range(0, len(raw) - length + 1, PIECE):
        part = raw[at: at + PIECE + length - 1]
        hashes = Sums(part).all(K) if len(part) > K else Sums(part).of(np.array([0]), np.array([K]))
        place = sliding_argmin(hashes, length - K + 1)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        found.append((hashes[place[first]], place[first] + at, first + at, last + at))
    if not found:
        return (np.zeros(0, dtype=np.uint64),) + (np.zeros(0, dtype=np.int64),) * 3
    return tuple(map(np.concatenate, zip(*found)))


def merged(intervals: np.ndarray) -> np.ndarray:
    """The union of intervals (rows start, end) as ordered ones that don't touch."""
    if not len(intervals):
        return np.zeros((0, 2), dtype=np.int64)
    intervals = intervals[np.lexsort((intervals[:, 1], intervals[:, 0]))]
    reach = np.maximum.accumulate(intervals[:, 1])
    new = np.concatenate(([True], intervals[1:, 0] > reach[:-1]))
    return np.stack([intervals[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]], axis=1)


def repeated_strings(buffer: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings at `starts` equal another of their group: a multikey sort over tokens of K bytes, then a check of their bytes."""
    sums = Sums(buffer)
    alive, segment = np.arange(len(starts)), group
    for at in range(0, length, K):
        if not len(alive):
            break
        s = starts[alive] + at
        token = sums.of(s, s + min(K, length - at))
        order = np.lexsort((token, segment))
        token, segment, alive = token[order], segment[order], alive[order]
        new = np.concatenate(([True], (segment[1:] != segment[:-1]) | (token[1:] != token[:-1])))
        number = np.cumsum(new) - 1
        many = np.bincount(number)[number] > 1
        alive, segment = alive[many], number[many]
    out = np.zeros(len(starts), dtype=bool)
    if not len(alive):
        return out
    first = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    head = starts[alive[first]][np.searchsorted(first, np.arange(len(alive)), side="right") - 1]
    same = np.ones(len(alive), dtype=bool)
    for at in range(length):
        same &= buffer[starts[alive] + at] == buffer[head + at]
    if same.all():
        out[alive] = True
        return out
    texts: dict = {}
    for i, g in zip(alive, segment):  # two strings of one hash: by their bytes
        texts.setdefault((g, buffer[starts[i]: starts[i] + length].tobytes()), []).append(i)
    for members in texts.values():
        out[members] = len(members) > 1
    return out


CONTEXT = "lead long, h long, fp binary, key binary, place int, before int, least int, string binary, many boolean, cover binary"


def contexts(key: bytes, raw: np.ndarray, wanted: np.ndarray, length: int) -> list[tuple]:
    """The strings around those anchors of a text that occur elsewhere too.

    A string that this text holds several times is repeated: it is given once,
    for others to compare with, and what it covers here in a row of its own.
    """
    h, place, first, last = anchors(raw, length)
    at = np.flatnonzero(np.isin(h, wanted))
    data, seen = raw.tobytes(), {}
    for i in at:
        a, p, q = int(place[i]), int(first[i]), int(last[i])
        seen.setdefault((int(h[i].view(np.int64)), a - p, a - q, data[p: q + length]), []).append((a, p, q + length))
    rows, cover = [], []
    for (code, before, least, string), spans in seen.items():
        fp = hashlib.blake2b(string + before.to_bytes(4, "little") + least.to_bytes(4, "little"), digest_size=16).digest()
        lead = int.from_bytes(string[before: before + 8], "big") - (1 << 63)
        many = len(spans) > 1
        rows.append((lead, code, fp, key, -1 if many else spans[0][0], before, least, string, many, None))
        if many:
            cover += [s[1:] for s in spans]
    if cover:
        rows.append((0, 0, None, key, -1, 0, 0, None, True, merged(np.array(cover, dtype=np.int64)).tobytes()))
    return rows


def compare_bucket(g: pd.DataFrame, length: int) -> pd.DataFrame | None:
    """Of whole groups (one anchor each; one row per class of strings): which bytes around the anchor are repeated, as (h, fp, s, e)."""
    names, group = np.unique(g["h"].to_numpy(), return_inverse=True)
    size = np.array([len(x) for x in g["string"]])
    buffer = np.frombuffer(b"".join(g["string"]) + bytes(8), dtype=np.uint8)
    offset = np.cumsum(size) - size
    before, lo, hi = g["before"].to_numpy(), g["lo"].to_numpy(), g["hi"].to_numpy()
    count = np.maximum(hi - lo + 1, 0)
    row = np.repeat(np.arange(len(g)), count)
    places = hi[row] - (np.arange(len(row)) - (np.cumsum(count) - count)[row])  # bytes before the anchor, from many to few
    found = repeated_strings(buffer, offset[row] + before[row] - places, group[row] * (length + 1) + places, length)
    if not found.any():
        return None
    edge = np.concatenate(([True], (row[1:] != row[:-1]) | (found[1:] != found[:-1])))
    start = np.flatnonzero(edge)
    end = np.append(start[1:], len(row)) - 1
    start, end = start[found[start]], end[found[start]]
    r = row[start]
    return pd.DataFrame({"h": g["h"].to_numpy()[r], "fp": g["fp"].to_numpy()[r], "s": -places[start], "e": -places[end] + length})


def shared_places(classes: DataFrame, length: int) -> DataFrame:
    """Of the classes of frequent anchors: which bytes around the anchor are repeated, as (h, fp, s, e).

    A class is dealt to parts of SPLIT_PLACES places. Classes with equal bytes in
    all strings of a part repeat each other there. Of different ones that agree in
    the bytes that all strings of the part hold, single strings are compared. Both
    by 16 bytes of SHA-256 as keys of sums, so no task needs the rows of a key
    together. Strings of a part overlap, so the first and last that repeat bound what is covered.
    """
    digest = lambda x: F.unhex(F.substring(F.sha2(x, 256), 1, 32))
    low = F.col("part") * SPLIT_PLACES
    parts = classes.withColumn("part", F.explode(F.sequence(F.floor(F.col("least") / SPLIT_PLACES).cast("int"), F.floor(F.col("before") / SPLIT_PLACES).cast("int"))))
    parts = parts.withColumns({"lo": F.greatest("least", low), "hi": F.least("before", low + SPLIT_PLACES - 1)})
    parts = parts.withColumn("bytes", F.substring("string", F.col("before") - F.col("hi") + 1, F.col("hi") - F.col("lo") + length))
    core = F.substring("string", F.col("before") - low + 1, F.lit(length - SPLIT_PLACES + 1))
    group = ["h", "part", "lo", "hi", "u"]
    dealt = parts.select("h", "fp", "part", "lo", "hi", digest(F.col("bytes")).alias("u"), digest(core).alias("core"), "bytes")
    kinds = dealt.groupBy(*group).agg((F.min("fp") < F.max("fp")).alias("many"), F.min("core").alias("core"), F.min("bytes").alias("bytes"))
    kinds = stored(kinds, "kinds")
    kind = F.struct("lo", "hi", "u")
    differ = F.min(kind) < F.max(kind)
    cores = kinds.groupBy("h", "part", "core").agg(differ.alias("differ")).where("differ").drop("differ")
    single = kinds.join(cores, ["h", "part", "core"], "left_semi").select(*group, "bytes", F.explode(F.sequence("lo", "hi")).alias("p"))
    single = single.select(*group, "p", digest(F.substring("bytes", F.col("hi") - F.col("p") + 1, F.lit(length))).alias("w"))
    twins = single.groupBy("h", "p", "w").agg(differ.alias("differ")).where("differ").drop("differ")
    single = single.join(twins, ["h", "p", "w"], "left_semi").select(*group, F.col("p").alias("first"), F.col("p").alias("last"))
    whole = kinds.where("many").select(*group, F.col("lo").alias("first"), F.col("hi").alias("last"))
    spots = whole.unionByName(single).groupBy(*group).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return dealt.select("fp", *group).join(spots, group).select("h", "fp", (-F.col("last")).cast("int").alias("s"), (length - F.col("first")).cast("int").alias("e"))


def deduplicated(docs: DataFrame, length: int = 200, keep_text: bool = False) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with `keep_text` also `kept`, the
    text that stays (a character cut by a removal goes whole), and `row`, the row's other columns.

    Removed is every byte covered by a string of `length` bytes that starts
    anywhere else too, in this text or another; n_spans counts maximal removed
    runs. A null text is empty; null ids stay; a repeated row is another text
    equal to the first; other columns are ignored. `length` is at least 2 K.

    Equal texts are one text from the start (all removed if long enough). No
    task needs all rows of an anchor: strings are classed and counted with
    partial sums first, and those of a frequent anchor are compared by sums alone.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("raw"))

    def survey(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for raw in f["raw"]:
                digest = hashlib.sha256(raw)
                h, n = np.unique(anchors(np.frombuffer(raw, dtype=np.uint8), length)[0].view(np.int64), return_counts=True)
                rows.append((digest.digest()[:16], len(raw), digest.hexdigest(), h, h[n > 1]))
            out = pd.DataFrame(rows, columns=["key", "n_bytes", "sha", "hs", "twice"])
            out.insert(0, "doc_id", f["doc_id"].astype("Int64").to_numpy())
            yield out

    base = stored(texts.mapInPandas(lean(survey), "doc_id long, key binary, n_bytes long, sha string, hs array<long>, twice array<long>"), "anchors")
    code = F.xxhash64("key")
    every = base.select(F.explode("hs").alias("h"), code.alias("c")).unionByName(base.select(F.explode("twice").alias("h"), F.bitwise_not(code).alias("c")))
    dup = every.groupBy("h").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a < b").select("h")
    # by a 64-bit code of the key, which is shorter to shuffle: texts of one code would share a few anchors too many
    wanted = base.select(F.explode("hs").alias("h"), code.alias("c")).join(dup, "h").groupBy("c").agg(F.collect_set("h").alias("hs"))
    first = base.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    wanted = wanted.join(first.withColumn("c", code), "c").drop("c")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        deflate = ZstdCompressor(level=6).compress
        for f in frames:
            out = pd.DataFrame({"key": [hashlib.sha256(raw).digest()[:16] for raw in f["raw"]], "raw": [deflate(raw) for raw in f["raw"]]})
            out.insert(0, "doc_id", f["doc_id"].astype("Int64").to_numpy())
            yield out

    keyed = texts.mapInPandas(lean(pack), "doc_id long, key binary, raw binary")
    suspect = keyed.join(wanted.withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    suspects = stored(suspect.select("key", "raw", "hs"), "suspects")

    def around(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, unpack = [c.split()[0] for c in CONTEXT.split(", ")], ZstdDecompressor().decompress
        for f in frames:
            rows = []
            for key, raw, hs in zip(f["key"], f["raw"], f["hs"]):
                rows += contexts(key, np.frombuffer(unpack(raw), dtype=np.uint8), np.asarray(hs, dtype=np.int64).view(np.uint64), length)
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    near = stored(suspects.mapInPandas(lean(around), CONTEXT), "contexts")
    strings = near.where("fp is not null")
    at = F.struct("key", "place")
    classes = strings.groupBy("lead", "h", "fp").agg(F.min("before").alias("before"), F.min("least").alias("least"), F.min("string").alias("string"),
                                                     (F.max("many") | (F.min(at) != F.max(at))).alias("many"))
    classes = stored(classes, "strings")
    sizes = stored(classes.groupBy("h").count().where("count > 1"), "sizes")
    order = ["lead", "h"]

    def buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in sorted_groups(frames, order, rows=2000):
            if (found := compare_bucket(g, length)) is not None:
                yield found

    split = classes.join(sizes.where(F.col("count") <= SPLIT_AT), "h").select(*order, "fp", "before", F.col("least").alias("lo"), F.col("before").alias("hi"), "string")
    found = split.repartitionByRange(*order).sortWithinPartitions(*order, "fp").mapInPandas(lean(buckets), "h long, fp binary, s int, e int")
    found = found.unionByName(shared_places(classes.join(sizes.where(F.col("count") > SPLIT_AT), "h"), length))
    found = found.unionByName(classes.where("many").select("h", "fp", (-F.col("before")).cast("int").alias("s"), (length - F.col("least")).cast("int").alias("e")))
    spans = strings.where("place >= 0").select("h", "fp", "key", "place").join(found, ["h", "fp"])
    spans = spans.groupBy("key").agg(F.collect_list(F.struct((F.col("place") + F.col("s")).alias("s"), (F.col("place") + F.col("e")).alias("e"))).alias("spans"))
    spans = spans.select("key", F.transform("spans", lambda x: x["s"]).alias("s"), F.transform("spans", lambda x: x["e"]).alias("e"))
    own = near.where("cover is not null").select(F.col("key").alias("_own"), "cover").groupBy("_own").agg(F.min("cover").alias("cover"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = ZstdDecompressor().decompress
        for f in frames:
            rows = []
            for key, raw, s, e, cover in zip(f["key"], f["raw"], f["s"], f["e"], f["cover"]):
                each = [np.frombuffer(cover, dtype=np.int64).reshape(-1, 2)] if cover is not None else []
                if s is not None:
                    each.append(np.stack([s, e], axis=1).astype(np.int64))
                raw, runs = unpack(raw), merged(np.concatenate(each))
                edges = [0, *runs.ravel().tolist(), len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((key, len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if keep_text else None))
            out = pd.DataFrame(rows, columns=["key", "n_removed", "n_spans", "kept_sha256", "kept"])
            yield out if keep_text else out.drop(columns="kept")

    both = suspects.select("key", "raw").join(spans.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left").join(own, F.col("key") == F.col("_own"), "left")
    both = both.where("s is not null or cover is not null").select("key", "raw", "s", "e", "cover")
    done = both.mapInPandas(lean(cut), "key binary, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * keep_text)
    done = done.dropDuplicates(["key"])
    twice = first.where("copies > 1").select("key", F.lit(True).alias("all"))
    info = done.join(twice, "key", "full_outer")
    gone = F.coalesce(F.col("all") & (F.col("n_bytes") >= length), F.lit(False))
    columns = ["doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
               F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
               F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")]
    if not keep_text:
        return base.select("doc_id", "key", "n_bytes", "sha").join(info, "key", "left").select(*columns)
    kept = F.when(gone, F.lit("")).otherwise(F.coalesce("kept", "raw")).alias("kept")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(F.col("doc_id"), F.struct(F.lit(0).alias(free_name("_", docs.columns)), *others).alias("row"), F.coalesce("text", F.lit("")).alias("raw"))
    rows = rows.withColumns({"sha": F.sha2(F.col("raw").cast("binary"), 256), "n_bytes": F.octet_length("raw").cast("long")})
    rows = rows.withColumn("key", F.unhex(F.substring("sha", 1, 32)))
    return rows.join(info, "key", "left").select(*columns, kept, "row")


def without_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """`docs` less all repeated substrings (n_chars, if there, is counted anew), and less documents of which no word is left."""
    done = deduplicated(docs, length, keep_text=True).where((F.col("n_removed") == 0) | F.regexp_like("kept", F.lit(r"[^\x20\x09-\x0D]")))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c not in ("doc_id", "text")}
    columns |= {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.select(*[columns[c].alias(c) for c in docs.columns])
