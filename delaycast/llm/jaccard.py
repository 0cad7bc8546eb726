"""A similarity join on word n-grams with Bayesian pruning of candidates.

Documents with the same set of n-grams are one class. Classes that agree on a
band of MinHash values are candidates: their values are compared some at a time,
and a pair is dropped as soon as the posterior probability that its Jaccard
similarity reaches the threshold falls below a tolerance. Pairs that remain are
verified by their n-gram sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .hashing import TOGETHER, Sums, mixed
from .kit import free_name, lean, sorted_groups, stored, text_key

BANDS, BAND_VALUES = 20, 4
VALUES = BANDS * BAND_VALUES
_rng = np.random.default_rng(19)
_factors = _rng.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDER = np.uint64(0x2545F4914F6CDD1D)


def gram_sets(texts: list[str], size: int = 5) -> Iterator[np.ndarray]:
    """Of each text, the sorted 64-bit hashes of its different n-grams of words.

    Words are cut at blanks and the control characters from tab to carriage
    return. A text of fewer words than `size` has one n-gram of all of them; one
    without words has none.
    """
    at = 0
    while at < len(texts):
        raws = []
        while at < len(texts) and (not raws or sum(map(len, raws)) + len(texts[at]) < TOGETHER):
            raws.append(texts[at].encode("utf-8", "replace"))
            at += 1
        raw = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edges = np.flatnonzero(np.diff(np.concatenate(([1], space.view(np.int8)))))
        starts, ends = edges[::2], edges[1::2]
        words = Sums(raw).of(starts, ends)
        limits = np.searchsorted(starts, np.cumsum([0, *[len(r) + 1 for r in raws]]))
        grams = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
        for j in range(size):
            grams = grams * _ORDER + words[j: j + len(grams)]
        grams = mixed(grams)
        for a, b in zip(limits, limits[1:]):
            if b - a >= size:
                yield np.unique(grams[a: b - size + 1])
            elif b > a:
                one = np.uint64(b - a)
                for w in words[a:b]:
                    one = np.uint64((int(one) * int(_ORDER) + int(w)) & 0xFFFFFFFFFFFFFFFF)
                yield mixed(np.array([one], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)


def set_key(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def signature(grams: np.ndarray) -> bytes | None:
    """MinHash values: the upper halves of the least products of the n-grams with each factor."""
    if not len(grams):
        return None
    least = np.full(VALUES, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for a in range(0, len(grams), 2048):
        least = np.minimum(least, (grams[a: a + 2048, None] * _factors[None, :]).min(axis=0))
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def least_matches(step: int, threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(h, m): of h compared values at least m must agree.

    Under a uniform prior, the posterior probability that the similarity reaches
    the threshold after m of h agree is that of at most m of h + 1 trials of
    chance `threshold` succeeding.
    """
    out = []
    for h in range(step, VALUES + 1, step):
        reach, m = 0.0, 0
        while (reach := reach + comb(h + 1, m) * threshold**m * (1 - threshold) ** (h + 1 - m)) < tolerance:
            m += 1
        out.append((h, m))
    return out


def linked(values: np.ndarray, sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, band: int,
           threshold: float, tolerance: float) -> np.ndarray:
    """Which of the pairs i, j, which agree on `band`, are similar and agree on no earlier band."""
    sizes = np.array([len(s) for s in sets])
    at = np.flatnonzero(np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-9)
    pairs = values.reshape(len(values), BANDS, BAND_VALUES)
    codes = (pairs[:, :, 0::2].astype(np.uint64) << np.uint64(32)) | pairs[:, :, 1::2]
    for b in range(band):
        at = at[~(codes[i[at], b] == codes[j[at], b]).all(axis=1)]
    seen, agree = 0, np.zeros(len(at), dtype=np.int64)
    for h, least in least_matches(16, threshold, tolerance):
        agree = agree + (values[i[at], seen:h] == values[j[at], seen:h]).sum(axis=1)
        at, agree, seen = at[agree >= least], agree[agree >= least], h
    if len(at) <= 64:
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i[at], j[at])], dtype=np.int64)
    else:
        grams, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rows = np.repeat(np.arange(len(sets)), sizes)[count[place] > 1]
        number = (np.cumsum(count > 1) - 1)[place[count[place] > 1]]
        order = np.argsort(number, kind="stable")
        rows, number = rows[order], number[order]
        both = np.zeros((len(sets), len(sets)), dtype=np.float32)
        width = 8192
        for a in range(0, int(number[-1]) + 1 if len(number) else 0, width):
            lo, hi = np.searchsorted(number, [a, a + width])
            part = np.zeros((len(sets), width), dtype=np.float32)
            part[rows[lo:hi], number[lo:hi] - a] = 1
            both += part @ part.T
        common = both[i[at], j[at]].astype(np.int64)
    return at[common >= threshold * (sizes[i[at]] + sizes[j[at]] - common) - 1e-9]


def join_block(frame: pd.DataFrame, threshold: float, tolerance: float) -> pd.DataFrame | None:
    """The links within a block of a bucket or between two: of each class, how many documents it is linked to, and one class of its local component."""
    lo, hi, band = int(frame["lo"].iloc[0]), int(frame["hi"].iloc[0]), int(frame["band"].iloc[0])
    values = np.frombuffer(b"".join(frame["sig"]), dtype="<u4").reshape(len(frame), VALUES)
    sets = [np.frombuffer(g, dtype=np.uint64) for g in frame["grams"]]
    if lo == hi:
        i, j = np.triu_indices(len(frame), 1)
    else:
        own = frame["block"].to_numpy()
        i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(own == lo), np.flatnonzero(own == hi)))
    keep = linked(values, sets, i, j, band, threshold, tolerance) if len(i) else np.zeros(0, dtype=np.int64)
    if not len(keep):
        return None
    i, j, copies = i[keep], j[keep], frame["copies"].to_numpy().astype(np.float64)
    links = np.bincount(i, copies[j], len(frame)) + np.bincount(j, copies[i], len(frame))
    root = np.arange(len(frame))
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = np.flatnonzero(links)
    keys = frame["k"].to_numpy()
    return pd.DataFrame({"k": keys[some], "root": keys[root[some]], "links": links[some].astype(np.int64)})


def similar(docs: DataFrame, **options) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, n_links, set_id; see `classed`."""
    out = classed(docs, **options).select("doc_id", "class_id", "n_links", "set_id")
    lost = docs.where("doc_id is null").select(*[F.lit(None).cast("long").alias(c) for c in ("doc_id", "class_id")], F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("set_id"))
    return out.unionByName(lost)


def classed(docs: DataFrame, threshold: float = 0.8, size: int = 5, tolerance: float = 1e-6, block: int = 256) -> DataFrame:
    """One row per row of `docs` that has a doc_id: doc_id, text_key, class_id, n_links, set_id, class (null for texts without words).

    Documents are linked if the Jaccard similarity of their sets of `size`-word
    n-grams (lower case) is at least `threshold`. n_links: to how many other
    documents. class_id: the smallest doc_id of those connected by links; set_id:
    of those with the same n-grams. A null or wordless text is linked to nothing
    and is its own class; a null doc_id takes no part (null, 0 links). Repeated
    rows are copies of each other; other columns are ignored.

    Links are found with probability over 0.9999 (20 bands of 4 values; nearly
    1 above the threshold), and none is found that isn't one. Buckets are cut
    into blocks of about `block` classes, each pair of blocks a task of its own
    that gives out sums and one edge per class, never its pairs.
    """
    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sets = list(gram_sets(f["text"].tolist(), size))
            yield pd.DataFrame({"doc_id": f["doc_id"], "text_key": f["text_key"], "k": [set_key(s) for s in sets], "sig": [signature(s) for s in sets]})

    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    keyed = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("text_key"), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    rows = stored(keyed.mapInPandas(lean(sketch), "doc_id long, text_key binary, k binary, sig binary"), "sketches")
    classes = stored(rows.where("k is not null").groupBy("k").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"), F.min("sig").alias("sig")), "classes")

    width = 4 * BAND_VALUES
    keys = F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.substring("sig", b * width + 1, width), F.lit(b)).alias("key")) for b in range(BANDS)])
    member = classes.select("k", F.explode(keys).alias("x")).select("k", "x.band", "x.key")
    buckets = member.groupBy("band", "key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("k")).alias("who"), F.bit_xor(F.xxhash64("k", F.lit(1))).alias("who2")).where("n > 1")
    # buckets of the same classes in several bands are one
    buckets = buckets.groupBy("n", "who", "who2").agg(F.min(F.struct("band", "key")).alias("x")).select("n", "x.band", "x.key")
    member = stored(member.join(buckets, ["band", "key"]), "members")

    def grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sets = list(gram_sets(f["text"].tolist(), size))
            same = np.array([set_key(s) == k for s, k in zip(sets, f["k"])], dtype=bool)
            yield pd.DataFrame({"k": f["k"], "copies": f["copies"], "sig": f["sig"], "grams": [s.tobytes() for s in sets]})[same]

    wanted = classes.join(member.select("k").distinct(), "k", "left_semi")
    content = texts.join(wanted, texts["doc_id"] == wanted["rep"]).select("k", "copies", "sig", "text")
    content = content.mapInPandas(lean(grams), "k binary, copies long, sig binary, grams binary").dropDuplicates(["k"])
    blocks = F.ceil(F.col("n") / block).cast("int")
    rest = member.join(content, "k").withColumn("block", F.pmod(F.xxhash64("k", "key"), blocks).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rest = rest.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other", "n")
    group = ["band", "key", "lo", "hi"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in sorted_groups(frames, group):
            if len(g) > 1 and (found := join_block(g, threshold, tolerance)) is not None:
                yield found

    found = stored(rest.repartition(*group).sortWithinPartitions(*group, "k").mapInPandas(lean(run), "k binary, root binary, links long"), "links")
    links = found.groupBy("k").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("k").alias("a"), F.col("root").alias("b")))
    named = parts.join(classes.select(F.col("k").alias("node"), "rep"), "node")
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("class_id")), "component").select(F.col("node").alias("k"), "class_id", "component")
    info = classes.select("k", "copies", "rep").join(links, "k", "left").join(named, "k", "left")
    info = info.select("k", F.col("rep").alias("set_id"), F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("component", "k").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("doc_id", "text_key", "k").join(info, "k", "left")
    return out.select("doc_id", "text_key", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("set_id", "doc_id").alias("set_id"), "class")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each class of `docs`: of its smallest doc_id (of that, the text of smallest hash); one row of each doc_id
    and text without words; and all rows without an id. Rows of one id with different texts are different documents."""
    found = classed(docs, **options)
    kept = found.where("class is not null").groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("x")).select("x.*")
    kept = kept.unionByName(found.where("class is null").select("doc_id", "text_key").distinct())
    key = free_name("text_key", docs.columns)
    kept = kept.select(F.col("doc_id").alias(free_name("kept_id", docs.columns)), F.col("text_key").alias(f"{key}_kept"))
    rows = docs.where("doc_id is not null").withColumn(key, text_key("text"))
    one = rows.join(kept, (F.col("doc_id") == kept[kept.columns[0]]) & (F.col(key) == F.col(f"{key}_kept")), "left_semi").dropDuplicates(["doc_id", key])
    return one.select(*docs.columns).unionByName(docs.where("doc_id is null"))
