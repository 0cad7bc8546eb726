"""Collocations: word phrases that occur more often than their parts let expect.

Every task reads its shard of the texts into windows of up to five words, sorts
them, and builds from the sorted windows a weighted acyclic automaton (`Counts`): a
state for each distinct start of a window, one arc from state to state for each
word, and in each state the number of windows that begin so. The automata are cut
at splitters into ranges of windows, so that the shards' parts of one range meet in
one task, which adds them up state by state. A start of windows that a splitter
begins with lies in two or more ranges; those few states are added up afterwards.
The counts of a phrase's parts come by composing the phrases that begin a window
with those that end it: two joins on the parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kit import lean, sorted_groups, stored

#: Words of a window, words of a shard's automaton, words of a range, windows of the sample that sets the ranges.
LENGTH, SHARD_WORDS, RANGE_WORDS, SAMPLED = 5, 600_000, 1_000_000, 200_000
ID_BITS = 21  # three word numbers fit in one sort key, if there are less than 2 ** 21 different words
UNKNOWN_LANG = "und"
_BREAK = b"\xff"  # never in UTF-8
_PIECE_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)


def words_of(text: str) -> list[bytes]:
    """The words of a text in lower case, with a break after each piece."""
    pieces = text.encode("utf-8", "replace").lower().translate(_PIECE_ENDS)
    out: list[bytes] = []
    for piece in pieces.split(_BREAK):
        found = piece.split()  # only blanks and tabs are left of what this splits at
        if found:
            out += found
            out.append(_BREAK)
    return out


def sort_order(windows: np.ndarray) -> np.ndarray:
    """The order of rows of LENGTH word numbers (0: none)."""
    if len(windows) and windows.max() >= 1 << ID_BITS:
        return np.lexsort(windows.T[::-1])
    keys = []
    for columns in ((3, 4), (0, 1, 2)):  # np.lexsort takes the last key first
        key = np.zeros(len(windows), dtype=np.int64)
        for c in columns:
            key <<= ID_BITS
            key |= windows[:, c]
        keys.append(key)
    return np.lexsort(keys)


def summed(windows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct windows and the sums of their weights."""
    if not len(windows):
        return windows, weights
    order = sort_order(windows)
    windows, weights = windows[order], weights[order]
    first = np.flatnonzero(np.r_[True, (windows[1:] != windows[:-1]).any(axis=1)])
    return windows[first], np.add.reduceat(weights, first)


class Counts:
    """A weighted acyclic automaton over sorted windows: level j has the states after j + 1 words.

    `arcs[j]` is the word of the arc into each state of the level, `starts[j]` the state's first window,
    `weights[j]` the number of windows that begin with its words.
    """

    def __init__(self, windows: np.ndarray, weights: np.ndarray):
        self.windows = windows
        self.starts, self.weights, self.arcs = [], [], []
        new = np.zeros(len(windows), dtype=bool)
        new[:1] = True
        sums = np.r_[0, np.cumsum(weights)]
        for j in range(LENGTH):
            new[1:] |= windows[1:, j] != windows[:-1, j]
            starts = np.flatnonzero(new & (windows[:, j] > 0))
            ends = np.r_[np.flatnonzero(new), len(windows)]
            ends = ends[np.searchsorted(ends, starts, side="right")]
            self.starts.append(starts)
            self.arcs.append(windows[starts, j])
            self.weights.append(sums[ends] - sums[starts])


def packed(windows: np.ndarray, weights: np.ndarray, words: list[bytes]) -> bytes:
    """An automaton as bytes: only the arcs of its states, each with its level, and the weights of the paths' ends."""
    if 8 * windows.size < len(words):
        used = np.unique(np.r_[0, windows.ravel()])
        numbers = np.searchsorted(used, windows).astype(np.uint32)
    else:
        seen = np.zeros(len(words), dtype=bool)
        seen[windows] = True
        seen[0] = True
        used = np.flatnonzero(seen)
        number = np.zeros(len(words), dtype=np.uint32)
        number[used] = np.arange(len(used), dtype=np.uint32)
        numbers = number[windows]
    same = np.cumprod(np.vstack([np.zeros((1, LENGTH), bool), numbers[1:] == numbers[:-1]]), axis=1).sum(axis=1) if len(numbers) else np.zeros(0)
    depth = (numbers > 0).sum(axis=1)
    place = np.arange(LENGTH)
    arcs = numbers[(place >= same[:, None]) & (place < depth[:, None])]
    named = [words[i] for i in used[1:]]
    data = [np.array([len(named), len(windows), len(arcs)], dtype=np.int64), np.array([len(w) for w in named], dtype=np.uint32), same.astype(np.uint8),
            depth.astype(np.uint8), weights.astype(np.int64), arcs.astype(np.uint32)]
    return zstandard.compress(b"".join(a.tobytes() for a in data) + b"".join(named), 3)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Windows, weights and words (from number 1) of a packed automaton."""
    data, at = zstandard.decompress(data), 0

    def take(n: int, kind) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(data, kind, n, at)
        at += got.nbytes
        return got

    n_words, n, n_arcs = take(3, np.int64)
    sizes, same, depth, weights, arcs = take(n_words, np.uint32), take(n, np.uint8), take(n, np.uint8), take(n, np.int64), take(n_arcs, np.uint32)
    ends = at + np.cumsum(sizes, dtype=np.int64)
    words = [data[e - s: e] for e, s in zip(ends.tolist(), sizes.tolist())]
    windows = np.zeros((n, LENGTH), dtype=np.int32)
    place = np.arange(LENGTH)
    windows[(place >= same[:, None]) & (place < depth[:, None])] = arcs
    row = np.arange(n)
    for j in range(LENGTH):  # an arc that is shared with the window before is that window's
        last = np.maximum.accumulate(np.where(same <= j, row, 0))
        windows[:, j] = np.where(same > j, windows[last, j], windows[:, j])
    return windows, weights, words


class Shard:
    """The windows of the texts of one lang, up to SHARD_WORDS words at a time."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {_BREAK: 0}
        self.parts: list[np.ndarray] = []
        self.ends: list[tuple[int, int]] = []
        self.size = 0

    def add(self, words: list[bytes], starts: int) -> None:
        """`words`, of which the first `starts` begin windows; the rest only end them."""
        number = self.number
        part = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int32, count=len(words))
        self.ends.append((self.size + starts, self.size + len(words)))
        self.parts += [part, np.zeros(LENGTH, dtype=np.int32)]
        self.size += len(part) + LENGTH

    def take(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Sorted windows, weights, and the words by number (number 0 is none); the shard is empty after it."""
        words = sorted(self.number, key=lambda w: (w != _BREAK, w))
        rank = np.empty(len(words), dtype=np.int32)
        rank[[self.number[w] for w in words]] = np.arange(len(words), dtype=np.int32)
        t = rank[np.concatenate(self.parts)]
        begins = t > 0
        for a, b in self.ends:
            begins[a:b] = False
        at = np.flatnonzero(begins)
        windows = np.zeros((len(at), LENGTH), dtype=np.int32)
        windows[:, 0] = t[at]
        for j in range(1, LENGTH):
            windows[:, j] = np.where(windows[:, j - 1] > 0, t[at + j], 0)
        self.__init__()
        return *summed(windows, np.ones(len(windows), dtype=np.int64)), words


def added(data: Iterable[bytes], at_once: int = 2_000_000) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The union of packed automata: sorted windows, sums of weights, words by number."""
    number: dict[bytes, int] = {}
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for one in data:
        windows, weights, words = unpacked(one)
        names = np.array([0, *(number.setdefault(w, len(number) + 1) for w in words)], dtype=np.int32)
        parts.append((names[windows], weights))
        size += len(weights)
        if size > at_once and len(parts) > 1:  # equal windows of many shards are one
            parts = [summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]
            size = 0
    words = [_BREAK, *sorted(number)]
    rank = np.zeros(len(words), dtype=np.int32)
    rank[[number[w] for w in words[1:]]] = np.arange(1, len(words), dtype=np.int32)
    del number
    return *summed(rank[np.concatenate([p[0] for p in parts])], np.concatenate([p[1] for p in parts])), words


def first_not_below(windows: np.ndarray, words: list[bytes], splitter: list[bytes]) -> int:
    """The number of windows below `splitter` in the order of the words' bytes."""
    low, high = 0, len(windows)
    while low < high:
        mid = (low + high) // 2
        if [words[i] for i in windows[mid] if i] < splitter:
            low = mid + 1
        else:
            high = mid
    return low


def splitters(rows: DataFrame, range_words: int) -> list[tuple[str, list[bytes]]]:
    """(lang, first words) at which the ranges are cut, in order: quantiles of the windows of a sample of the texts.

    The sample only sets how even the ranges are; its size is bounded by SAMPLED windows, a few of each sampled text.
    """
    docs, total = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    ranges = math.ceil(total / 6 / range_words)
    if ranges <= 1:
        return []
    share = min(1.0, SAMPLED / 100 / docs)

    def sample(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            langs, windows, weights = [], [], []
            for lang, text in zip(f["lang"], f["text"]):
                words = words_of(text)
                starts = [i for i, w in enumerate(words) if w != _BREAK]
                some = starts[:: max(1, len(starts) // 100)][:100]
                for i in some:
                    end = next((j for j in range(i, min(i + LENGTH, len(words))) if words[j] == _BREAK), i + LENGTH)
                    langs.append(lang)
                    windows.append(b" ".join(words[i:end]))
                    weights.append(len(starts) / len(some))
            yield pd.DataFrame({"lang": langs, "window": windows, "weight": weights})

    some = rows.where(F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 40)) < math.ceil(share * (1 << 40))).limit(4 * SAMPLED // 100)
    got = some.mapInPandas(sample, "lang string, window binary, weight double").toPandas()
    found = sorted(zip(got["lang"], (bytes(w).split(b" ") for w in got["window"]), got["weight"]), key=lambda x: x[:2])
    out, upto, step = [], 0.0, got["weight"].sum() / ranges
    for lang, window, weight in found:
        upto += weight
        if upto >= step * (len(out) + 1) and (not out or out[-1] < (lang, window)):
            out.append((lang, window))
    return out


def counted(rows: DataFrame, least: int, range_words: int = RANGE_WORDS, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """lang, words (bytes joined by blanks), size, f of all phrases of up to LENGTH words with f >= `least`; and lang, n of all words."""
    spark = rows.sparkSession
    cuts = splitters(rows, range_words)
    by_lang: dict[str, list[tuple[int, list[bytes]]]] = {}
    for i, (lang, window) in enumerate(cuts):
        by_lang.setdefault(lang, []).append((i + 1, window))
    order = sorted(by_lang)
    shared = spark.sparkContext.broadcast((cuts, by_lang, order))  # bounded by SAMPLED windows

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cuts, by_lang, order = shared.value
        shards: dict[str, Shard] = {}

        def cut(lang: str) -> pd.DataFrame:
            windows, weights, words = shards.pop(lang).take()
            first = sum(len(by_lang[x]) for x in order if x < lang)  # the range in which this lang begins
            edges = [(first, 0), *((i, first_not_below(windows, words, s)) for i, s in by_lang.get(lang, [])), (0, len(windows))]
            parts = [(i, a, b) for (i, a), (_, b) in zip(edges, edges[1:]) if b > a]
            return pd.DataFrame([(lang, i, int(weights[a:b].sum()), packed(windows[a:b], weights[a:b], words)) for i, a, b in parts], columns=["lang", "range", "n", "data"])

        for f in frames:
            for lang, text in zip(f["lang"], f["text"]):
                words = words_of(text)
                for a in range(0, len(words), shard_words):  # a longer text comes in parts, each with the words that end its last windows
                    part = words[a: a + shard_words + LENGTH - 1]
                    shard = shards.setdefault(lang, Shard())
                    if shard.size and shard.size + len(part) > shard_words:
                        yield cut(lang)
                        shard = shards.setdefault(lang, Shard())
                    shard.add(part, shard_words)
            while len(shards) > 1 and sum(s.size for s in shards.values()) > shard_words:
                yield cut(max(shards, key=lambda x: shards[x].size))
        for lang in list(shards):
            if shards[lang].size:
                yield cut(lang)

    def union(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cuts, _, _ = shared.value
        for f in sorted_groups(frames, ["range", "lang"]):
            lang, i = f["lang"].iloc[0], int(f["range"].iloc[0])
            windows, weights, words = added(f["data"])
            counts = Counts(windows, weights)
            edges = [w for at in (i - 1, i) if 0 <= at < len(cuts) and cuts[at][0] == lang for w in [cuts[at][1]]]
            open_ends = {tuple(w[:j]) for w in edges for j in range(1, LENGTH + 1)}
            out = []
            for j in range(LENGTH):
                often = np.flatnonzero(counts.weights[j] >= least)
                rows = {int(x) for x in counts.starts[j][often]}
                for start, n in zip(counts.starts[j][often].tolist(), counts.weights[j][often].tolist()):
                    out.append((b" ".join(words[x] for x in windows[start, : j + 1]), j + 1, n))
                for start_words in open_ends:  # counted in part here: every range gives its part
                    if len(start_words) == j + 1:
                        at = first_not_below(windows, words, list(start_words))
                        if at < len(windows) and at not in rows and tuple(words[x] for x in windows[at, : j + 1]) == start_words:
                            state = int(np.searchsorted(counts.starts[j], at))
                            out.append((b" ".join(start_words), j + 1, int(counts.weights[j][state])))
            yield pd.DataFrame({"lang": lang, "words": [o[0] for o in out], "size": [o[1] for o in out], "f": [o[2] for o in out]}).astype({"size": "int32", "f": "int64"})

    shards = stored(rows.mapInPandas(lean(build), "lang string, range int, n long, data binary"), "automata")
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    met = shards.select("lang", "range", "data").repartition(len(cuts) + 1, "range", "lang").sortWithinPartitions("range", "lang")  # about a range for each task
    found = met.mapInPandas(lean(union), "lang string, words binary, size int, f long")
    found = found.groupBy("lang", "words", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return stored(found, "phrases"), totals


def collocations(docs: DataFrame, least: int = 100, most: int = 2000, share: int = 100, range_words: int = RANGE_WORDS,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `most` phrases of each lang of `docs` (text, lang).

    Phrases of 2 to LENGTH words that occur at least `least` times and are not within a longer such phrase that occurs
    at least `share` percent as often. A phrase's score is the least, over its cuts in two parts, of
    floor(1000 a n / (l r)). A null text has no words, a null lang is UNKNOWN_LANG; repeated rows count as often as
    they are there; other columns do not matter. Any number of langs; the last ranking of a lang sees `most` rows of
    each of 64 parts.
    """
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counts, totals = counted(rows, least, range_words, shard_words)
    counts = counts.withColumn("phrase", F.col("words").cast("string")).drop("words")
    found = counts.where("size > 1").withColumn("w", F.split("phrase", " "))

    def part(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda at: part(at, m))))
    within = found.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    found = found.join(within, ["lang", "phrase"], "left").where(F.coalesce(F.col("around") * 100 < F.col("f") * share, F.lit(True)))
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    cuts = cuts.join(totals, "lang").withColumns({"over": F.lit(1000) * wide["a"] * wide["n"], "under": wide["l"] * wide["r"]})
    cuts = cuts.withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for key in (["lang", "salt"], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= most)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = 100, most: int = 2000) -> str:
    """DuckDB SQL for `collocations` of the table documents."""
    return f"""
        WITH pieces AS (SELECT coalesce(lang, '{UNKNOWN_LANG}') AS lang, unnest(regexp_split_to_array(
                            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda x: x <> '') AS w FROM pieces),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
        starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
        grams AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase FROM starts, range(1, 6) AS s(m) WHERE i + m - 1 <= len(w)),
        counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase HAVING count(*) >= {least}),
        found AS (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE m > 1),
        inner_parts AS (SELECT DISTINCT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, f FROM found, range(2, 5) AS t(s), range(1, 5) AS u(i)
                        WHERE s < m AND i + s - 1 <= m),
        around AS (SELECT lang, phrase, max(f) AS f FROM inner_parts GROUP BY lang, phrase),
        kept AS (SELECT x.* FROM found x LEFT JOIN around y USING (lang, phrase) WHERE y.f IS NULL OR 100 * y.f < 100 * x.f),
        cuts AS (SELECT lang, phrase, f AS a, k, array_to_string(w[1 : k], ' ') AS lefts, array_to_string(w[k + 1 : m], ' ') AS rights
                 FROM kept, range(1, 5) AS v(k) WHERE k < m),
        scored AS (SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score, k
                   FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = lefts JOIN counts r ON r.lang = c.lang AND r.phrase = rights
                   JOIN totals t ON t.lang = c.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM best QUALIFY rank <= {most}"""
