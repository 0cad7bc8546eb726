"""A gated recurrent language model in numpy, trained and applied inside Spark tasks.

The output is factored by classes: first the class of the next token, then the
token within its class. The most frequent words and the end of a text are in
classes with a softmax of their own; all other words are in classes by their
look, within which a word has its add-one share of the corpus counts, so the
model gives every text a probability. Training truncates backpropagation at the
end of a window but carries the state on; scoring carries it through the whole
document, so its score is the complete log-likelihood.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.session import shared_dir

from .kit import keep_freed, lean, stored

#: Classes with a softmax of their own, and words of each: at least; they grow with the root of the number of different words.
LEAST_SIDE, WORDS_PER_SIDE = 32, 32
HEAD = LEAST_SIDE * LEAST_SIDE  # words of the least model, of which the last is the end of a text
END = HEAD - 1
LOOKS = 24
HIDDEN = 16
#: Rows whose class logits are at hand at once: so few that they stay in the processor's cache.
ROWS_AT_ONCE = 1024
#: Numbers of a slice of the parameters when tasks' results are averaged.
SLICE = 16_384
#: Words whose counts every task knows; the counts of all others come by a join.
KNOWN_WORDS = 100_000
#: Rows of counts that a task holds before it adds them up and hands them on, and rows of a batch of them.
COUNTED_AT_ONCE, COUNTED_BATCH = 800_000, 50_000
#: By byte: the accent of a character whose second byte it is, and the ending of a word whose last byte it is.
_ACCENT = np.array([1 if b in b"\xa7\xa8\xa9\xaa\xab\x80\x87\x88\x89\x8a" else 2 if b in b"\xa4\xb6\xbc\x9f\x84\x96\x9c" else 3 for b in range(256)], dtype=np.int32)
_ENDING = np.array([0 if bytes([b]).isalnum() or b >= 0x80 else 1 if b in b".," else 2 for b in range(256)], dtype=np.int32)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A to Z in lower case, one after the other; and where those of each text begin, with their number at the end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, edges = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    edges -= edges[0]
    real = np.asarray(pc.binary_length(words)) > 0  # white space at an end leaves an empty word there
    if not real.all():
        words, edges = words.filter(pa.array(real)), np.concatenate(([0], np.cumsum(real)))[edges]
    return words.cast(pa.binary()), edges


def look(words: pa.Array) -> np.ndarray:
    """One of LOOKS classes for each word: its first accent, how it ends, and whether it is long."""
    if not len(words):
        return np.empty(0, dtype=np.int32)
    _, offsets, data = words.buffers()
    edges = np.frombuffer(offsets, np.int32)[words.offset: words.offset + len(words) + 1].astype(np.int64)
    byte = np.frombuffer(data, np.uint8)[edges[0]: edges[-1]]
    edges -= edges[0]
    accent = np.zeros(len(words), dtype=np.int32)
    high = np.flatnonzero(byte >= 0x80)
    of = np.searchsorted(edges, high, side="right") - 1
    first = np.flatnonzero(np.diff(of, prepend=-1))
    high, of = high[first], of[first]
    inner = high + 1 < edges[of + 1]  # a byte of the same word follows
    accent[of] = np.where(inner, _ACCENT[byte.take(high + 1, mode="clip")], 3)
    return (accent * 3 + _ENDING[byte[edges[1:] - 1]]) * 2 + (np.diff(edges) > 6)


def chosen(states: np.ndarray, weights: np.ndarray, at: np.ndarray, held: bool, back: bool):
    """log softmax of states @ weights at one place of each row, the logits held to +-60 if they may pass it; with `back`
    instead the slopes of minus its sum by the states (but the last, which is 1) and by the weights."""
    logits = states @ weights
    if held:
        np.clip(logits, -60, 60, out=logits)
    places = np.arange(0, logits.size, logits.shape[1]) + at
    picked = None if back else logits.take(places)
    e = np.exp(logits, out=logits)
    total = e @ np.ones(e.shape[1], dtype=e.dtype)
    if not back:
        return picked - np.log(total)
    e.reshape(-1)[places] -= total
    total = np.reciprocal(total, out=total)[:, None]
    by_states = e @ weights[:-1].T
    by_states *= total
    return by_states, (states * total).T @ e


class Gru:
    """Parameters in one vector: `inputs` (a row of gate inputs for each token), `state` (gates from the state), `classes` and `words` (outputs)."""

    def __init__(self, vector: np.ndarray, side: int = LEAST_SIDE):
        self.vector, self.side, self.head, at = vector, side, side * side, 0
        for name, shape in self.shapes(side).items():
            size = int(np.prod(shape))
            setattr(self, name, vector[at: at + size].reshape(shape))
            at += size

    @staticmethod
    def shapes(side: int) -> dict[str, tuple[int, ...]]:
        return {"inputs": (side * side + LOOKS, 3 * HIDDEN), "state": (HIDDEN, 3 * HIDDEN), "classes": (HIDDEN + 1, side + LOOKS), "words": (side, HIDDEN + 1, side)}

    @classmethod
    def size(cls, side: int) -> int:
        return sum(int(np.prod(s)) for s in cls.shapes(side).values())

    @classmethod
    def start(cls, head: np.ndarray, looks: np.ndarray, seed: int = 5) -> "Gru":
        """Random gates, and outputs that are the shares of these counts whatever the state."""
        rng, side = np.random.default_rng(seed), math.isqrt(len(head))
        m = cls(np.zeros(cls.size(side), dtype=np.float32), side)
        m.inputs[:] = rng.normal(0, 0.3, m.inputs.shape)
        m.inputs[:, :HIDDEN] += 1  # forget slowly
        m.state[:] = rng.normal(0, HIDDEN**-0.5, m.state.shape)
        by_class = (head + 1.0).reshape(side, side)
        m.words[:, HIDDEN] = np.log(by_class / by_class.sum(axis=1, keepdims=True))
        total = np.concatenate([by_class.sum(axis=1), looks + 1.0])
        m.classes[HIDDEN] = np.log(total / total.sum())
        return m

    def step(self, x: np.ndarray, h: np.ndarray):
        """One step: the new state, and the rest of `run`."""
        *rest, h = self.run(x[None], h.T)
        return h.T, *rest

    def run(self, grid: np.ndarray, h: np.ndarray, same: np.ndarray | None = None):
        """Steps of streams side by side, all by (step, number, stream): the states before each step, what going back
        needs (gates, candidate states, their sums from the state), and the last state (number, stream). What comes into
        a step is multiplied by `same`."""
        (steps, width), hid, kind = grid.shape, HIDDEN, self.vector.dtype
        sign = np.repeat(np.array([-1, 1], dtype=kind), [2 * hid, hid])  # the sigmoid of x is 1 / (1 + exp(-x))
        inputs, state = self.inputs * sign, np.ascontiguousarray((self.state * sign).T)
        given = np.ascontiguousarray(inputs.take(grid.ravel(), axis=0).reshape(steps, width, 3 * hid).transpose(0, 2, 1))
        states, gates, new, held = (np.empty((steps, n, width), dtype=kind) for n in (hid, 2 * hid, hid, hid))
        sums = np.empty((3 * hid, width), dtype=kind)
        for s in range(steps):
            now, zr, n = states[s], gates[s], new[s]
            if same is None:
                now[:] = h
            else:
                np.multiply(h, same[s], out=now)
            np.matmul(state, now, out=sums)
            np.add(given[s, : 2 * hid], sums[: 2 * hid], out=zr)
            with np.errstate(over="ignore"):
                np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            held[s] = sums[2 * hid:]
            np.multiply(zr[hid:], sums[2 * hid:], out=n)
            n += given[s, 2 * hid:]
            np.tanh(n, out=n)
            h = now - n
            h *= zr[:hid]
            h += n
        return states, gates, new, held, h

    def outputs(self, states: np.ndarray, x: np.ndarray, back: bool = False):
        """log P of each token x after each state; with `back` instead the loss's slopes by the states and by the output parameters."""
        given = np.ones((len(states), HIDDEN + 1), dtype=states.dtype)
        given[:, :HIDDEN] = states
        most = np.abs(given).max(axis=0) if len(given) else given.sum(axis=0)
        x = x.astype(np.int32)
        cls = np.where(x < self.head, x // self.side, self.side + x - self.head)
        out = np.empty_like(states) if back else np.empty(len(x))
        d = {"classes": np.zeros_like(self.classes), "words": np.zeros_like(self.words)}
        held = bool((most @ np.abs(self.classes)).max() > 60)
        for a in range(0, len(x), ROWS_AT_ONCE):
            b = a + ROWS_AT_ONCE
            got = chosen(given[a:b], self.classes, cls[a:b], held, back)
            if back:
                out[a:b] = got[0]
                d["classes"] += got[1]
            else:
                out[a:b] = got
        order = np.argsort(cls.astype(np.int16), kind="stable")
        edges = np.searchsorted(cls.take(order), np.arange(self.side + 1)).tolist()
        order = order[: edges[-1]]  # the rows of a class lie side by side from here on
        given, place = given.take(order, axis=0), x.take(order) % self.side
        inner = np.empty((len(order), *out.shape[1:]), dtype=out.dtype)
        held = (np.einsum("k,ckw->cw", most, np.abs(self.words)).max(axis=1) > 60).tolist()
        for c, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                got = chosen(given[a:b], self.words[c], place[a:b], held[c], back)
                if back:
                    inner[a:b], d["words"][c] = got
                else:
                    inner[a:b] = got
        out[order] += inner
        return (out, d) if back else out

    def score(self, texts: list[np.ndarray], lanes: int = 1024, window: int = 16) -> np.ndarray:
        """Natural-log probability of each token sequence."""
        total = np.zeros(len(texts))
        order = np.argsort([-len(t) for t in texts], kind="stable")
        for a in range(0, len(order), lanes):
            rows = order[a: a + lanes]
            sizes = np.array([len(texts[i]) for i in rows])
            grid = np.zeros((sizes[0], len(rows)), dtype=np.int32)
            for j, i in enumerate(rows):
                grid[: sizes[j], j] = texts[i]
            h, t = np.zeros((HIDDEN, len(rows)), dtype=np.float32), 0
            while t < sizes[0]:
                on = int(np.searchsorted(-sizes, -t, side="left"))  # sequences longer than t
                to = t + max(window, lanes * window // on)  # some lanes * window tokens
                x = grid[t:to, :on]
                states, *_, h = self.run(x, h[:, :on])
                at = np.flatnonzero(np.arange(t, t + len(x))[:, None] < sizes[:on])
                got = self.outputs(states.transpose(0, 2, 1).reshape(-1, HIDDEN).take(at, axis=0), x.ravel().take(at))
                total[rows[:on]] += np.bincount(at % on, got, on)
                t = to
        return total


class Trainer:
    """Adam on windows of parallel streams of documents."""

    def __init__(self, model: Gru, rate: float = 0.01, lanes: int = 256, window: int = 32, warm: int = 20):
        self.m, self.rate, self.lanes, self.window, self.warm = model, rate, lanes, window, warm
        self.first, self.second, self.steps, self.tokens = np.zeros_like(model.vector), np.zeros_like(model.vector), 0, 0

    def train(self, texts: list[np.ndarray]) -> None:
        """One pass; a stream holds whole documents, one after the other, and its state starts anew with each. As many
        streams as leave some 32 windows to learn from, but at least 32."""
        lanes = min(max(32, sum(map(len, texts)) // (32 * self.window)), self.lanes)
        streams: list[list[np.ndarray]] = [[] for _ in range(lanes)]
        load = np.zeros(lanes, dtype=np.int64)
        for t in sorted(texts, key=len, reverse=True):
            i = int(load.argmin())
            streams[i].append(t)
            load[i] += len(t)
        streams = sorted((s for s in streams if s), key=lambda s: -sum(map(len, s)))  # the longest first: those that go on are always a prefix
        lengths = np.array([sum(map(len, s)) for s in streams], dtype=np.int64)
        grid = np.zeros((lengths.max() if len(lengths) else 0, len(streams)), dtype=np.int32)
        fresh = np.zeros(grid.shape, dtype=bool)
        for j, s in enumerate(streams):
            grid[: lengths[j], j] = np.concatenate(s)
            fresh[np.cumsum([0, *map(len, s[:-1])]), j] = True
        h, t = np.zeros((len(streams), HIDDEN), dtype=np.float32), 0
        while t < len(grid):
            on = int(np.searchsorted(-lengths, -t, side="left"))  # streams longer than t
            to = t + self.window * min(max(1, lanes // on), 16)  # the fewer they are, the longer the window
            part = (slice(t, to), slice(0, on))
            live = np.arange(t, min(to, len(grid)))[:, None] < lengths[None, :on]
            h, t = self.learn(grid[part], fresh[part], live, h[:on], lanes), to

    def learn(self, grid: np.ndarray, fresh: np.ndarray, live: np.ndarray, h: np.ndarray, lanes: int = 0) -> np.ndarray:
        m, steps, width, hid = self.m, len(grid), grid.shape[1], HIDDEN
        x, kind = grid.ravel(), self.m.vector.dtype
        same = (~fresh).astype(kind)[:, None, :]
        states, gates, new, held, h = m.run(grid, h.T, same)
        at = np.flatnonzero(live.ravel())
        n = len(at)
        flat = states.transpose(0, 2, 1).reshape(-1, hid)
        d_live, d = m.outputs(flat.take(at, axis=0), x.take(at), back=True)
        d_out = np.zeros_like(flat)
        d_out[at] = d_live
        d_out = np.ascontiguousarray(d_out.reshape(steps, width, hid).transpose(0, 2, 1))
        z, r, alive = gates[:, :hid], gates[:, hid:], live.astype(kind)[:, None, :]
        # slopes of the new state by the gates' sums; what the loop adds is the slope by the new state
        by_z, by_n, by_r = (states - new) * z * (1 - z), (1 - z) * (1 - new * new), held * r * (1 - r)
        d_held, d_new = np.empty((steps, 3 * hid, width), dtype=kind), np.empty_like(states)
        dh, more = np.zeros((2, hid, width), dtype=kind)
        for s in range(steps - 1, -1, -1):
            dh *= alive[s]
            dn, g = d_new[s], d_held[s]
            np.multiply(dh, by_n[s], out=dn)
            np.multiply(dh, by_z[s], out=g[:hid])
            np.multiply(dn, by_r[s], out=g[hid: 2 * hid])
            np.multiply(dn, r[s], out=g[2 * hid:])
            dh *= z[s]
            dh += np.matmul(m.state, g, out=more)
            dh += d_out[s]
            dh *= same[s]
        slope = Gru(np.zeros_like(m.vector), m.side)
        by_number = d_held.transpose(1, 0, 2).reshape(3 * hid, -1)
        slope.state[:] = (by_number @ flat).T
        by_number[2 * hid:] = d_new.transpose(1, 0, 2).reshape(hid, -1)
        order = np.argsort(x.astype(np.uint16) if len(m.inputs) <= 1 << 16 else x, kind="stable")
        changes = np.concatenate(([0], np.diff(x.take(order)) > 0))
        which = np.empty(len(x), dtype=np.int64)  # the place of each token among the different tokens
        which[order] = np.cumsum(changes)
        first = order[np.flatnonzero(np.concatenate(([1], changes[1:])))]
        slope.inputs[x[first]] = np.stack([np.bincount(which, column) for column in by_number], axis=1)
        slope.classes[:], slope.words[:] = d["classes"], d["words"]
        g = slope.vector
        g /= (lanes or self.lanes) * self.window  # a window of a few streams' ends weighs little
        g *= min(1, 1 / (np.sqrt(float(g @ g)) + 1e-9))
        self.steps += 1
        self.tokens += n
        self.first *= 0.9
        self.first += np.multiply(g, 0.1, out=(held := np.empty_like(g)))
        self.second *= 0.999
        np.multiply(g, g, out=held)
        held *= 0.001
        self.second += held
        rate = self.rate * min(1, self.steps / self.warm) / (1 + self.steps / 500)
        np.sqrt(self.second, out=held)
        held *= 1 / math.sqrt(1 - 0.999**self.steps)
        held += 1e-7
        np.divide(self.first, held, out=held)
        held *= rate / (1 - 0.9**self.steps)
        m.vector -= held
        return h.T


def side_of(distinct: int) -> int:
    """The number of classes, and of words in each, for a corpus of that many different words; all of them are among KNOWN_WORDS."""
    return max(LEAST_SIDE, min(math.isqrt(KNOWN_WORDS), math.isqrt(distinct) // WORDS_PER_SIDE))


class Words:
    """What every task knows of the corpus counts. Tokens: the most frequent words by rank, the end of a text, and the looks of all other words."""

    def __init__(self, top: list[tuple[bytes, int]], total: int, distinct: int, ends: int, looks: dict[int, tuple[int, int]], side: int):
        self.side, self.end = side, side * side - 1
        self.known = pa.array([w for w, _ in top], pa.binary())
        self.token_of = np.concatenate([self.end + 1 + look(self.known), [-1]]).astype(np.int32)
        self.token_of[: min(len(top), self.end)] = np.arange(min(len(top), self.end))
        self.logs = np.log10(np.array([c for _, c in top] + [0], dtype=np.float64) + 1)
        self.total, self.distinct, self.ends = total, distinct, ends
        self.look_total = np.array([sum(looks.get(i, (0, 0))) + 1 for i in range(LOOKS)], dtype=np.float64)
        counts = [c for _, c in top[: self.end]]
        self.head_counts = np.array(counts + [0] * (self.end - len(counts)) + [ends], dtype=np.float64)
        self.look_counts = np.array([looks.get(i, (0, 0))[0] for i in range(LOOKS)], dtype=np.float64)

    def tokens(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The token of each word, and its rank (-1: not known)."""
        ranks = places(words, self.known)
        out, unknown = self.token_of.take(ranks), np.flatnonzero(ranks < 0)
        out[unknown] = self.end + 1 + look(words.take(pa.array(unknown)))
        return out, ranks


def places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """The place of each word in `among`; -1: it is not there."""
    return np.asarray(pc.fill_null(pc.index_in(words, value_set=among), -1))


def slices(batches: Iterator[pa.RecordBatch], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each have at most some `most` bytes, or it is a single row."""
    for b in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0)).astype(np.int64)
        edges = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=-1)).tolist()
        for i, j in zip(edges, [*edges[1:], len(b)]):
            yield b.slice(i, j - i)


def together(frames: Iterator[pd.DataFrame], rows: int = 8000) -> Iterator[pd.DataFrame]:
    """Batches joined to some `rows` rows, so that texts of like length are scored side by side."""
    held: list[pd.DataFrame] = []
    for f in frames:
        held.append(f)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held)
            held = []
    if held:
        yield pd.concat(held)


def counted(texts: DataFrame) -> DataFrame:
    """word and n of all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for b in slices(batches):
            n = pc.value_counts(words_of(b.column("text"))[0])
            held.append(pa.table({"word": n.field("values"), "n": n.field("counts")}))
            if sum(map(len, held)) > COUNTED_AT_ONCE:
                yield from added(held)
                held = []
        if held:
            yield from added(held)

    def added(held: list[pa.Table]) -> list[pa.RecordBatch]:
        sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
        return sums.select(["word", "n"]).to_batches(max_chunksize=COUNTED_BATCH)

    return texts.select("text").mapInArrow(lean(count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, at most `most`: all words whose count is in the highest classes (an eighth of an octave each) that fit."""
    octave = F.floor(8 * F.log2("n")).cast("int")
    least, room = None, most
    for r in counts.groupBy(octave.alias("o")).count().orderBy(F.desc("o")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r["o"]
    rows = counts.where(octave >= least).collect() if least is not None else []
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))


def averaged(fitted: DataFrame, size: int) -> np.ndarray | None:
    """The mean of the parameter vectors of all tasks by their numbers of tokens; `fitted` has (slice, n, data) of each.

    The rows of a slice are added up one after the other; only the sums, as long as one model, come to the driver.
    """
    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        n: Counter = Counter()
        for f in frames:
            for i, m, data in zip(f["slice"], f["n"], f["data"]):
                part = np.frombuffer(data, dtype=np.float32).astype(np.float64) * m
                sums[i] = sums[i] + part if i in sums else part
                n[i] += m
        yield pd.DataFrame({"slice": list(sums), "n": [n[i] for i in sums], "data": [s.tobytes() for s in sums.values()]}).astype({"slice": "int32", "n": "int64"})

    got = fitted.repartition("slice").mapInPandas(lean(add), "slice int, n long, data binary").toPandas().sort_values("slice")
    if not len(got):
        return None
    vector = np.concatenate([np.frombuffer(d) / n for d, n in zip(got["data"], got["n"])])
    return vector.astype(np.float32) if len(vector) == size and np.isfinite(vector).all() else None


def scored(docs: DataFrame, held_out, parts: int = 4, chunk: int = 2_000_000) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Counts are of all rows for which `held_out` is false, and the network is trained on each of them once, in `parts`
    rounds: every row's token numbers are stored once, in folders by part; in round i every task trains on its share of
    part i, starting from the common parameters, and the results are averaged by their numbers of tokens. A null text is
    empty, null ids are scored, repeated rows are separate documents, texts of any length are read whole; other columns
    of `docs` do not matter. Without training rows all words are unknown.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.where("not held_out")
    counts = stored(counted(train), "counts")
    known = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = train.count()
    top, side = frequent(counts, KNOWN_WORDS), side_of(known[1])
    head = pa.array([w for w, _ in top[: side * side - 1]], pa.binary())

    def by_look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(places(b.column("word"), head) < 0))
            yield pa.record_batch({"look": pa.array(look(b.column("word"))), "n": b.column("n")})

    looks = counts.mapInArrow(by_look, "look int, n long").groupBy("look").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    words = Words(top, known[0] + ends, known[1] + (ends > 0), ends, {r["look"]: (r["n"], r["v"]) for r in looks}, side)
    shared = spark.sparkContext.broadcast(words)
    kind = np.uint16 if words.end + 1 + LOOKS <= 1 << 16 else np.int32  # token numbers are stored as bytes of this kind

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        unit, look_unit, end = np.log10(w.total + w.distinct + 1), np.log10(w.look_total), np.log10(w.ends + 1)
        for b in slices(batches):
            each, edges = words_of(b.column("text"))
            t, ranks = w.tokens(each)
            logs, tails = w.logs.take(ranks), np.flatnonzero(t > w.end)
            tail = np.zeros(len(t))
            tail[tails] = logs[tails] - look_unit[t[tails] - w.end - 1]
            # with the end of each text, which adds to its sums on its own: no text is without a token
            starts, sizes = edges[:-1] + np.arange(len(b)), np.diff(edges) + 1
            t, logs, tail = (np.insert(x, edges[1:], last) for x, last in ((t, w.end), (logs, 0), (tail, 0)))
            unknown = np.flatnonzero(ranks < 0)
            n_known = sizes - 1 - np.diff(np.searchsorted(unknown, edges))
            rare = pa.ListArray.from_arrays(np.searchsorted(unknown, edges).astype(np.int32), each.take(pa.array(unknown)))
            rare = pc.if_else(pa.array(n_known < sizes - 1), pc.binary_join(rare, b" "), None)
            data, cuts = pa.py_buffer(t.astype(kind)), np.append(starts, len(t)) * np.dtype(kind).itemsize
            yield pa.record_batch({
                "row": b.column("row"), "doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "n_tokens": sizes,
                "n_known": n_known + (w.ends > 0), "base": np.add.reduceat(logs, starts) + end - sizes * unit, "model": np.add.reduceat(tail, starts),
                "rare": rare.cast(pa.string()), "tokens": pa.Array.from_buffers(pa.binary(), len(b), [None, pa.py_buffer(cuts.astype(np.int32)), data]),
                "part": b.column("part")})

    part = F.when(F.col("held_out"), -1).otherwise(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts))).cast("int")
    given = rows.withColumns({"part": part, "row": F.monotonically_increasing_id()})
    kept = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, rare string, tokens binary, part int"
    path = shared_dir(spark, "tokens")
    given.mapInArrow(lean(encode), kept).write.partitionBy("part").parquet(path)
    kept = spark.read.schema(kept).parquet(path)
    vector = Gru.start(words.head_counts, words.look_counts).vector

    def fit(frames: Iterator[pd.DataFrame], start, warm: int) -> Iterator[pd.DataFrame]:
        keep_freed()
        trainer, held, n = Trainer(Gru(start.value.copy(), side), warm=warm), [], 0
        for f in frames:
            for data in f["tokens"]:
                t = np.frombuffer(data, dtype=kind)
                held.append(t)
                n += len(t)
                if n >= chunk:
                    trainer.train(held)
                    held, n = [], 0
        if held:
            trainer.train(held)
        if trainer.tokens:
            v = trainer.m.vector
            yield pd.DataFrame([(i, trainer.tokens, v[a: a + SLICE].tobytes()) for i, a in enumerate(range(0, len(v), SLICE))], columns=["slice", "n", "data"]).astype({"slice": "int32"})

    for i in range(parts if ends else 0):
        start = spark.sparkContext.broadcast(vector)
        fitted = kept.where(F.col("part") == i).select("tokens").mapInPandas(lean(lambda frames, start=start, warm=5 if i else 20: fit(frames, start, warm)), "slice int, n long, data binary")
        mean = averaged(fitted, len(vector))
        vector = vector if mean is None else mean
    final = spark.sparkContext.broadcast(vector)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_freed()
        model = Gru(final.value, side)
        for f in together(frames):
            f = f.assign(doc_id=f["doc_id"].astype("Int64"), model=f["model"] + model.score([np.frombuffer(t, dtype=kind) for t in f["tokens"]]) / np.log(10))
            yield f.drop(columns="tokens")

    done = kept.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "tokens")
    done = stored(done.mapInPandas(lean(score), "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double"), "scores")
    rare = kept.where("rare is not null").select("row", F.explode(F.split("rare", " ")).alias("word")).withColumn("word", F.col("word").cast("binary"))
    rare = rare.join(counts, "word").groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("add"))
    done = done.join(rare, "row", "left")
    add = F.coalesce("add", F.lit(0.0))
    return done.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                       F.lit(words.total).cast("long").alias("train_tokens"), (F.col("base") + add).alias("base_score"), (F.col("model") + add).alias("score"))
