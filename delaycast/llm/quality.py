"""A quality classifier by pairwise ranking.

A document's score is linear in features of its text. The weights are those of a
Bradley-Terry model: of two documents, the chance that the first is the better
one is the logistic function of their scores' difference. They are fitted to
pairs of a better and a worse labelled document by the logistic loss on feature
differences. Documents below a quantile of the scores are rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kit import lean

_odd_end = re.compile(r"[^\w\s]{2,}(?=\s|$)").findall
FEATURES = 24


def features(text: str) -> list[float]:
    """Numbers that describe the whole text; all but the first two are shares between 0 and 1."""
    if not text:
        return [0.0] * FEATURES
    raw = text.encode("utf-8", "replace")
    n = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size = len(raw)
    words, lines = text.split(), text.split("\n")
    count = len(words) or 1
    low = Counter(w.lower() for w in words)
    seen = [v for _, v in low.most_common(3)] + [0, 0, 0]
    same = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    triples = len(set(zip(words, words[1:], words[2:])))
    full = [x for x in map(str.strip, lines) if x]
    letters = n[65:91].sum() + n[97:123].sum() + n[195:].sum()
    marks = n[33:48].sum() + n[58:65].sum() + n[91:97].sum() + n[123:127].sum()
    mean = sum(map(len, words)) / count
    return [
        np.log1p(count) / 10, min(mean, 40) / 10, letters / size, n[65:91].sum() / max(1, letters), n[48:58].sum() / size,
        marks / size, (n[35] + n[36] + n[37] + n[38] + n[42]) / size, n[33] / size, (n[124] + n[60] + n[62]) / size,
        n[10] / size, n[128:].sum() / size, (n[44] + n[46]) / size, n[32] / size, len(low) / count,
        seen[0] / count, seen[1] / count, seen[2] / count, same / count, 1 - pairs / max(1, count - 1) if count > 1 else 0,
        1 - triples / max(1, count - 2) if count > 2 else 0, 1 - len(set(full)) / max(1, len(full)), len(_odd_end(text)) / count,
        sum(len(w) == 1 for w in words) / count, sum(w[0].isupper() for w in words) / count,
    ]


def fit_pairs(better: np.ndarray, worse: np.ndarray, pairs: int = 100_000, penalty: float = 1.0, seed: int = 7) -> np.ndarray:
    """Bradley-Terry weights by Newton's method on random pairs of a better and a worse document."""
    rng = np.random.default_rng(seed)
    d = better[rng.integers(len(better), size=pairs)] - worse[rng.integers(len(worse), size=pairs)]
    w = np.zeros(d.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        slope = d.T @ (1 - p) - penalty * w
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + penalty * np.eye(len(w)), slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """Scores 0 to 1 that rise with the Bradley-Terry score; `cut` stands where the quantile `reject` of the training scores is."""

    def __init__(self, x: np.ndarray, good: np.ndarray, cut: float = 0.3, reject: float | None = None):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = self.expand(x)
        self.w = fit_pairs(z[good], z[~good]) if 0 < good.sum() < len(good) else np.zeros(z.shape[1])
        s = z @ self.w
        share = (~good).mean() if reject is None else reject
        ranked = np.sort(s)
        at = min(max(int(round(share * len(s))), 0), len(s))
        edge = ranked[0] - 1 if at == 0 else ranked[-1] + 1 if at == len(s) else (ranked[at - 1] + ranked[at]) / 2
        self.base, self.spread = edge, max(np.std(s) / 4, 1e-6)
        self.shift = np.log(cut / (1 - cut))

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.minimum(z * z, 25)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.w.any():
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip((self.expand(x) @ self.w - self.base) / self.spread + self.shift, -30, 30)))


def matrix(texts: pd.Series) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=np.float64).reshape(len(texts), FEATURES)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, **options) -> Model | None:
    """Fit on the texts of at most `max_rows` labelled documents, those of smallest id hash.

    `labels`: doc_id, quality; null ids or labels don't count, and of several
    labels of one document the lowest holds. No labels, or those of one class: None.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    width = ", ".join(f"f{i} double" for i in range(FEATURES))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = pd.DataFrame(matrix(f["text"]), columns=[f"f{i}" for i in range(FEATURES)])
            out["doc_id"], out["quality"] = f["doc_id"].to_numpy(), f["quality"].to_numpy()
            yield out

    got = rows.mapInPandas(lean(run), f"{width}, doc_id long, quality int").toPandas().sort_values(["doc_id", *(f"f{i}" for i in range(FEATURES))])
    good = got["quality"].to_numpy() == 1
    if not 0 < good.sum() < len(good):
        return None
    return Model(got[[f"f{i}" for i in range(FEATURES)]].to_numpy(), good, **options)


#: The column that `score` adds.
SCORE = "quality_score"


def score(docs: DataFrame, model: Model | None, columns: list[str] | None = None) -> DataFrame:
    """`columns` (all, if None) of every row, and SCORE of its whole text (null: empty). Without a model: 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop(SCORE) if columns is None else docs.select(*{*columns, "text"})
    schema = T.StructType([*rows.schema.fields, T.StructField(SCORE, T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            got = shared.value.score(matrix(texts)) if shared.value and texts else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], [*batch.schema.names, SCORE])

    done = rows.mapInArrow(lean(run), schema)
    return done if columns is None else done.select(*columns, SCORE)
