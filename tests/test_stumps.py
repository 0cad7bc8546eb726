"""The model as a table: against a plain Python fit on small rows, edge cases, the use of what it learns."""
import hashlib
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaycast.plans import stumps as ST

SCHEMA = "id int, a double, b double, y double"


def _features():
    return {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None).cast("double")}


def _key():
    return F.col("id").cast("string")


def _md5(text, start, digits):
    return int(hashlib.md5(text.encode()).hexdigest()[start - 1:start - 1 + digits], 16)


def _brute(rows, trees, cells, blocks):
    """Every cut of every tree tried on the drawn rows themselves."""
    names = ["a", "b", "none"]
    rows = [r for r in rows if r[3] is not None and np.isfinite(r[3])]
    ok = lambda x: x is not None and np.isfinite(x)
    vals = {"a": [r[1] for r in rows if ok(r[1])], "b": [r[2] for r in rows if ok(r[2])], "none": []}
    qs = {f: [round(float(np.quantile(v, i / cells)), 6) for i in range(1, cells)] for f, v in vals.items() if v}
    out = {}
    for t in range(trees):
        look = sorted(names, key=lambda f: hashlib.md5(f"{t}:{f}".encode()).hexdigest())[:1]
        best, drawn = None, []
        for r in rows:
            luck = _md5(f"{t}#{_md5(str(r[0]), 9, 4) % blocks}", 1, 4)
            drawn += [r] * sum(luck >= d for d in ST.DRAWS)
        if not drawn:
            continue
        for f in look:
            at = {"a": 1, "b": 2}.get(f)
            for cut in sorted(set(qs.get(f, []))):
                med = qs[f][cells // 2 - 1]
                x = lambda r: r[at] if ok(r[at]) else med
                left, right = [r[3] for r in drawn if x(r) <= cut], [r[3] for r in drawn if x(r) > cut]
                if left and right:
                    gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, f, cut, med <= cut, statistics.mean(left), statistics.mean(right))
        mean = statistics.mean(r[3] for r in drawn)
        out[t] = best[1:] if best else (None, None, True, mean, mean)
    return out


def _rows(seed, n=160):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a = rnd.choice([None, float("nan"), float("inf"), round(rnd.gauss(0, 3), 2), round(rnd.gauss(0, 3), 2), 1.0])
        b = float(rnd.randint(0, 3))
        y = rnd.choice([None, float("nan")]) if rnd.random() < 0.05 else float(rnd.randint(0, 40) + (30 if b > 1 else 0))
        rows.append((i, a, b, y))
    return rows + rows[:20]                                         # repeated rows


@pytest.mark.parametrize("seed", [1, 2])
def test_fit_equals_brute_force(spark, seed):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.tree: r for r in ST.fit(df, _features(), F.col("y"), _key(), trees=12, cells=8, blocks=16).collect()}
    want = _brute(rows, 12, 8, 16)
    assert set(got) == set(want) and {w[0] for w in want.values()} == {"a", "b", None}
    for t, (f, cut, null_left, left, right) in want.items():
        r = got[t]
        assert (r.feature, r.cut, r.null_left) == (f, cut, null_left), (t, r, want[t])
        assert r.left == pytest.approx(left) and r.right == pytest.approx(right)


def test_predict_is_the_mean_answer(spark):
    trees = spark.createDataFrame([(0, "a", 1.0, True, 10.0, 20.0), (1, "b", 0.0, False, 1.0, 3.0),
                                   (2, None, None, True, 6.0, 6.0)],
                                  "tree long, feature string, cut double, null_left boolean, left double, right double")
    df = spark.createDataFrame([(1, 1.0, 0.0, 7), (2, 2.0, None, 8), (3, None, 5.0, 9), (4, float("nan"), 0.0, 9)],
                               "id int, a double, b double, _forest int")
    out = ST.predict(df, _features(), trees)
    assert out.columns == ["id", "a", "b", "_forest", "prediction"]
    got = {r.id: round(r.prediction, 6) for r in out.collect()}
    assert got == {1: round(17 / 3, 6), 2: round(29 / 3, 6), 3: round(19 / 3, 6), 4: round(17 / 3, 6)}
    assert {r.prediction for r in ST.predict(df, _features(), trees.where("false")).collect()} == {None}


def test_empty_table_gives_no_trees(spark):
    df = spark.createDataFrame([], SCHEMA)
    trees = ST.fit(df, _features(), F.col("y"), _key(), trees=3)
    assert trees.count() == 0
    assert ST.predict(df, _features(), trees).count() == 0


def test_learns_a_step_and_the_split_is_stable(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.uniform(-5, 5), rnd.uniform(0, 1), 0.0) for i in range(900)]
    rows = [(i, a, b, (50.0 if a > 1 else 0.0) + rnd.gauss(0, 2)) for i, a, b, _ in rows]
    feats = {"a": F.col("a")}
    df = spark.createDataFrame(rows, SCHEMA)
    tr, te = ST.split_by_key(df, _key())
    n = te.count()
    assert tr.count() + n == 900 and 240 < n < 360
    assert {r.id for r in ST.split_by_key(df.repartition(7), _key())[1].collect()} == {r.id for r in te.collect()}
    pred = ST.predict(te, feats, ST.fit(tr, feats, F.col("y"), _key()))
    assert pred.agg(ST.r2(F.col("y"), F.col("prediction"))).first()[0] > 0.9
    same = spark.createDataFrame([(1, 0.0, 0.0, 4.0), (2, 1.0, 0.0, 4.0)], SCHEMA)
    assert same.agg(ST.r2(F.col("y"), F.col("y"))).first()[0] is None
