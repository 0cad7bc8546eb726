"""Exact quantiles by rank selection against pandas, with few values in a task."""

import random

import numpy as np
import pandas as pd
import pytest

from delaycast.operators import stats as A


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(6)
    rows = [("wide", rng.uniform(-1, 1) * 10.0 ** rng.randrange(-300, 300)) for _ in range(3000)]  # no equal cells would do
    rows += [("hot", 5.0)] * 4000 + [("hot", 5.0 + i) for i in range(40)] + [("two", 1.0), ("two", 2.0), ("one", -3.5), ("zero", -0.0), ("zero", 0.0)]
    rows += [("ints", float(rng.randrange(50))) for _ in range(2500)] + [("null", None), (None, 4.0), ("ints", None), ("steps", float("inf")), ("steps", 1.0), ("steps", -float("inf"))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most, cells", [(10_000, 64), (50, 8), (1, 4)])
def test_quantiles_equal_pandas(spark, groups, most, cells):
    df = spark.createDataFrame(groups, "g string, v double")
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in A.exact_quantiles(df.repartition(4), ["g"], "v", ps, most, cells).collect()}
    want = pd.DataFrame(groups, columns=["g", "v"]).dropna().groupby("g")["v"]
    assert set(got) == {g for g, _ in want}
    for g, v in want:
        assert got[g].n == len(v)
        for i, p in enumerate(ps):
            x = np.sort(v.to_numpy())
            pos = p * (len(x) - 1)
            lo, hi = int(np.floor(pos)), int(np.ceil(pos))
            expect = x[lo] if lo == hi else (hi - pos) * x[lo] + (pos - lo) * x[hi]
            assert got[g][f"q{i}"] == pytest.approx(expect, rel=1e-12), (g, p)


def test_no_task_holds_a_group(spark, groups):
    plan = A.exact_quantiles(spark.createDataFrame(groups, "g string, v double"), ["g"], "v", [0.5], 50, 8)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan.replace("percentile_approx", "")


def test_quantiles_of_an_empty_table(spark):
    assert A.exact_quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", [0.5]).collect() == []
    assert A.box_summary(spark.createDataFrame([], "g string, v double"), ["g"], "v").collect() == []
