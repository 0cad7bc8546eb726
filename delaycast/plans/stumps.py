"""Delay model as a table (M6-M8, A12): a forest of depth-1 trees, one row a tree.

Fitting is two passes over the rows whatever the number of trees: one takes every feature's quantiles,
one counts rows and adds up labels by (feature, cell between two quantiles, block of rows). Rows belong to
a block by a hash of their key, and a tree draws blocks with replacement, so each tree is made from
that bounded table alone. All sums are of whole numbers (millionths), so the trees depend neither
on the order nor on the partitioning of the rows. Scoring is an expression over the trees: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import free_name
from ..operators.stats import exact_quantiles

MICRO = 1_000_000
# Shares of a Poisson distribution of mean 1 up to 0, 1, ... 4, of 65,536; how often a block is drawn.
DRAWS = [24109, 48218, 60273, 64291, 65296]


def hash_part(text: Column, start: int, digits: int) -> Column:
    """Some hex digits of the MD5 of a text as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), start, digits), 16, 10).cast("bigint")


def split_by_key(df: DataFrame, key: Column, test_percent: int = 33) -> tuple[DataFrame, DataFrame]:
    """M6: train and test rows by the MD5 of a text key (null: empty), the same in any engine."""
    at = hash_part(F.coalesce(key, F.lit("")), 1, 8) % 100
    return df.where(at < 100 - test_percent), df.where(at >= 100 - test_percent)


def _finite(c: Column) -> Column:
    c = c.cast("double")
    return F.when(F.abs(c) < F.lit(float("inf")), c)          # null, NaN (greater than all) and infinities: null


def fit(df: DataFrame, features: dict[str, Column], label: Column, key: Column, trees: int = 100,
        cells: int = 32, blocks: int = 64) -> DataFrame:
    """M7: one row per tree: ``tree, feature, cut, null_left, left, right``.

    A tree draws every block of rows 0 to 5 times, looks at a third of the features and takes the cut (one of
    the ``cells - 1`` quantiles, rounded to millionths) with the greatest sum of squares explained; equal ones go to
    the first feature by name, then the least cut. ``left`` is the mean label where the feature is at most the cut. A feature that
    is null or not finite counts as its median (``null_left``: that is at most the cut). Rows whose label is null or
    not finite take no part. A tree that finds no cut has a null feature and its mean on both
    sides; no rows give no trees.
    """
    names = sorted(features)
    rows = df.select(F.round(_finite(label) * MICRO).cast("decimal(38,0)").alias("y"),
                     (hash_part(F.coalesce(key, F.lit("")), 9, 4) % blocks).alias("block"),
                     F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), _finite(features[f]).alias("x"))
                                         for f in names])).alias("_f")) \
             .where(F.col("y").isNotNull()).select("y", "block", "_f.*")
    q = exact_quantiles(rows, ["feature"], "x", [i / cells for i in range(1, cells)])
    cuts = q.select("feature", F.round(f"q{cells // 2 - 1}", 6).alias("median"), F.array_sort(F.array_distinct(
        F.array(*[F.round(f"q{i}", 6) for i in range(cells - 1)]))).alias("cuts"))
    rows = rows.join(F.broadcast(cuts), "feature", "left")                   # one row a feature
    x = F.coalesce("x", "median")
    cell = F.coalesce(F.size(F.filter("cuts", lambda c: c < x)), F.lit(0))
    sums = rows.groupBy("feature", cell.alias("cell"), "block").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))

    # which features a tree looks at, and how often it draws a block
    tree = F.col("id").cast("string")
    order = F.transform(F.array(*[F.lit(f) for f in names]),
                        lambda f: F.struct(F.md5(F.concat(tree, F.lit(":"), f).cast("binary")).alias("h"), f.alias("f")))
    drawn = df.sparkSession.range(trees).select(
        F.col("id").alias("tree"), F.explode(F.slice(F.array_sort(order), 1, -(-len(names) // 3))).alias("_f"),
        tree.alias("_t")).select("tree", "_t", F.col("_f.f").alias("feature"))
    drawn = drawn.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    luck = hash_part(F.concat("_t", F.lit("#"), F.col("block").cast("string")), 1, 4)
    draws = sum((F.when(luck >= d, 1).otherwise(0) for d in DRAWS), F.lit(0))
    drawn = drawn.withColumn("w", draws).where("w > 0").drop("_t")

    per = drawn.join(sums, ["feature", "block"]).groupBy("tree", "feature", "cell").agg(
        F.sum(F.col("w") * F.col("n")).alias("n"), F.sum(F.col("w") * F.col("s")).alias("s"))
    whole = Window.partitionBy("tree", "feature")                           # at most ``cells`` rows
    upto = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumns({"nl": F.sum("n").over(upto), "sl": F.sum("s").over(upto).cast("double"),
                           "nt": F.sum("n").over(whole), "st": F.sum("s").over(whole)})
    per = per.withColumns({"nr": F.col("nt") - F.col("nl"), "sr": (F.col("st") - F.sum("s").over(upto)).cast("double")})
    per = per.join(F.broadcast(cuts), "feature", "left").withColumn("cut", F.get("cuts", F.col("cell")))
    good = F.col("cut").isNotNull() & (F.col("nr") > 0)
    gain = F.col("sl") * F.col("sl") / F.col("nl") + F.when(F.col("nr") > 0, F.col("sr") * F.col("sr") / F.col("nr"))
    best = F.struct("feature", "cut", (F.col("median") <= F.col("cut")).alias("null_left"),
                    (F.col("sl") / F.col("nl") / MICRO).alias("left"),
                    F.when(F.col("nr") > 0, F.col("sr") / F.col("nr") / MICRO).alias("right"))
    out = per.groupBy("tree").agg(
        F.min_by(F.when(good, best), F.when(good, F.struct((-gain).alias("g"), "feature", "cut"))).alias("b"),
        F.max(F.col("st").cast("double") / F.col("nt") / MICRO).alias("mean"))
    return out.select("tree", "b.feature", "b.cut", F.coalesce("b.null_left", F.lit(True)).alias("null_left"),
                      F.coalesce("b.left", "mean").alias("left"), F.coalesce("b.right", "mean").alias("right"))


def predict(df: DataFrame, features: dict[str, Column], trees: DataFrame, name: str = "prediction") -> DataFrame:
    """M8: ``df`` with the mean answer of the trees in a column ``name`` (null without trees)."""
    asked, forest = free_name("_asked", df.columns), free_name("_forest", df.columns)
    table = trees.agg(F.array_sort(F.collect_list(F.struct(*trees.columns))).alias("a")).scalar()   # as many items as trees
    xs = F.create_map(*[e for f in sorted(features) for e in (F.lit(f), _finite(features[f]))])

    def answer(t: Column) -> Column:
        x = F.when(t["feature"].isNotNull(), F.try_element_at(F.col(asked), F.coalesce(t["feature"], F.lit(""))))
        return F.when(F.coalesce(x <= t["cut"], t["null_left"]), t["left"]).otherwise(t["right"])
    total = F.aggregate(forest, F.lit(0.0), lambda acc, t: acc + answer(t))
    return df.withColumns({asked: xs, forest: table}).withColumn(
        name, F.when(F.size(forest) > 0, total / F.size(forest))).drop(asked, forest)


def r2(label: Column, prediction: Column) -> Column:
    """Coefficient of determination as one aggregate (null for a constant label)."""
    n, s = F.count(label), F.sum(label)
    spread = F.sum(label * label) - s * s / n
    return F.when(spread > 0, 1 - F.sum((label - prediction) * (label - prediction)) / spread)
