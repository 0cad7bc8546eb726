"""Aggregations and distribution summaries.

Everything is a grouped aggregate with map-side combine; bin edges and
bounds enter as scalar subqueries. Only the exact quantiles need passes, a
few however many rows there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from ..session import durable
from .joins import sized_broadcast


def mean_by(df: DataFrame, keys: list, value: str, alias: str | None = None,
            drop_null_keys: bool = True, digits: int | None = None) -> DataFrame:
    """A1-A3: mean of ``value`` per key (pandas groupby drops null keys)."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    src = df
    agg = F.avg(F.col(value))
    if digits is not None:
        agg = F.round(agg, digits)
    out = src.groupBy(*key_cols).agg(agg.alias(alias or value))
    if drop_null_keys:
        cond = F.lit(True)
        for c in out.columns[:len(keys)]:
            cond = cond & F.col(c).isNotNull()
        out = out.where(cond)
    return out


def pivot_mean(df: DataFrame, index: str, columns: str, value: str, values: list | None = None,
               digits: int | None = None) -> DataFrame:
    """A4: index x column matrix of means. The columns are the values in the
    data (one distinct job), or ``values``: others are then left out."""
    agg = F.avg(F.col(value))
    if digits is not None:
        agg = F.round(agg, digits)
    return df.groupBy(index).pivot(columns, values).agg(agg)


def bounds(df: DataFrame, col: str) -> tuple[Column, Column]:
    """A7 as scalar subqueries (lazy, one tiny job each at execution)."""
    mm = df.select(F.struct(F.min(F.col(col)).alias("lo"), F.max(F.col(col)).alias("hi")).alias("b"))
    b = mm.scalar()   # one subquery, referenced twice (reused)
    return b["lo"], b["hi"]


def histogram(df: DataFrame, col: str, bins: int, lo=None, hi=None, digits: int = 6) -> DataFrame:
    """A5: equal-width histogram over [lo, hi] (default: data min/max), last
    bin closed, empty bins present. All-equal data widens the range by 0.5
    each side. Output: n_bins, bin, bin_lo, bin_hi, cnt."""
    x = nan_to_null(F.col(col))
    if lo is None and hi is None:
        # one scalar subquery returns the already-widened range, so the many
        # references below point at one small plan
        v = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
        mn, mx = F.min("_x"), F.max("_x")
        b = v.select(F.struct(F.when(mn == mx, mn - 0.5).otherwise(mn).alias("lo"),
                              F.when(mn == mx, mx + 0.5).otherwise(mx).alias("hi"))).scalar()
        lo2, hi2 = b["lo"], b["hi"]
    else:
        if lo is None or hi is None:
            dlo, dhi = bounds(df.select(x.alias("_x")).where(F.col("_x").isNotNull()), "_x")
            lo = dlo if lo is None else F.lit(float(lo))
            hi = dhi if hi is None else F.lit(float(hi))
        else:
            lo, hi = F.lit(float(lo)), F.lit(float(hi))
        same = lo == hi
        lo2 = F.when(same, lo - 0.5).otherwise(lo)
        hi2 = F.when(same, hi + 0.5).otherwise(hi)
    return _binned(df.select(x.alias("_x")), lo2, hi2, bins, F.col("_x"), digits, log=False)


def log_histogram(df: DataFrame, col: str, bins: int, lo_exp: float, hi_exp: float,
                  digits: int = 6) -> DataFrame:
    """``bins`` log-spaced bins between 10**lo_exp and 10**hi_exp; values
    outside the range are not counted (histogram range, as numpy)."""
    x = nan_to_null(F.col(col))
    src = df.select(x.alias("_x")).where(
        (F.col("_x") >= F.lit(10.0 ** lo_exp)) & (F.col("_x") <= F.lit(10.0 ** hi_exp)))
    return _binned(src, F.lit(float(lo_exp)), F.lit(float(hi_exp)), bins,
                   F.log10(F.col("_x")), digits, log=True)


def _binned(src: DataFrame, lo: Column, hi: Column, bins: int, pos: Column, digits: int,
            log: bool) -> DataFrame:
    n = F.lit(bins)
    idx = F.least(F.floor((pos - lo) / (hi - lo) * n).cast("int"), F.lit(bins - 1))
    counts = (src.where(F.col("_x").isNotNull())
              .select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("cnt")))
    spine = src.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edge_lo = lo + (hi - lo) * F.col("bin") / n
    edge_hi = lo + (hi - lo) * (F.col("bin") + 1) / n
    if log:
        edge_lo, edge_hi = F.pow(F.lit(10.0), edge_lo), F.pow(F.lit(10.0), edge_hi)
    return (spine.join(F.broadcast(counts), "bin", "left")
            .select(F.lit(bins).alias("n_bins"), "bin",
                    F.round(edge_lo, digits).alias("bin_lo"), F.round(edge_hi, digits).alias("bin_hi"),
                    F.coalesce(F.col("cnt"), F.lit(0)).cast("long").alias("cnt")))


def correlation(df: DataFrame, a: str, b: str) -> Column:
    """Pearson correlation; NaN treated as missing, nulls skipped pairwise.
    A column without variance has none: null."""
    x, y = nan_to_null(F.col(a)).cast("double"), nan_to_null(F.col(b)).cast("double")
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def factor_table(df: DataFrame, pairs: dict[str, tuple[str, str]], digits: int = 6) -> DataFrame:
    """A8 + A9: one aggregate pass, then stacked to (factor, correlation)."""
    aggs = [F.round(correlation(df, a, b), digits).alias(f"_c{i}") for i, (a, b) in enumerate(pairs.values())]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{name}', _c{i}" for i, name in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (factor, correlation)")


def _between(values: str, n: Column, p: float) -> Column:
    """The quantile ``p`` of a sorted array of ``n`` values, linearly interpolated."""
    pos = F.lit(p) * (n - 1)
    low, high = F.floor(pos), F.ceil(pos)
    at = lambda i: F.get(values, i.cast("int"))
    return F.when(low == high, at(low)).otherwise((high - pos) * at(low) + (pos - low) * at(high))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, ps: list[float], most: int = 100_000,
                    cells: int = 64) -> DataFrame:
    """Keys, ``n`` and ``q0``, ``q1``, ... : the quantiles ``ps`` of every group, linearly interpolated.

    Selection by rank, exact for any values: a group's wanted ranks lie in a range of values, which each
    pass cuts at some ``cells`` approximate quantiles. The rows of every cell, and of every
    cut itself, are counted, and only the cells that hold a wanted rank are kept. Once they have
    at most ``most`` rows, these are sorted. So no task ever holds more of a group than some
    2 * ``cells`` counts, a sketch, or ``most`` values; the passes grow with the logarithm of the largest
    group. Rows with a null value or key take no part.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull()).dropna(subset=keys)
    largest = rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= most:  # every group is small: no need to narrow it down
        whole = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("_v")).alias("_vs"))
        return whole.select(*keys, "n", *[_between("_vs", F.col("n"), p).alias(f"q{i}") for i, p in enumerate(ps)])
    per = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(ps)])
    want = per.withColumn("_w", F.explode(ranks)).withColumn("_pos", F.col("_w.p") * (F.col("n") - 1))
    ends = F.array_distinct(F.array(F.floor("_pos").cast("long"), F.ceil("_pos").cast("long")))
    want = want.withColumns({"_i": F.col("_w.i"), "_at": F.explode(ends), "_below": F.lit(0).cast("long"), "_in": F.col("n")}).drop("_w")
    want = durable(want, "ranks")
    cut_at = [i / cells for i in range(1, cells)]
    bounds = [*keys, "_lo", "_hi"]
    wide = (F.col("_in") > most) & (F.col("_lo") < F.col("_hi"))

    def rows_of(some: DataFrame) -> DataFrame:
        ranges = some.select(*bounds).distinct()
        return rows.join(sized_broadcast(ranges), keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))

    while want.where(wide).limit(1).count():
        open_ = want.where(wide)
        part = rows_of(open_)
        cuts = part.groupBy(*bounds).agg(F.percentile_approx("_v", cut_at, 20 * cells).alias("_cuts"))
        cuts = durable(cuts.withColumn("_cuts", F.sort_array(F.array_distinct("_cuts"))), "cuts")
        part = rows.join(sized_broadcast(cuts), keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        upto = F.size(F.filter("_cuts", lambda c: c <= F.col("_v")))  # a cell of its own for each cut, and one after it
        part = part.withColumn("_cell", 2 * upto - (F.array_contains("_cuts", F.col("_v"))).cast("int"))
        found = part.groupBy(*bounds, "_cell").agg(F.count("*").alias("_m"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        before = Window.partitionBy(*bounds).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn("_before", F.coalesce(F.sum("_m").over(before), F.lit(0)))
        here = F.col("_at") - F.col("_below") - F.col("_before")
        inner = open_.join(found, bounds).where((here >= 0) & (here < F.col("_m")))
        inner = inner.withColumns({"_below": F.col("_below") + F.col("_before"), "_in": F.col("_m")}).drop("_lo", "_hi")
        inner = inner.withColumnsRenamed({"_min": "_lo", "_max": "_hi"}).select(*want.columns)
        want = durable(want.where(~wide).unionByName(inner), "ranks")
    few = want.where(F.col("_lo") < F.col("_hi"))
    values = rows_of(few).groupBy(*bounds).agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
    want = want.join(values, bounds, "left").withColumn("_x", F.coalesce(F.get("_vs", (F.col("_at") - F.col("_below")).cast("int")), F.col("_lo")))
    whole = F.floor("_pos") == F.ceil("_pos")
    share = F.when(whole, 1.0).when(F.col("_at") == F.floor("_pos"), F.ceil("_pos") - F.col("_pos")).otherwise(F.col("_pos") - F.floor("_pos"))
    return want.groupBy(*keys, "n").agg(*[F.sum(F.when(F.col("_i") == i, share * F.col("_x"))).alias(f"q{i}") for i in range(len(ps))])


def box_summary(df: DataFrame, keys: list[str], value: str, exact: bool = True,
                accuracy: int = 10_000, digits: int = 6, most: int = 100_000) -> DataFrame:
    """A10: quartiles (linear interpolation), whiskers at 1.5 IQR (most extreme
    data inside the fences), outlier count, per group.

    ``exact`` selects the quartiles by rank (``exact_quantiles``, at most ``most`` values of a
    group in one task); ``exact=False`` uses ``percentile_approx`` (bounded sketch).
    """
    v = nan_to_null(F.col(value))
    base = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    if exact:
        qs = exact_quantiles(base, keys, "_v", [0.25, 0.5, 0.75], most)
        qs = qs.select(*keys, "n", *[F.col(f"q{i}").alias(c) for i, c in enumerate(["q1", "median", "q3"])])
    else:
        q = F.percentile_approx(F.col("_v"), [0.25, 0.5, 0.75], accuracy)
        qs = base.groupBy(*keys).agg(q.alias("_q"), F.count(F.lit(1)).alias("n")).select(
            *keys, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
            F.col("_q")[2].alias("q3"))
    qs = qs.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
           .withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    j = base.join(sized_broadcast(qs.select(*keys, "_lo", "_hi")), keys)
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    w = j.groupBy(*keys).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("long").alias("n_outliers"))
    out = qs.drop("_lo", "_hi").join(w, keys)
    return out.select(*keys, "n", *[F.round(F.col(c), digits).alias(c)
                                    for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]],
                      "n_outliers")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A11."""
    return df.select(col).distinct()


def categories(df: DataFrame, col: str, most: int = 1000) -> list:
    """The non-null values of a categorical column in order; more than
    ``most`` raise an error, as each becomes a column."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{col} has more than {most} values")
    return sorted(r[0] for r in rows)


def bounding_box(df: DataFrame, cols: list[str]) -> list[Column]:
    """min/max of each column as aggregate expressions."""
    out = []
    for c in cols:
        out += [F.min(F.col(c)).alias(f"min_{c}"), F.max(F.col(c)).alias(f"max_{c}")]
    return out


def global_index(df: DataFrame, order: list[str], name: str = "_idx") -> DataFrame:
    """0-based position of each row in ``order`` without a single-partition
    window: range-partitioned sort, position inside each partition from
    ``monotonically_increasing_id``, plus the row count of all earlier
    partitions (a table of one row per partition, broadcast).

    ``order`` must be a total order (add a unique column). The sorted rows are
    written to the shared folder once and both the counts and the positions are
    taken from there, so they see one partitioning whatever the optimiser does."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) for c in order]
    parts = durable(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                    .withColumn("_pid", F.spark_partition_id().cast("long"))
                    .withColumn("_mid", F.monotonically_increasing_id()), "index")
    counts = parts.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = parts.join(F.broadcast(offsets), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return out.withColumn(name, F.col("_off") + local).drop("_pid", "_mid", "_off")


def factorize(df: DataFrame, col: str, order: list[str], out: str | None = None,
              null_code: int = -1) -> DataFrame:
    """Integer code per category by first appearance in ``order``;
    null -> ``null_code``. The dictionary is built from per-category minima
    (map-side combined) and ranked with a distributed index."""
    out = out or f"{col}_code"
    first = (df.where(F.col(col).isNotNull())
             .groupBy(col).agg(F.min(F.struct(*[F.col(c) for c in order])).alias("_first")))
    first = first.select(col, *[F.col(f"_first.{c}").alias(f"_f{i}") for i, c in enumerate(order)])
    codes = global_index(first, [f"_f{i}" for i in range(len(order))] + [col], "_code")
    codes = codes.select(col, F.col("_code").alias(out))
    j = df.join(sized_broadcast(codes), col, "left")
    return j.select(*df.columns, F.coalesce(F.col(out), F.lit(null_code).cast("long")).alias(out))
