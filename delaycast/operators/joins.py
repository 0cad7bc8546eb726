"""Joins (J1-J9): hour-bucket enrichment, shifted self join, as-of lookup.

No join here emits all pairs of a group: the enrichment side is reduced to one
row per bucket before the join (many-to-one), the label join is one-to-one
after the keyed dedup, and the "next row at or after t" lookup is a sorted
forward-fill over the union of both sides, not a join + filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeops import US_PER_S, epoch_micros, shift
from .dedup import latest_by_key

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (file sizes and column widths)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())
    except Exception:  # not available (e.g. remote session)
        return None


def sized_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the estimated size is below ``max_bytes``;
    otherwise the frame is returned as is and the planner/AQE picks a
    shuffle join (AQE still converts it at run time if it turns out small)."""
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Fact-dimension equi join, dimension broadcast behind a size check."""
    return fact.join(sized_broadcast(dim, max_broadcast_bytes), on, how)


# A group counts as heavy only if it holds more than one in MAX_HEAVY of all
# rows, so a table of heavy groups has fewer rows than this at any input size.
MAX_HEAVY = 100_000


def free_name(base: str, *columns: list[str]) -> str:
    """``base`` with underscores in front until none of ``columns`` holds it (case ignored, as Spark does)."""
    taken = {c.lower() for cols in columns for c in cols}
    while base.lower() in taken:
        base = "_" + base
    return base


def row_hash(df: DataFrame):
    """Hash of a whole row (map columns apart, which Spark can't hash): the same after a lost task is run again."""
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("bigint")


def heavy_groups(counts: DataFrame, n: str, limit: int) -> DataFrame:
    """Rows of ``counts`` (one row a group, its rows in column ``n``) above ``limit`` rows and above
    one in ``MAX_HEAVY`` of all: fewer than ``MAX_HEAVY`` rows, so safe to broadcast whatever the input."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("t")).scalar()
    return counts.where((F.col(n) > F.lit(limit)) & (F.col(n) * F.lit(MAX_HEAVY) > total))


def join_buckets(left: DataFrame, red: DataFrame, left_key: str, red_key: str,
                 max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                 max_rows_per_bucket: int = 2_000_000) -> DataFrame:
    """Left outer join of many rows to a table with one row per bucket.

    A table of at most ``max_broadcast_bytes`` (by Catalyst's estimate) is broadcast. Beyond that it is a
    shuffle join that no heavy bucket holds up: a first map-side-combined count finds the buckets of more
    than ``max_rows_per_bucket`` left rows; only their left rows are spread over ``ceil(rows / limit)``
    places by a hash of the row, and only their right rows are repeated once per place. Rows with a null
    bucket match nothing and are spread by the same hash. The rows do not depend on the way taken; rows
    that equal each other in every column share a place (AQE's skew split is left for them).
    On a streaming ``left`` no count is possible: plain join.
    """
    size = estimated_bytes(red)
    if left.isStreaming or (size is not None and size <= max_broadcast_bytes):
        red = red if left.isStreaming else F.broadcast(red)
        return left.join(red, left[left_key] == red[red_key], "left").drop(red[red_key])
    names = left.columns + red.columns
    hk, hn, place = (free_name(x, names) for x in ("_heavy_key", "_heavy_places", "_place"))
    counts = left.where(F.col(left_key).isNotNull()).groupBy(F.col(left_key).alias(hk)) \
                 .agg(F.count(F.lit(1)).alias(hn))
    heavy = F.broadcast(heavy_groups(counts, hn, max_rows_per_bucket).select(
        hk, F.ceil(F.col(hn) / F.lit(max_rows_per_bucket)).cast("bigint").alias(hn)))
    spread = row_hash(left)
    rows = left.join(heavy, F.col(left_key) == F.col(hk), "left").withColumn(
        place, F.when(F.col(left_key).isNull(), spread)
        .otherwise(F.coalesce(F.pmod(spread, F.col(hn)), F.lit(0).cast("bigint")))).drop(hk, hn)
    rep = red.join(heavy, F.col(red_key) == F.col(hk), "left").withColumn(
        place + "s", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                          F.coalesce(F.col(hn), F.lit(1).cast("bigint")) - 1))).drop(hk, hn)
    out = rows.join(rep, (F.col(left_key) == F.col(red_key)) & (F.col(place) == F.col(place + "s")), "left")
    return out.drop(red_key, place, place + "s")


def bucket_enrich(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  right_cols: list[str], prefix: str, mode: str = "latest",
                  order: list[str] | None = None,
                  max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                  max_rows_per_bucket: int = 2_000_000) -> DataFrame:
    """J1/J2 (batch form): left outer equi join on a time bucket.

    The right feed is first reduced to one row per bucket - ``latest`` row by
    ``order`` (max_by, combined map-side) or ``mean`` of each column with a
    row count - so the join is many-to-one and output rows == left rows.
    Output columns of the right side are ``prefix + name``. Heavy buckets: ``join_buckets``.
    """
    bk = free_name("_bk", left.columns)
    if mode == "latest":
        if not order:
            raise ValueError("mode='latest' needs an order")
        cols = list(dict.fromkeys(right_cols + order))
        red = latest_by_key(right.select(right_key, *cols), [right_key], order)
        red = red.select(F.col(right_key).alias(bk),
                         *[F.col(c).alias(prefix + c) for c in right_cols])
    elif mode == "mean":
        red = right.groupBy(F.col(right_key).alias(bk)).agg(
            F.count(F.lit(1)).alias(prefix + "n"),
            *[F.avg(F.col(c)).alias(prefix + c) for c in right_cols])
    else:
        raise ValueError(mode)
    return join_buckets(left, red, left_key, bk, max_broadcast_bytes, max_rows_per_bucket)


def bucket_enrich_multi(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                        feeds: dict, mode: str = "latest",
                        max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                        max_rows_per_bucket: int = 2_000_000) -> DataFrame:
    """J1 + J2 in one pass: several feeds that share one source (e.g. one
    table or topic holding observations and forecasts) are reduced per
    bucket by ONE aggregation - a conditional ``max_by`` (or mean/count) per
    feed; a row of another feed has a null ordering and is ignored - then
    joined once. ``feeds``: prefix -> (condition Column, value cols, order
    cols). One scan and one shuffle of the source instead of one per feed. Heavy buckets: ``join_buckets``."""
    bk = free_name("_bk", left.columns)
    aggs, out = [], []
    for prefix, (cond, cols, order) in feeds.items():
        if mode == "latest":
            pay = F.when(cond, F.struct(*[F.col(c) for c in cols]))
            aggs.append(F.max_by(pay, F.when(cond, F.struct(*[F.col(c) for c in order]))).alias(prefix))
            out += [F.col(f"{prefix}.{c}").alias(prefix + c) for c in cols]
        elif mode == "mean":
            aggs.append(F.count(F.when(cond, F.lit(1))).alias(prefix + "n"))
            aggs += [F.avg(F.when(cond, F.col(c))).alias(prefix + c) for c in cols]
            out += [F.when(F.col(prefix + "n") > 0, F.col(prefix + "n")).alias(prefix + "n")] + \
                   [F.col(prefix + c) for c in cols]
        else:
            raise ValueError(mode)
    red = right.groupBy(F.col(right_key).alias(bk)).agg(*aggs).select(bk, *out)
    return join_buckets(left, red, left_key, bk, max_broadcast_bytes, max_rows_per_bucket)


def shift_self_join(df: DataFrame, keys: list[str], time_col: str, shift_seconds: float,
                    value_cols: list[str], suffix: str = "_15min") -> DataFrame:
    """Each row joined (inner) to the row of the same keys at
    ``time + shift``. ``df`` must be unique per ``keys + [time_col]`` (D3
    first), so the join is one-to-one."""
    left = df.withColumn("_tk", shift(F.col(time_col), shift_seconds))
    right = df.select(*keys, F.col(time_col).alias("_tk"),
                      *[F.col(c).alias(c + suffix) for c in value_cols])
    return left.join(right, keys + ["_tk"], "inner").drop("_tk")


_SENTINEL = (1 << 63) - 1
# Quantiles taken of a heavy group; it is cut at as many of them as its size asks for.
SPLITS = 1024


def floor_div_col(x, w):
    """Exact floor division by a (positive) bigint width."""
    return ((x - F.pmod(x, w)) / w).cast("bigint")


def count_at_most(sorted_array, x, most: int):
    """How many items of an ascending array (at most ``most``) are <= ``x``: binary search by halving steps."""
    steps = [1 << i for i in reversed(range(most.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda lo, s: F.when((lo + s <= F.size(sorted_array)) & (F.try_element_at(sorted_array, lo + s) <= x), lo + s)
        .otherwise(lo))


def depth_cuts(rows: DataFrame, groups: list[str], value: str, max_rows: int) -> DataFrame:
    """Cuts of equal depth for the groups of ``rows`` with more than ``max_rows`` rows: columns ``groups``,
    ``_cuts`` (ascending different values) and ``_many`` (those that take more than one cut by
    themselves: value -> number of cuts), fewer than ``MAX_HEAVY`` rows.

    One map-side-combined count finds the groups, a second pass over their rows alone takes ``SPLITS``
    approximate quantiles (rank error a small part of a piece) and keeps those that stand about
    ``max_rows / 4`` rows apart. A group of more than ``SPLITS / 4 * max_rows`` rows is cut into ``SPLITS`` pieces.
    """
    heavy = F.broadcast(heavy_groups(rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")), "_n", max_rows))
    q = ", ".join(f"{i / SPLITS!r}D" for i in range(1, SPLITS))        # one text: 1,023 literals take a second to build
    cuts = rows.join(heavy, groups).groupBy(*groups).agg(
        F.expr(f"percentile_approx(`{value}`, array({q}), {8 * SPLITS})").alias("_q"), F.max("_n").alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.lit(float(SPLITS) / 4 * max_rows) / F.col("_n"))).cast("int")
    picked = F.filter("_q", lambda x, i: (i + 1) % F.least(step, F.lit(SPLITS // 4)) == 0)
    cuts = cuts.select(*groups, picked.alias("_q")).withColumn("_cuts", F.array_distinct("_q"))
    times = F.transform("_cuts", lambda v: F.struct(
        v.alias("v"), F.size(F.filter("_q", lambda x: x == v)).alias("n")))
    return cuts.select(*groups, "_cuts", F.map_from_entries(F.filter(times, lambda e: e["n"] > 1)).alias("_many"))


def asof_next(left: DataFrame, right: DataFrame, keys: list[str], left_time: str,
              right_time: str, right_cols: list[str], tiebreak: list[str],
              prefix: str = "next_", bucket_seconds: int = 86_400,
              max_rows_per_bucket: int = 2_000_000) -> DataFrame:
    """J6 core: for every left row, the first right row with equal ``keys``
    and ``right_time >= left_time`` (ties broken by ``tiebreak`` ascending).

    Skew-safe shape: of right rows of one key and time only the first by ``tiebreak`` is kept (map-side
    combined). Rows are split by (keys, time bucket). Inside a bucket a descending running
    ``last(ignorenulls)`` forward-fills the nearest right row. For left rows whose bucket holds no
    later right row a "carry" (the first right row of the next non-empty bucket) is injected, computed
    from per-bucket minima with a window over the small (key, bucket) table. Every left row is kept
    (left outer); a null key or time finds nothing.

    A bucket of more than ``max_rows_per_bucket`` rows is cut into pieces of equal depth
    (``depth_cuts``), however its rows lie in time. A single time that takes several pieces by itself is
    a piece of its own: all its left rows have the same answer, the first right row from that time on,
    so they are spread by a hash of the row and each part gets that answer as its carry. Left rows that
    equal each other in every column share a part.
    """
    w_us = bucket_seconds * US_PER_S
    lt = epoch_micros(F.col(left_time))
    rt = epoch_micros(F.col(right_time))
    lcols = left.columns
    rpay = F.struct(F.col(right_time).alias("_time"), *[F.col(c).alias(c) for c in right_cols])
    rorder = F.struct(*[F.col(c) for c in tiebreak])

    valid = F.lit(True)
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    lvalid = valid & F.col(left_time).isNotNull()

    kc = [f"_k{i}" for i in range(len(keys))]
    kcols = [F.col(k).alias(c) for k, c in zip(keys, kc)]
    day = floor_div_col(F.col("_t"), F.lit(w_us))
    L = left.where(lvalid).select(*kcols, lt.alias("_t"), row_hash(left).alias("_h"),
                                  F.struct(*[F.col(c) for c in lcols]).alias("_l")).withColumn("_b", day)
    R = right.where(valid & F.col(right_time).isNotNull()).select(
        *kcols, rt.alias("_t"), rpay.alias("_r"), rorder.alias("_o"))
    every = L.select(*kc, "_b", "_t").unionByName(R.select(*kc, day.alias("_b"), "_t"))
    R = R.groupBy(*kc, "_t").agg(F.min_by("_r", "_o").alias("_r")).withColumn("_b", day)

    # the place of a row: bucket _b, piece _p (even: one time only; odd: between two cuts), part _s of its left rows
    groups = kc + ["_b"]
    cuts = F.broadcast(depth_cuts(every, groups, "_t", max_rows_per_bucket))
    at = count_at_most(F.col("_cuts"), F.col("_t"), SPLITS)
    own = F.try_element_at("_many", F.col("_t"))

    def place(df: DataFrame, part) -> DataFrame:
        df = df.join(cuts, groups, "left").withColumn("_own", own)
        return df.withColumn("_p", F.when(F.col("_cuts").isNull(), F.lit(1))
                             .otherwise(2 * at + F.when(F.col("_own").isNull(), 1).otherwise(0))) \
                 .withColumn("_s", F.when(F.col("_own").isNull(), F.lit(0).cast("bigint")).otherwise(part)) \
                 .drop("_cuts", "_many", "_own")

    L = place(L, F.pmod(F.col("_h"), 2 * F.col("_own") + 1)).drop("_h")
    R = place(R, F.lit(-1).cast("bigint"))
    groups = groups + ["_p", "_s"]

    # per-bucket first right row, and the buckets that hold left rows; a mark of kind 0 takes the next
    # bucket's row (its own are in its window), one of kind 2 its own bucket's too
    rb = R.groupBy(*groups).agg(F.min_by("_r", "_t").alias("_m")).withColumn("_kind", F.lit(1))
    lb = L.select(*groups).distinct().withColumn("_kind", F.when(F.col("_p") % 2 == 0, 2).otherwise(0))
    marks = rb.unionByName(lb, allowMissingColumns=True)
    wb = (Window.partitionBy(*kc).orderBy(F.col("_b").desc(), F.col("_p").desc(), F.col("_kind").asc())
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = (marks.withColumn("_c", F.last("_m", ignorenulls=True).over(wb))
             .where((F.col("_kind") != 1) & F.col("_c").isNotNull())
             .select(*groups, F.lit(_SENTINEL).alias("_t"), F.col("_c").alias("_r"), F.lit(0).alias("_side")))

    rows = (L.withColumn("_side", F.lit(1))
            .unionByName(R.where(F.col("_s") == 0).withColumn("_side", F.lit(0)), allowMissingColumns=True)
            .unionByName(carry, allowMissingColumns=True))
    w = (Window.partitionBy(*groups).orderBy(F.col("_t").desc(), F.col("_side").asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hit = rows.withColumn("_hit", F.last("_r", ignorenulls=True).over(w)).where(F.col("_side") == 1)
    matched = hit.select(*[F.col(f"_l.{c}").alias(c) for c in lcols],
                         F.col("_hit._time").alias(prefix + right_time),
                         *[F.col(f"_hit.{c}").alias(prefix + c) for c in right_cols])
    unmatched = left.where(~lvalid).select(
        *lcols, F.lit(None).cast(right.schema[right_time].dataType).alias(prefix + right_time),
        *[F.lit(None).cast(right.schema[c].dataType).alias(prefix + c) for c in right_cols])
    return matched.unionByName(unmatched)
