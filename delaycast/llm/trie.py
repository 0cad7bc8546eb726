"""A prefix trie of conversations, with totals of every subtree by depth bands.

A node is a distinct sequence of first turns; its key adds up, over the turns,
128 bits of a hash of (place, role, text), so the keys of all prefixes of a
conversation are running sums, also where one conversation is cut into many
blocks. Subtree totals: the levels are cut into bands of fixed height. Every node
explodes to its ancestors within its own band only; the roots of the bands form
a tree that is lower by that factor, whose totals are found in the same way, and
the finished total of a band's root is handed to its parent in the band above.
So a node makes at most `height` rows and the rounds grow with the logarithm of
the greatest depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kit import lean, stored

#: Turns of a block of running sums, ids of a piece of a hashed list.
BLOCK, IDS = 1024, 4096
LIMBS = ["s0", "s1", "s2", "s3"]
KEY = ["k1", "k2"]


def ordered(turns: DataFrame, by: list[str]) -> DataFrame:
    """`turns` with `i`, the place (from 1) in its conversation in the order `by`, which ends in a column of distinct
    values. The rows are sorted over all tasks, so one conversation may span many of them."""
    spread = stored(turns.repartitionByRange("conv", *by).withColumn("task", F.spark_partition_id()), "turns")
    within = Window.partitionBy("conv", "task").orderBy(*by)
    before = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = spread.groupBy("conv", "task").agg(F.count("*").alias("m"))
    sizes = sizes.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
    rows = spread.withColumn("i", F.row_number().over(within).cast("long"))
    return rows.join(sizes.drop("m"), ["conv", "task"]).withColumn("i", F.col("i") + F.col("before")).drop("before", "task")


def running(rows: DataFrame) -> DataFrame:
    """Keys k1, k2 of the prefix that ends in each row (conv, d, digest), and p1, p2 of the one before it."""
    halves = [F.xxhash64("d", "digest", F.lit(salt)) for salt in (1, 2)]
    parts = [x for h in halves for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    rows = rows.withColumns(dict(zip(LIMBS, parts))).withColumn("block", F.floor((F.col("d") - 1) / BLOCK))
    within = Window.partitionBy("conv", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(*[F.sum(c).alias(c) for c in LIMBS])
    blocks = blocks.select("conv", "block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b{c}") for c in LIMBS])
    rows = rows.withColumns({f"t{c}": F.sum(c).over(within) for c in LIMBS}).join(blocks, ["conv", "block"])

    def packed(high: Column, low: Column) -> Column:
        mask = F.lit(0xFFFFFFFF)
        return F.shiftleft(high.bitwiseAND(mask), 32).bitwiseOR(low.bitwiseAND(mask))

    upto = {c: F.col(f"t{c}") + F.col(f"b{c}") for c in LIMBS}
    prior = {c: upto[c] - F.col(c) for c in LIMBS}
    return rows.select("conv", "d", "cps", packed(upto["s0"], upto["s1"]).alias("k1"), packed(upto["s2"], upto["s3"]).alias("k2"),
                       packed(prior["s0"], prior["s1"]).alias("p1"), packed(prior["s2"], prior["s3"]).alias("p2"))


def totals(paths: DataFrame, own: DataFrame, values: list[str], deepest: int, height: int) -> DataFrame:
    """Key and the sums of `values` over the subtree of each row of `own` (key, conv, d, values).

    `paths` has (conv, d, key) of the prefixes of every conversation that names a row of `own`.
    """
    band = F.floor(F.col("d") / height)
    chains = paths.groupBy("conv", band.alias("band")).agg(F.sort_array(F.collect_list(F.struct("d", *KEY))).alias("chain"))
    rows = own.withColumn("band", band).join(chains, ["conv", "band"])
    rows = stored(rows.select(*KEY, "d", *values, F.slice("chain", 1, (F.col("d") % height + 1).cast("int")).alias("up")), "bands")
    if deepest >= height:
        root = F.get("up", F.lit(0))
        pieces = rows.groupBy(*[root[k].alias(k) for k in KEY]).agg(*[F.sum(v).alias(v) for v in values])
        tops = own.where(F.col("d") % height == 0).select(*KEY, "conv", "d").join(pieces, KEY)
        lower = tops.withColumn("d", F.floor(F.col("d") / height))
        below = totals(paths.where(F.col("d") % height == 0).withColumn("d", F.floor(F.col("d") / height)), lower, values, deepest // height, height)
        before = paths.select("conv", (F.col("d") + 1).alias("d"), F.struct(*KEY).alias("above"))
        below = below.join(tops.select(*KEY, "conv", "d").join(before, ["conv", "d"]).select(*KEY, "above"), KEY)
        below = below.groupBy(*[F.col("above")[k].alias(k) for k in KEY]).agg(*[F.sum(v).alias(f"more_{v}") for v in values])
        rows = rows.join(below, KEY, "left").withColumns({v: F.col(v) + F.coalesce(f"more_{v}", F.lit(0)) for v in values})
    each = rows.select(F.explode("up").alias("up"), *values)
    return each.groupBy(*[F.col("up")[k].alias(k) for k in KEY]).agg(*[F.sum(v).alias(v) for v in values])


def listed(ends: DataFrame) -> DataFrame:
    """Key and the SHA-256 of the ids (conv) of each key, ascending and joined by commas.

    The ids are sorted over all tasks, each of which joins its share of a key into texts of up to IDS ids; the hash of
    a key then runs over its texts in order, one at a time.
    """
    def joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            k = f[KEY].to_numpy()
            cuts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])
            cuts = np.concatenate([np.arange(a, b, IDS) for a, b in zip(cuts, [*cuts[1:], len(f)])])
            ids = f["conv"].astype(str).to_numpy()
            yield pd.DataFrame({"k1": k[cuts, 0], "k2": k[cuts, 1], "first": f["conv"].to_numpy()[cuts],
                                "text": [",".join(ids[a:b]) for a, b in zip(cuts, [*cuts[1:], len(f)])]})

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for f in frames:
            out = []
            for k1, k2, text in zip(f["k1"], f["k2"], f["text"]):
                if (k1, k2) == key:
                    state.update(b"," + text.encode())
                    continue
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(text.encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends"])
        if key is not None:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "ends"])

    spread = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    pieces = spread.mapInPandas(lean(joined), "k1 long, k2 long, first long, text string")
    pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return pieces.mapInPandas(lean(hashed), "k1 long, k2 long, ends string")


def rebuilt(turns: DataFrame, donors: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv, own), and the turns (conv, d, digest, cps) of each as the trie takes them.

    Conversation c starts with the first h turns of conversation c - c % `donors` and goes on with its own turns after
    its first h; h is the CRC-32 of c as text, modulo `most`. Turns go by turn (null first), then role and text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("digest"),
        F.length(text).cast("long").alias("cps"), F.monotonically_increasing_id().alias("row"))
    rows = stored(ordered(rows, ["turn", "digest", "row"]).select("conv", "i", "digest", "cps"), "ordered")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = rows.groupBy("conv").agg(F.max("i").alias("own")).withColumns({"h": h, "donor": F.col("conv") - F.col("conv") % donors})
    given = rows.where((F.col("conv") % donors == 0) & (F.col("i") < most))
    first = convs.join(given.select(F.col("conv").alias("donor"), "i", "digest", "cps"), "donor").where("i <= h")
    first = first.select("conv", F.col("i").alias("d"), "digest", "cps")
    sizes = given.groupBy(F.col("conv").alias("donor")).agg(F.max("i").alias("has"))
    convs = convs.join(sizes, "donor", "left").select("conv", "own", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("taken"))
    rest = rows.join(convs, "conv").where("i > h").select("conv", (F.col("taken") + F.col("i") - F.col("h")).alias("d"), "digest", "cps")
    return convs.select("conv", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns")), first.unionByName(rest)


def nodes(turns: DataFrame, height: int = 8) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (see `rebuilt`) of `turns` (conv_id, turn, role, text):
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; a null turn comes first, turns of equal number and text are turns of their own, in
    any order, as they are equal; rows without a conv_id belong to no conversation and are left out; other columns do
    not matter. An empty table has no nodes, not even a root.
    """
    convs, rows = rebuilt(turns)
    paths = stored(running(rows).unionByName(convs.select(
        "conv", F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("cps"), *[F.lit(0).cast("long").alias(k) for k in (*KEY, "p1", "p2")])), "paths")
    found = paths.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("d").alias("d"),
                                    F.max("cps").alias("cps"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    found = stored(found, "nodes")
    children = found.where("d > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    own = found.join(children, KEY, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "saved": (F.col("n_convs") - 1) * F.col("cps")})
    own = stored(own.withColumn("leaves", (F.col("n_children") == 0).cast("long")), "own")
    deepest = own.agg(F.max("d")).first()[0] or 0
    summed = totals(paths.select("conv", "d", *KEY), own.select(*KEY, "conv", "d", "leaves", "saved"), ["leaves", "saved"], deepest, height)
    ends = listed(paths.join(convs.withColumnRenamed("turns", "d"), ["conv", "d"]).select(*KEY, "conv"))
    parents = found.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv").alias("parent_conv_id"))
    out = own.join(summed.select(*KEY, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), KEY).join(ends, KEY, "left")
    out = out.join(parents, (F.col("d") > 0) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")), "left")
    return out.select(F.col("conv").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def nodes_sql() -> str:
    """DuckDB SQL for `nodes` of the table conversations; joins every node to all its ancestors, so for small tables."""
    crc = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
             lambda acc, b: list_reduce(list_concat([xor(acc, b)], [0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT]),
             lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)), 4294967295::UBIGINT)"""
    return f"""
        WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                              row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
                       FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT conv_id, max(i) AS own, ({crc} % 6)::BIGINT AS h, conv_id - conv_id % 100 AS donor FROM turns GROUP BY conv_id),
        sized AS (SELECT c.*, least(c.h, coalesce(d.own, 0)) AS taken FROM convs c LEFT JOIN convs d ON d.conv_id = c.donor),
        rebuilt AS (SELECT s.conv_id, t.i AS d, role, text FROM sized s JOIN turns t ON t.conv_id = s.donor AND t.i <= s.h
                    UNION ALL SELECT s.conv_id, s.taken + t.i - s.h, role, text FROM sized s JOIN turns t ON t.conv_id = s.conv_id AND t.i > s.h),
        paths AS (SELECT conv_id, d, length(text) AS cps, string_agg(sha256(length(role) || ':' || role || text), '')
                         OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS node FROM rebuilt
                  UNION ALL SELECT conv_id, 0, 0, '' FROM sized),
        nodes AS (SELECT node, min(conv_id) AS conv_id, d, any_value(cps) AS cps, count(*) AS n_convs FROM paths GROUP BY node, d),
        linked AS (SELECT n.*, p.conv_id AS parent, p.node AS above FROM nodes n
                   LEFT JOIN nodes p ON n.d > 0 AND p.node = left(n.node, 64 * (n.d - 1)::BIGINT)),
        children AS (SELECT above AS node, count(*) AS n FROM linked WHERE above IS NOT NULL GROUP BY above),
        own AS (SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c USING (node)),
        totals AS (SELECT p.node, sum((o.n_children = 0)::BIGINT) AS n_leaves, sum((o.n_convs - 1) * o.cps) AS saved
                   FROM own o JOIN paths p ON p.conv_id = o.conv_id AND p.d <= o.d GROUP BY p.node),
        ends AS (SELECT p.node, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids FROM paths p
                 JOIN (SELECT conv_id, max(d) AS d FROM paths GROUP BY conv_id) m USING (conv_id, d) GROUP BY p.node)
        SELECT o.conv_id, o.d::BIGINT AS depth, o.parent AS parent_conv_id, o.n_convs, o.n_children, t.n_leaves::BIGINT AS n_leaves,
               t.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
        FROM own o JOIN totals t USING (node) LEFT JOIN ends e USING (node)"""
