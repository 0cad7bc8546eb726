"""Mixing sources to target weights by Pfair scheduling. DataFrame functions only.

The documents of a source, in hash order, are cut into blocks of about
`block_chars` characters. A source of weight w among weights that sum to W has
block k released at slot floor(k W / w) and due by slot ceil((k + 1) W / w);
earliest deadline first then gives every block a slot in its window, so that
after any number of slots each source is less than one block from its share.
The schedule of the weights repeats every W slots and does not depend on data.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kit import spared

#: The name under which all sources without a weight of their own share one.
OTHERS = "*"


def pfair(weights: list[int]) -> list[list[int]]:
    """The slots of each source's blocks within one period of sum(weights) slots."""
    period, done = sum(weights), [0] * len(weights)
    slots: list[list[int]] = [[] for _ in weights]
    for t in range(period):
        _, i = min((-(-(done[i] + 1) * period // w), i) for i, w in enumerate(weights) if w and done[i] * period // w <= t)
        done[i] += 1
        slots[i].append(t)
    return slots


def cell_digits(rows: int, cell_rows: int) -> int:
    """Hex digits of the hash that name a cell, so that a cell has about `cell_rows` rows at most."""
    return max(1, math.ceil(math.log(max(1, rows / cell_rows), 16)))


def mix(docs: DataFrame, weights: dict[str, int], others: int = 1, block_chars: int = 100_000,
        cell_rows: int = 20_000, size: str | None = None, ties: str | None = None) -> DataFrame:
    """All rows of `docs` with mix_source, mix_start (characters of the source before
    it), mix_block and mix_slot; read them by (mix_slot, mix_start).

    `weights`: positive whole numbers by source; any other source, a null one
    too, is part of OTHERS with weight `others`. Blocks of a source that has
    ended leave their slots empty, so the rest keep their relative weights; no
    row is dropped or repeated. A null text has no characters. Rows of one id
    are ordered by length and text hash; equal rows in any order. Columns of
    `docs` that are named like the new ones are replaced. `size` and `ties`
    name columns that hold the length and the hash, if there is no column text.

    A source is numbered in cells of hash prefixes, so a source that holds a
    third of all rows is many window partitions, and only the cells' sums are
    added up in order.
    """
    names = [*weights, OTHERS]
    slots = pfair([*weights.values(), others])
    period = sum(map(len, slots))
    docs = docs.drop("mix_source", "mix_start", "mix_block", "mix_slot")
    docs, named = spared(docs, ["_h", "_cell", "_n", "_sum", "_before", "_t"])
    rows = docs.withColumns({
        "mix_source": F.when(F.col("source").isin(*weights) & (F.col("source") != OTHERS), F.col("source")).otherwise(F.lit(OTHERS)) if weights else F.lit(OTHERS),
        "_h": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
        "_n": F.coalesce(F.length("text") if size is None else F.col(size), F.lit(0)).cast("long"),
        "_t": F.xxhash64("text") if ties is None else F.col(ties),
    })
    digits = cell_digits(docs.count(), cell_rows)
    rows = rows.withColumn("_cell", F.substring("_h", 1, digits))
    cells = rows.groupBy("mix_source", "_cell").agg(F.sum("_n").alias("_sum"))
    before = Window.partitionBy("mix_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("mix_source", "_cell", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("mix_source", "_cell").orderBy("_h", "doc_id", "_n", "_t").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_sum", F.sum("_n").over(within)).join(cells, ["mix_source", "_cell"])
    rows = rows.withColumn("mix_start", F.col("_before") + F.col("_sum") - F.col("_n"))
    rows = rows.withColumn("mix_block", F.floor(F.col("mix_start") / F.lit(block_chars)).cast("long"))
    own = F.element_at(F.create_map(*[F.lit(x) for n, s in zip(names, slots) for x in (n, s)]), F.col("mix_source"))
    turn = F.size(own).cast("long")
    slot = F.floor(F.col("mix_block") / turn) * period + F.get(own, F.pmod("mix_block", turn).cast("int"))
    rows = rows.withColumn("mix_slot", slot.cast("long"))
    return named(rows.select(*docs.columns, "mix_source", "mix_start", "mix_block", "mix_slot"))


def mixed_sql(weights: dict[str, int], others: int, block_chars: int) -> str:
    """DuckDB SQL for doc_id, mix_source, mix_start, mix_block and mix_slot of the table documents."""
    names, slots = [*weights, OTHERS], pfair([*weights.values(), others])
    period = sum(map(len, slots))
    named = ", ".join(f"'{n}'" for n in weights)
    values = ", ".join(f"('{n}', {len(s)}, {r}, {t})" for n, s in zip(names, slots) for r, t in enumerate(s))
    return f"""
        WITH plan(name, turns, turn, slot) AS (VALUES {values}),
        rows AS (SELECT doc_id, CASE WHEN source IN ({named}) THEN source ELSE '{OTHERS}' END AS mix_source,
                        coalesce(length(text), 0) AS n, md5(doc_id::VARCHAR) AS h FROM documents),
        placed AS (SELECT *, (sum(n) OVER (PARTITION BY mix_source ORDER BY h ROWS UNBOUNDED PRECEDING) - n)::BIGINT AS mix_start FROM rows),
        blocks AS (SELECT *, mix_start // {block_chars} AS mix_block FROM placed)
        SELECT doc_id, mix_source, mix_start, mix_block::BIGINT AS mix_block,
               ((mix_block // turns) * {period} + slot)::BIGINT AS mix_slot
        FROM blocks JOIN plan ON name = mix_source AND turn = mix_block % turns"""
