"""Parse, flatten and project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ._util import as_col


def bytes_to_text(c) -> Column:
    """Message value bytes -> text."""
    return as_col(c).cast("string")


def parse_json(df: DataFrame, text_col: str, schema: StructType, keep: list[str] | None = None,
               corrupt_col: str | None = "_corrupt") -> DataFrame:
    """JSON text -> declared struct, star-expanded.

    Malformed text, and JSON of another shape than ``schema``, gives null fields; ``corrupt_col``
    flags those rows so a reject branch can count or route them (rows are never dropped here).
    The flag comes from the parse itself: the text that did not fit is a field of the result.
    """
    t = F.col(text_col)
    cols = [F.col(k) for k in (keep or [])]
    if corrupt_col:
        with_text = StructType([*schema.fields, StructField("_unfit", StringType())])
        cols.append(F.from_json(t, with_text, {"columnNameOfCorruptRecord": "_unfit"}).alias("_v"))
    else:
        cols.append(F.from_json(t, schema).alias("_v"))
    out = df.select(*cols)
    rest = [F.col(k) for k in (keep or [])] + [F.col(f"_v.{f.name}") for f in schema.fields]
    if corrupt_col:
        rest.append(F.col("_v._unfit").isNotNull().alias(corrupt_col))
    return out.select(*rest)


def rejected(df: DataFrame, text_col: str, schema: StructType) -> DataFrame:
    """The messages that ``parse_json`` flags, as they came. A null message is none of them."""
    unfit = F.from_json(F.col(text_col), StructType([*schema.fields, StructField("_unfit", StringType())]), {"columnNameOfCorruptRecord": "_unfit"})
    return df.where(unfit["_unfit"].isNotNull())


def split_rejects(df: DataFrame, text_col: str, schema: StructType,
                  keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, messages that do not fit ``schema``). A null message is parsed to nulls."""
    good = parse_json(df, text_col, schema, keep, corrupt_col="_bad").where("not _bad").drop("_bad")
    return good, rejected(df, text_col, schema)


def explode_rows(df: DataFrame, array_col: str, alias: str | None = None, outer: bool = False,
                 keep: list[str] | None = None) -> DataFrame:
    """P3 (inner: empty/null array -> no row) and P4 (outer: one null row)."""
    fn = F.explode_outer if outer else F.explode
    name = alias or array_col.split(".")[-1]
    keep_cols = keep if keep is not None else [c for c in df.columns if c != array_col]
    return df.select(*[F.col(c) for c in keep_cols], fn(F.col(array_col)).alias(name))


def flatten(df: DataFrame, sep: str = "_", depth: int = 3, structs: list[str] | None = None,
            keep_parent_names: bool = True) -> DataFrame:
    """Lift struct fields to top-level columns, up to ``depth`` levels.

    Field ``wind.speed`` becomes ``wind_speed`` (``keep_parent_names``) or
    ``speed``. Non-struct columns pass through. ``structs`` limits which
    top-level struct columns are expanded.
    """
    def walk(dtype, path, level):
        if isinstance(dtype, StructType) and level < depth:
            out = []
            for f in dtype.fields:
                out.extend(walk(f.dataType, path + [f.name], level + 1))
            return out
        name = sep.join(path) if keep_parent_names else path[-1]
        ref = F.col(".".join(f"`{p}`" for p in path))
        return [ref.alias(name)]

    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType) and (structs is None or f.name in structs):
            sub = walk(f.dataType, [f.name], 0)
            cols.extend(sub)
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def first_element(c) -> Column:
    """First element of an array, null when empty or null."""
    return F.try_element_at(as_col(c), F.lit(1))


def prefix_columns(df: DataFrame, prefix: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """One projection renaming every column to ``prefix + name``."""
    return df.select(*[F.col(f"`{c}`").alias(c if c in exclude else prefix + c) for c in df.columns])


def suffix_clashes(left: DataFrame, right: DataFrame, on: list[str],
                   suffixes: tuple[str, str] = ("_x", "_y")) -> tuple[DataFrame, DataFrame]:
    """P10: rename columns present on both sides (other than the keys)."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    lsel = [F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in left.columns]
    rsel = [F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c) for c in right.columns]
    return left.select(*lsel), right.select(*rsel)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop, ignoring absent names."""
    return df.drop(*cols)


def row_key(ts, *parts, sep: str = "_", ts_format: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Composite key ``{timestamp}{sep}{part}...`` with one fixed format.

    A missing part becomes the empty text, so the key is never null when the
    timestamp is present.
    """
    pieces = [F.date_format(as_col(ts), ts_format)]
    pieces += [F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts]
    return F.concat_ws(sep, *pieces)


def schema_text(df: DataFrame) -> str:
    """The schema tree as text (no Spark job)."""
    return df.schema.treeString()


def peek(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows for display (a limit is the feature here)."""
    return df.limit(n)


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """C17 over a frame: text columns -> numbers with try_cast, in one select."""
    return df.select(*[F.col(c).cast("string").try_cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def is_array(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, ArrayType)
