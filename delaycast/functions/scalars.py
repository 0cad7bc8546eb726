"""Categorical, string and numeric scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Route classes of the delay-by-route report.
NIGHT_CLASS = "night"      # code contains "N"
SHORT_CLASS = "short"      # code of at most two characters (tram-like)
REGULAR_CLASS = "regular"  # everything else


def recode_night_route(c) -> Column:
    """C14: ``N<rest>`` -> ``99`` + rest left-padded with zeros to two chars.

    Longer rests stay whole (zfill never truncates, lpad would); null stays null.
    """
    x = as_col(c).cast("string")
    rest = F.substring(x, 2, 1 << 20)
    padded = F.when(F.length(rest) < 2, F.lpad(rest, 2, "0")).otherwise(rest)
    return F.when(x.startswith("N"), F.concat(F.lit("99"), padded)).otherwise(x)


def route_class(c) -> Column:
    """Night if the code contains N, short if at most 2 chars, else regular."""
    x = as_col(c).cast("string")
    return (F.when(x.contains("N"), F.lit(NIGHT_CLASS))
            .when(F.length(x) <= 2, F.lit(SHORT_CLASS))
            .when(x.isNotNull(), F.lit(REGULAR_CLASS)))


def split_first(c, sep: str = "-") -> Column:
    """``code.split(sep)[0]``."""
    return F.split_part(as_col(c), F.lit(sep), F.lit(1))


def to_number(c, dtype: str = "double") -> Column:
    """C17: text -> number; "None", "" and junk give null instead of raising."""
    return as_col(c).cast("string").try_cast(dtype)


def round_coord(c, digits: int = 2) -> Column:
    """Round half-up to ``digits`` decimals (Spark rule)."""
    return F.round(as_col(c), digits)


def decode_text(c, charset: str = "UTF-8") -> Column:
    """Bytes -> text."""
    return F.decode(as_col(c), charset)


def epoch_from_key(c) -> Column:
    """8-byte big-endian millisecond key -> timestamp."""
    return F.timestamp_millis(F.conv(F.hex(as_col(c)), 16, 10).cast("bigint"))


def one_hot_columns(c, categories, prefix: str | None = None, name: str | None = None) -> list[Column]:
    """C20 table form: one 0/1 column per category, ``{prefix}_{value}``;
    a null or unseen value gives all zeros (pandas get_dummies)."""
    x = as_col(c)
    pre = prefix if prefix is not None else (name or "col")
    return [F.when(x == F.lit(v), 1).otherwise(0).cast("int").alias(f"{pre}_{v}")
            for v in categories]


def nan_to_null(c) -> Column:
    """A8 helper: NaN poisons corr; null is skipped pairwise."""
    x = as_col(c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))
