"""Time scalars (C1-C13): parse, bucket, shift, time-of-day features.

All functions return Columns built from JVM built-ins, so they stay inside
whole-stage codegen. Timestamps are session-TZ (UTC) ``timestamp``; an input
``timestamp_ntz`` column is cast once (UTC wall clock is kept).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

US_PER_S = 1_000_000
DAY_US = 86_400 * US_PER_S


def to_ts(c) -> Column:
    """Text or ntz -> timestamp; unparseable text gives null (ANSI-safe)."""
    return as_col(c).try_cast("timestamp")


def parse_weekday_time(c) -> Column:
    """``Sun Dec 17 13:05:09 CET 2023`` -> timestamp (zone honoured).

    The modern parser rejects the ``EEE`` field, so the weekday word (always
    three letters and a space) is cut off and the rest parsed; one- and
    two-digit days both parse, junk gives null.
    """
    text = F.substring(as_col(c), 5, 10_000)
    return F.try_to_timestamp(text, F.lit("MMM d HH:mm:ss z yyyy"))


def format_weekday_time(c) -> Column:
    """Inverse of C2 for the session zone (used to build test feeds)."""
    return F.date_format(as_col(c), "EEE MMM dd HH:mm:ss zzz yyyy")


def epoch_micros(c) -> Column:
    return F.unix_micros(as_col(c).cast("timestamp"))


def floor_div(x: Column, w: int) -> Column:
    """Exact integer floor division (x - x mod w is an exact multiple of w)."""
    return ((x - F.pmod(x, F.lit(w))) / F.lit(w)).cast("bigint")


def _bucket_index(x: Column, w: int, mode: str) -> Column:
    if mode == "floor":
        return floor_div(x, w)
    if mode == "half_up":
        return floor_div(x + F.lit(w // 2), w) if w % 2 == 0 else floor_div(x * 2 + F.lit(w), 2 * w)
    if mode == "half_even":
        q = floor_div(x, w)
        r2 = F.pmod(x, F.lit(w)) * 2
        up = (r2 > F.lit(w)) | ((r2 == F.lit(w)) & (F.pmod(q, F.lit(2)) == 1))
        return F.when(up, q + 1).otherwise(q)
    raise ValueError(f"unknown bucket mode {mode!r}")


def time_bucket(c, width_seconds: int, mode: str = "half_up", shift_seconds: int = 0,
                precision: str = "micro") -> Column:
    """Round a timestamp to a multiple of ``width_seconds``.

    mode: ``half_up`` (stream rule), ``half_even`` (pandas ``dt.round``) or
    ``floor``. precision ``second`` first truncates to whole seconds, as
    ``unix_timestamp`` does in the stream; ``micro`` keeps full precision.
    ``shift_seconds`` is added after rounding (+3600 gives the next-hour key).
    """
    us = epoch_micros(c)
    if precision == "second":
        x = floor_div(us, US_PER_S)
        unit = 1
    elif precision == "micro":
        x = us
        unit = US_PER_S
    else:
        raise ValueError(precision)
    idx = _bucket_index(x, width_seconds * unit, mode)
    out_us = idx * F.lit(width_seconds * US_PER_S) + F.lit(shift_seconds * US_PER_S)
    return F.timestamp_micros(out_us)


def next_hour_bucket(c) -> Column:
    """Nearest hour, half-up on whole seconds, plus one hour."""
    return time_bucket(c, 3600, "half_up", 3600, precision="second")


def training_forecast_bin(c) -> Column:
    """C4: nearest hour half-even, plus one hour."""
    return time_bucket(c, 3600, "half_even", 3600)


def ten_minute_bin(c) -> Column:
    """Nearest 10 minutes, half-even."""
    return time_bucket(c, 600, "half_even")


def minute_bin(c) -> Column:
    """Nearest minute, half-even."""
    return time_bucket(c, 60, "half_even")


def hour_bin(c) -> Column:
    """Nearest hour, half-even, no shift."""
    return time_bucket(c, 3600, "half_even")


def time_parts(c, prefix: str = "") -> list[Column]:
    """Day of month, hour, minute."""
    t = as_col(c)
    return [F.dayofmonth(t).alias(prefix + "day"), F.hour(t).alias(prefix + "hour"),
            F.minute(t).alias(prefix + "minute")]


def shift(c, seconds: float) -> Column:
    """Add a constant number of seconds (negative subtracts)."""
    return F.timestamp_micros(epoch_micros(c) + F.lit(int(round(seconds * US_PER_S))))


def to_local(c, zone: str) -> Column:
    """C9 (local-time correction): UTC instant -> wall clock of ``zone``."""
    return F.from_utc_timestamp(as_col(c).cast("timestamp"), zone)


def minutes_left_to_midnight(c) -> Column:
    """C10 (serving rule): 1440 - (60*hour + minute)."""
    t = as_col(c)
    return F.lit(24 * 60) - (F.hour(t) * 60 + F.minute(t))


def minutes_to_nearest_midnight(c) -> Column:
    """C11 (training rule): min(whole minutes to next midnight, minutes since
    last midnight); 00:00:00 gives 0."""
    us_day = F.pmod(epoch_micros(c), F.lit(DAY_US))
    to_next_s = F.pmod(floor_div(F.lit(DAY_US) - us_day, US_PER_S), F.lit(86_400))
    to_next_min = floor_div(to_next_s, 60)
    since_last_min = floor_div(us_day, 60 * US_PER_S)
    return F.least(to_next_min, since_last_min).cast("int")


def format_compact(c, fmt: str = "yyyyMMddHHmm") -> Column:
    """Zero-padded date parts."""
    return F.date_format(as_col(c), fmt)


def minus_delay(c, delay, unit_seconds: float = 1.0) -> Column:
    """Timestamp minus a delay given in ``unit_seconds`` units
    (1 = seconds, the default; 60 = minutes as the training notebook did)."""
    d_us = F.round(as_col(delay).cast("double") * F.lit(unit_seconds * US_PER_S)).cast("bigint")
    return F.timestamp_micros(epoch_micros(c) - d_us)


def time_of_day_seconds(c) -> Column:
    """F5 helper: ``HH:MM:SS`` -> seconds (hours past 24 roll over naturally)."""
    parts = F.split(as_col(c), ":")
    return (F.try_element_at(parts, F.lit(1)).try_cast("int") * 3600
            + F.try_element_at(parts, F.lit(2)).try_cast("int") * 60
            + F.try_element_at(parts, F.lit(3)).try_cast("int"))


def second_of_day(c) -> Column:
    return floor_div(F.pmod(epoch_micros(c), F.lit(DAY_US)), US_PER_S).cast("int")
