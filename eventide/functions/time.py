"""Time helpers: durations, epoch-millisecond columns and the fixed formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_MS = {
    "ms": 1,
    "millisecond": 1,
    "milliseconds": 1,
    "s": 1000,
    "sec": 1000,
    "second": 1000,
    "seconds": 1000,
    "m": 60_000,
    "min": 60_000,
    "minute": 60_000,
    "minutes": 60_000,
    "h": 3_600_000,
    "hour": 3_600_000,
    "hours": 3_600_000,
    "d": 86_400_000,
    "day": 86_400_000,
    "days": 86_400_000,
}


def duration_ms(value: int | str) -> int:
    """``'5 minutes'`` / ``'1h'`` / ``1000`` (ms) -> milliseconds."""
    if isinstance(value, int):
        return value
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", value)
    if not m or m.group(2).lower() not in _UNITS_MS:
        raise ValueError(f"unsupported duration: {value!r}")
    return int(m.group(1)) * _UNITS_MS[m.group(2).lower()]


def spark_interval(ms: int) -> str:
    """Milliseconds -> a Spark interval string accepted by ``F.window``."""
    if ms % 1000:
        return f"{ms} milliseconds"
    return f"{ms // 1000} seconds"


def watermark_delay(value: int | str) -> str:
    """A watermark delay that Spark accepts, from a duration or milliseconds."""
    ms = duration_ms(value)
    return spark_interval(ms) if ms else "0 seconds"


def to_ms(ts: Column | str) -> Column:
    """Epoch milliseconds of a TIMESTAMP (truncating sub-millisecond digits)."""
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def from_ms(ms: Column | str) -> Column:
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def floor_to(ms: Column, step_ms: int) -> Column:
    """Largest multiple of ``step_ms`` not above ``ms`` (epoch aligned)."""
    return F.floor(ms / F.lit(step_ms)).cast("bigint") * F.lit(step_ms)


# The formats of reported window bounds and report headers.
#   window bound label: yyyy/MM/dd-HH:mm:ss   (UTC)
#   report header time: yyyy-MM-dd HH:mm:ss.f  (java.sql.Timestamp text, UTC)
BOUND_FORMAT = "yyyy/MM/dd-HH:mm:ss"


def format_bound(ms: Column | str) -> Column:
    """Epoch ms -> ``yyyy/MM/dd-HH:mm:ss`` in UTC."""
    return F.date_format(from_ms(ms), BOUND_FORMAT)


def timestamp_text(ms: Column | str) -> Column:
    """Epoch ms -> java ``Timestamp.toString`` text in UTC.

    The fraction keeps its significant digits only, and ``.0`` when zero.
    """
    ms = F.col(ms) if isinstance(ms, str) else ms
    frac = F.pmod(ms, F.lit(1000))
    digits = F.regexp_replace(F.lpad(frac.cast("string"), 3, "0"), "0+$", "")
    frac_text = F.when(frac == 0, F.lit("0")).otherwise(digits)
    return F.concat(
        F.date_format(from_ms(ms), "yyyy-MM-dd HH:mm:ss"), F.lit("."), frac_text
    )
