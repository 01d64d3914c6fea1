"""Windowed aggregates: distinct users, bitmap distinct, running distinct,
min/max and first-element reduce (A5-A9)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import poly_hash
from ..functions.time import duration_ms, floor_to, to_ms
from .prefix import bucketed_running
from .runs import extreme_runs
from .windows import DELTA_RATIO_THRESHOLD, expand_runs, windowed_agg


SEQ_DIGITS = 19  # decimal digits of a non-negative bigint sequence number


def _window_end(ts_ms: str, size_ms: int) -> Column:
    return floor_to(F.col(ts_ms), size_ms) + F.lit(size_ms)


def distinct_users(df: DataFrame, user: str, ts: str, size, out: str = "uv") -> DataFrame:
    """A5: exact distinct users per tumbling window (window_end, out)."""
    res = windowed_agg(df, [], ts, size, [F.count_distinct(F.col(user)).alias(out)])
    return res.select("window_end", out)


def bitmap_distinct_users(
    df: DataFrame, user: str, ts_ms: str, size, out: str = "uv_bitmap"
) -> DataFrame:
    """Distinct bit positions of ``poly_hash(user)`` per tumbling window.

    Users are placed in a 2^29-bit map by the string hash; colliding users
    count once (the undercount is part of the method).  Positions are first
    made distinct per window (a hash aggregate with map-side combine), then the
    map is built as Spark bitmaps per (window, 32768-bit bucket) and bit counts
    are summed, so only distinct positions are sorted for the bitmaps.
    """
    return bitmap_counts(window_bitmaps(df, user, ts_ms, size), out)


def window_bitmaps(df: DataFrame, user: str, ts_ms: str, size) -> DataFrame:
    """A6's state as a table: ``window_end, bucket, bitmap`` of each tumbling window.

    Only buckets with a set bit have a row.  Keep it (``write.parquet``) and roll it
    up to longer windows with ``roll_up_bitmaps`` without reading events again.
    """
    size_ms = duration_ms(size)
    positions = df.select(
        _window_end(ts_ms, size_ms).alias("window_end"), poly_hash(F.col(user).cast("string")).alias("_h")
    ).groupBy("window_end", "_h").agg(F.count(F.lit(1)).alias("_n"))
    keyed = positions.select(
        "window_end",
        F.bitmap_bucket_number("_h").alias("bucket"),
        F.bitmap_bit_position("_h").alias("_pos"),
    )
    return keyed.groupBy("window_end", "bucket").agg(F.bitmap_construct_agg("_pos").alias("bitmap"))


def roll_up_bitmaps(maps: DataFrame, base, size, slide=None) -> DataFrame:
    """Bitmaps of windows of ``size`` sliding by ``slide`` (default: tumbling) from those of tumbling windows of ``base``.

    Both must be multiples of ``base``.  Bitmaps are combined by ``bitmap_or_agg``
    with a map-side combine; each goes to the ``size / slide`` windows that hold it.
    """
    base_ms, size_ms = duration_ms(base), duration_ms(size)
    slide_ms = duration_ms(slide) if slide is not None else size_ms
    if size_ms % base_ms or slide_ms % base_ms:
        raise ValueError("size and slide must be multiples of the base window")
    start = F.col("window_end") - F.lit(base_ms)
    first = floor_to(start - F.lit(size_ms), slide_ms) + F.lit(slide_ms + size_ms)
    last = floor_to(start, slide_ms) + F.lit(size_ms)
    # A base window between two windows (slide over size) is in none.
    ends = F.when(first <= last, F.sequence(first, last, F.lit(slide_ms).cast("bigint")))
    spread = maps.select(F.explode(ends).alias("window_end"), "bucket", "bitmap")
    return spread.groupBy("window_end", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_counts(maps: DataFrame, out: str = "uv_bitmap") -> DataFrame:
    """``window_end, out``: the set bits of each window's bitmaps."""
    return maps.groupBy("window_end").agg(F.sum(F.bitmap_count("bitmap")).alias(out))


def approx_distinct_users(df: DataFrame, user: str, ts: str, size, out: str = "uv_approx") -> DataFrame:
    """HyperLogLog++ estimate per window (for mergeable sketches see ``hll_sketches``)."""
    res = windowed_agg(df, [], ts, size, [F.approx_count_distinct(F.col(user)).alias(out)])
    return res.select("window_end", out)


def running_distinct_users(
    df: DataFrame,
    user: str,
    ts_ms: str,
    seq: str,
    size,
    out: str = "uv_running",
    sub_bucket="1 minute",
) -> DataFrame:
    """One row each time a user is first seen in a tumbling window, with the
    number of distinct users seen in that window so far.

    First sightings are a hash aggregate with map-side combine: the least
    (ts, seq) per window and user, both packed in one decimal (a struct would
    force a sort).  The running count is a bucketed prefix count so a busy
    window is not ranked in one task.
    """
    size_ms = duration_ms(size)
    step = F.lit(Decimal(10) ** SEQ_DIGITS).cast("decimal(20,0)")
    packed = F.col(ts_ms).cast("decimal(18,0)") * step + F.col(seq).cast("decimal(19,0)")
    firsts = df.groupBy(_window_end(ts_ms, size_ms).alias("window_end"), F.col(user)).agg(
        F.min(packed.cast("decimal(38,0)")).alias("_first")
    )
    first_ts = F.floor(F.col("_first") / step).cast("bigint")
    firsts = firsts.select(
        "window_end", user, first_ts.alias(ts_ms), F.pmod(F.col("_first"), step).cast("bigint").alias(seq),
        F.lit(1).cast("bigint").alias("_one"),
        F.floor(first_ts / F.lit(duration_ms(sub_bucket))).cast("bigint").alias("_sb"),
    )
    counted = bucketed_running(firsts, ["window_end"], "_sb", [ts_ms, seq], "_one", out)
    return counted.select("window_end", user, ts_ms, out)


def min_max(df: DataFrame, keys: list[str], ts: str, value: str, size, slide=None) -> DataFrame:
    """(keys, min, max, window_end) per window; true minimum and maximum.

    Windows that overlap more than ``DELTA_RATIO_THRESHOLD`` times are computed in
    run form (``runs.min_max_runs``) and expanded at the end; the rows are the same.
    """
    low, high = f"min_{value}", f"max_{value}"
    if _overlap(size, slide) > DELTA_RATIO_THRESHOLD:
        # Windows whose values are all null have a row, as they have in a grouping.
        found = _from_runs(df, keys, ts, {low: ("min", value), high: ("max", value), "_seen": ("min", "_ms")}, size, slide)
        return found.select(*keys, low, high, "window_end")
    res = windowed_agg(df, keys, ts, size, [F.min(value).alias(low), F.max(value).alias(high)], slide)
    return res.select(*keys, low, high, "window_end")


def first_with_min(
    df: DataFrame, keys: list[str], ts: str, ts_ms: str, seq: str, value: str, size, slide=None
) -> DataFrame:
    """A9 reduce: the window's first row keeps its time, value = min.

    The first row's time is the least time, whichever row of it came first
    (``seq`` orders rows of equal time and so can not change it).  Windows that
    overlap often are computed in run form, as in ``min_max``.
    """
    low = f"min_{value}"
    if _overlap(size, slide) > DELTA_RATIO_THRESHOLD:
        found = _from_runs(df, keys, ts, {"first_ts": ("min", ts_ms), low: ("min", value)}, size, slide)
        return found.select(*keys, "window_end", "first_ts", low)
    res = windowed_agg(df, keys, ts, size, [F.min(ts_ms).alias("first_ts"), F.min(value).alias(low)], slide)
    return res.select(*keys, "window_end", "first_ts", low)


def _overlap(size, slide) -> int:
    return 1 if slide is None else duration_ms(size) // duration_ms(slide)


def _from_runs(df: DataFrame, keys: list[str], ts: str, extremes: dict[str, tuple[str, str]], size, slide) -> DataFrame:
    """``keys, window_end`` and the extremes, one row per window, from their runs."""
    rows = df.withColumn("_ms", to_ms(F.col(ts)))
    found = extreme_runs(rows, keys, "_ms", extremes, size, slide)
    packed = found.select(*keys, "start", "stop", F.struct(*extremes).alias("_x"))
    return expand_runs(packed, keys, slide, "_x").select(*keys, "window_end", "_x.*")


def hll_sketches(df: DataFrame, user: str, ts_ms: str, size, lg_k: int = 12) -> DataFrame:
    """A6 alternative: one mergeable HLL sketch per tumbling window
    (window_end, sketch).  Sketches of small windows union into larger ones
    without rescanning events (see ``merge_sketches``)."""
    size_ms = duration_ms(size)
    return df.groupBy(_window_end(ts_ms, size_ms).alias("window_end")).agg(
        F.hll_sketch_agg(F.col(user), lg_k).alias("sketch")
    )


def merge_sketches(sketches: DataFrame, size, out: str = "uv_estimate") -> DataFrame:
    """Roll window sketches up to windows of ``size`` (a multiple of theirs)."""
    size_ms = duration_ms(size)
    start = F.col("window_end") - F.lit(1)
    merged = sketches.groupBy((floor_to(start, size_ms) + F.lit(size_ms)).alias("window_end")).agg(
        F.hll_union_agg("sketch").alias("_s")
    )
    return merged.select("window_end", F.hll_sketch_estimate("_s").alias(out))
