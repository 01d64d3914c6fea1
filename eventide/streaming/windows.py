"""Structured Streaming forms of the windowed operators.

All are append-mode: a window is emitted once, when the watermark passes its
end, which makes the streamed rows equal to the batch rows of the same
(closed) windows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_ms, spark_interval, to_ms, watermark_delay
from ..operators.rank import ranked_report, top_n


def window_counts(
    stream: DataFrame, keys: list[str], ts: str, size, slide=None, delay="0 seconds",
    out: str = "cnt",
) -> DataFrame:
    """Append-mode count per (window, keys): keys..., window_end, out."""
    size_ms = duration_ms(size)
    slide_ms = duration_ms(slide) if slide else size_ms
    win = F.window(F.col(ts), spark_interval(size_ms), spark_interval(slide_ms))
    counted = (
        stream.withWatermark(ts, watermark_delay(delay))
        .groupBy(win.alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias(out))
    )
    return counted.select(*keys, to_ms(F.col("window.end")).alias("window_end"), out)


def distinct_users(stream: DataFrame, user: str, ts: str, size, delay="0 seconds") -> DataFrame:
    """A5 stream: first sighting per (window, user), then a count per window.

    ``count(DISTINCT)`` is not supported on streams; deduplicating on the
    window struct keeps one row per user and window, and its state is evicted
    with the watermark.
    """
    size_ms = duration_ms(size)
    win = F.window(F.col(ts), spark_interval(size_ms))
    wm = stream.withWatermark(ts, watermark_delay(delay))
    firsts = wm.select(win.alias("window"), F.col(user), F.col(ts)).dropDuplicates(["window", user])
    counted = firsts.groupBy("window").agg(F.count(F.lit(1)).alias("uv"))
    return counted.select(to_ms(F.col("window.end")).alias("window_end"), "uv")


def top_n_per_batch(key: str, n: int, sink: Callable[[DataFrame, int], None]):
    """K1 stream: ``foreachBatch`` body that ranks each batch of closed windows.

    In append mode every key of a window is emitted in the same micro-batch
    (the one whose watermark passes the window end), so a batch-local top-N
    per window is exact and needs no per-window buffer in state.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        ranked = top_n(batch, ["window_end"], "cnt", key, n)
        sink(ranked.select("window_end", "rnk", key, "cnt"), batch_id)

    return run


def report_per_batch(key: str, n: int, sink: Callable[[DataFrame, int], None], **report):
    """K1 + K2 stream: ``foreachBatch`` body that hands on a text report per closed window."""

    def reported(ranked: DataFrame, batch_id: int) -> None:
        sink(ranked_report(ranked, "window_end", key, "cnt", **report), batch_id)

    return top_n_per_batch(key, n, reported)


def sliding_counts(
    stream: DataFrame, keys: list[str], ts: str, size, slide, delay="0 seconds", out: str = "cnt"
) -> DataFrame:
    """W2 stream for many windows per row: keys..., window_end, out.

    Rows are first counted per pane, the largest span that divides both size
    and slide, and only a pane's count is fanned out to its windows: two
    chained append-mode aggregations, all state in Spark's own store.
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    pane = F.window(F.col(ts), spark_interval(math.gcd(size_ms, slide_ms)))
    panes = (
        stream.withWatermark(ts, watermark_delay(delay)).groupBy(pane.alias("pane"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    window = F.window(F.col("pane"), spark_interval(size_ms), spark_interval(slide_ms))
    counted = panes.groupBy(window.alias("window"), *keys).agg(F.sum("n").alias(out))
    return counted.select(*keys, to_ms(F.col("window.end")).alias("window_end"), out)


def window_min_max(stream: DataFrame, keys: list[str], ts: str, value: str, size, delay="0 seconds") -> DataFrame:
    """L6 stream: running min/max per (window, keys).

    Run in ``update`` mode with ``trigger(processingTime=...)`` for early
    results: each trigger emits the windows whose aggregate changed, and the
    row emitted after the watermark passes the window end is the final one.
    """
    size_ms = duration_ms(size)
    win = F.window(F.col(ts), spark_interval(size_ms))
    d = watermark_delay(delay)
    agg = stream.withWatermark(ts, d).groupBy(win.alias("window"), *keys).agg(
        F.min(value).alias(f"min_{value}"), F.max(value).alias(f"max_{value}")
    )
    return agg.select(*keys, to_ms(F.col("window.end")).alias("window_end"), f"min_{value}", f"max_{value}")


def revised_counts(stream: DataFrame, keys: list[str], ts: str, size, delay, allowed_lateness) -> DataFrame:
    """L5 stream: counts per (window, keys) in ``update`` mode.

    The watermark delay is ``delay + allowed_lateness``: a window's count is
    re-emitted for every micro-batch that adds rows to it, until the
    watermark passes its end plus the allowance; later rows are dropped.
    """
    total = duration_ms(delay) + duration_ms(allowed_lateness)
    win = F.window(F.col(ts), spark_interval(duration_ms(size)))
    agg = (
        stream.withWatermark(ts, watermark_delay(total))
        .groupBy(win.alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return agg.select(*keys, to_ms(F.col("window.end")).alias("window_end"), "cnt")


def bitmap_distinct_users(stream: DataFrame, user: str, ts: str, size, delay="0 seconds") -> DataFrame:
    """A6 stream: bitmaps per (window, 32768-bit bucket) of the user-id hash,
    then the bit counts summed per window, as two chained append-mode
    aggregations; each window is emitted once, after the watermark passes it."""
    from ..functions.hashing import poly_hash

    size_ms = duration_ms(size)
    d = watermark_delay(delay)
    h = poly_hash(F.col(user).cast("string"))
    maps = (
        stream.withWatermark(ts, d)
        .groupBy(F.window(F.col(ts), spark_interval(size_ms)).alias("window"),
                 F.bitmap_bucket_number(h).alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias("_bm"))
    )
    counted = maps.groupBy("window").agg(F.sum(F.bitmap_count("_bm")).alias("uv_bitmap"))
    return counted.select(to_ms(F.col("window.end")).alias("window_end"), "uv_bitmap")
