"""Watermarks, late rows, early and revised window results.

Batch forms take an explicit arrival order (``arrival`` time plus a unique
``seq``), because lateness is defined against the watermark the stream had
when a row arrived: ``watermark(r) = max(ts of rows that arrived before r) -
delay`` (no earlier rows: no watermark, nothing is late).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_ms, floor_to
from .prefix import bucketed_running

# The late-row message.
LATE_TEXT = "这个元素迟到了！"


def running_watermark(
    df: DataFrame,
    ts_ms: str,
    arrival: str,
    seq: str,
    delay,
    out: str = "watermark",
    bucket="1 minute",
    keys: list[str] | None = None,
    carry_max: int | None = None,
) -> DataFrame:
    """L3 as a column: the watermark in force when each row arrived.

    The running max over the whole arrival order is taken in two levels
    (arrival-time buckets, then rows inside a bucket) so no single task sees
    the stream.  ``keys`` restricts the watermark to a key (per-partition
    watermarks); the reference uses one watermark for the stream.
    """
    b = F.floor(F.col(arrival) / F.lit(duration_ms(bucket))).cast("bigint")
    with_b = df.withColumn("_ab", b)
    res = bucketed_running(
        with_b, keys or [], "_ab", [arrival, seq], ts_ms, "_maxprev", kind="max", inclusive=False
    )
    maxprev = F.col("_maxprev")
    if carry_max is not None:
        maxprev = F.greatest(maxprev, F.lit(carry_max).cast("bigint"))
    return res.withColumn(out, maxprev - F.lit(duration_ms(delay))).drop("_maxprev", "_ab")


def late_split(df: DataFrame, ts_ms: str, arrival: str, seq: str, delay, **kw) -> DataFrame:
    """L4: adds ``is_late`` (ts below the watermark at arrival) and the side text."""
    wm = running_watermark(df, ts_ms, arrival, seq, delay, **kw)
    late = F.coalesce(F.col(ts_ms) < F.col("watermark"), F.lit(False))
    return wm.withColumn("is_late", late).withColumn(
        "side_msg", F.when(late, F.lit(LATE_TEXT))
    )


def late_revisions(
    df: DataFrame,
    keys: list[str],
    ts_ms: str,
    arrival: str,
    seq: str,
    size,
    delay,
    allowed_lateness,
    bucket="1 minute",
) -> DataFrame:
    """Window results with a first firing and one revision per late row.

    For a tumbling window ending at e (last instant e-1) and a row arriving
    under watermark wm: on time if ``wm < e - 1``; a late revision if
    ``e - 1 <= wm < e - 1 + allowed``; dropped otherwise.  The first firing
    holds all on-time rows; each accepted late row fires again with the
    count so far.  A window without on-time rows first fires at its first
    late row.  Columns: keys, window_end, firing (0 = on-time firing),
    cnt, is_update.
    """
    size_ms, allowed_ms = duration_ms(size), duration_ms(allowed_lateness)
    marked = running_watermark(df, ts_ms, arrival, seq, delay, bucket=bucket)
    e = floor_to(F.col(ts_ms), size_ms) + F.lit(size_ms)
    last = e - F.lit(1)
    wm = F.col("watermark")
    state = (
        F.when(wm.isNull() | (wm < last), F.lit("on_time"))
        .when(wm < last + F.lit(allowed_ms), F.lit("late"))
        .otherwise(F.lit("dropped"))
    )
    marked = marked.select(*keys, e.alias("window_end"), arrival, seq, state.alias("_state"))
    on_time = (
        marked.where(F.col("_state") == "on_time")
        .groupBy(*keys, "window_end")
        .agg(F.count(F.lit(1)).alias("_n_on"))
    )
    late = marked.where(F.col("_state") == "late").withColumn("_one", F.lit(1).cast("bigint"))
    late = late.withColumn("_lb", F.floor(F.col(arrival) / F.lit(duration_ms(bucket))).cast("bigint"))
    late = bucketed_running(late, [*keys, "window_end"], "_lb", [arrival, seq], "_one", "firing")
    revised = late.join(on_time, [*keys, "window_end"], "left").select(
        *keys,
        "window_end",
        "firing",
        (F.coalesce("_n_on", F.lit(0)) + F.col("firing")).alias("cnt"),
        ((F.coalesce("_n_on", F.lit(0)) > 0) | (F.col("firing") > 1)).alias("is_update"),
    )
    first = on_time.select(
        *keys, "window_end", F.lit(0).cast("bigint").alias("firing"),
        F.col("_n_on").alias("cnt"), F.lit(False).alias("is_update"),
    )
    return first.unionByName(revised)


def early_results(
    df: DataFrame, keys: list[str], ts_ms: str, value: str, size, pane,
) -> DataFrame:
    """Running min/max of a tumbling window at every pane boundary.

    Pane t (a multiple of ``pane`` with start < t <= end) reports the rows
    with ts < t, from the window's first non-empty pane on, including panes
    without new rows; t = end is the final result.  Rows are aggregated per own
    pane first (map-side combine); only those panes are fanned out to the pane
    ends up to the window end (at most size/pane).
    """
    size_ms, pane_ms = duration_ms(size), duration_ms(pane)
    if size_ms % pane_ms:
        raise ValueError("pane must divide the window size")
    end = floor_to(F.col(ts_ms), size_ms) + F.lit(size_ms)
    own = floor_to(F.col(ts_ms), pane_ms) + F.lit(pane_ms)
    low, high = f"min_{value}", f"max_{value}"
    panes = df.groupBy(*keys, end.alias("window_end"), own.alias("_own")).agg(
        F.min(value).alias(low), F.max(value).alias(high)
    )
    fan = panes.select(
        *keys, "window_end", low, high,
        F.explode(F.sequence("_own", "window_end", F.lit(pane_ms).cast("bigint"))).alias("pane_end"),
    )
    agg = fan.groupBy(*keys, "window_end", "pane_end").agg(F.min(low).alias(low), F.max(high).alias(high))
    return agg.withColumn("is_final", F.col("pane_end") == F.col("window_end"))
