"""Window assignment and windowed aggregation.

All windows are half-open ``[start, end)`` and aligned to the UTC epoch; ends
are reported as epoch-millisecond ``bigint`` columns ``window_start`` /
``window_end``.

Two plan shapes exist for sliding windows:

* ``F.window(ts, size, slide)`` expands each row ``size/slide`` times before
  the partial aggregate.  Cheap for small ratios (60m/5m = 12).
* the *delta* shape for large ratios (1h/1s = 3600): each row emits +1 at the
  end of the first window containing it and -1 one window-size later; the
  deltas are pre-aggregated per (key, end) with a map-side combine, turned
  into counts by a running sum, and only then expanded to one row per
  window.  Input volume is multiplied by 2 instead of by the ratio, and the
  expansion happens after the last shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import duration_ms, floor_to, spark_interval, to_ms
from .prefix import key_struct

DELTA_RATIO_THRESHOLD = 16



def window_bounds(win: Column | str = "window") -> list[Column]:
    w = F.col(win) if isinstance(win, str) else win
    return [
        to_ms(w.start).alias("window_start"),
        to_ms(w.end).alias("window_end"),
    ]


def windowed_agg(
    df: DataFrame,
    keys: list[str],
    ts: str,
    size: int | str,
    aggs: list[Column],
    slide: int | str | None = None,
) -> DataFrame:
    """W1/W2/W3 + any built-in aggregates: ``groupBy(window, *keys).agg(...)``.

    With ``keys=[]`` the window itself is the grouping key (W3), which keeps
    the partial aggregation that a constant dummy key would defeat.
    """
    size_ms = duration_ms(size)
    slide_ms = duration_ms(slide) if slide is not None else size_ms
    win = F.window(F.col(ts), spark_interval(size_ms), spark_interval(slide_ms))
    grouped = df.groupBy(win.alias("window"), *keys).agg(*aggs)
    return grouped.select(*keys, *window_bounds("window"), *[c for c in grouped.columns if c not in keys and c != "window"])


def tumbling_count(df: DataFrame, keys: list[str], ts: str, size, out: str = "cnt") -> DataFrame:
    return windowed_agg(df, keys, ts, size, [F.count(F.lit(1)).alias(out)])


# ---------------------------------------------------------------- delta shape


def window_deltas(
    df: DataFrame,
    keys: list[str],
    ts_ms: str,
    size,
    slide,
    weight: Column | None = None,
    out: str = "delta",
) -> DataFrame:
    """(keys, end, delta): +w where a row's windows begin, -w where they stop.

    Windows start at multiples of the slide, so a row at ``u`` lies in those
    ending from ``floor(u - size) + slide + size`` to ``floor(u) + size``
    (floors to the slide), whether or not the slide divides the size; a row in
    a gap between windows (slide over size) cancels itself out.
    Aggregated per (keys, end); partial aggregation happens map-side.
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    w = F.lit(1).cast("bigint") if weight is None else weight
    past = F.lit(slide_ms + size_ms)
    pairs = F.array(
        F.struct((floor_to(F.col(ts_ms) - F.lit(size_ms), slide_ms) + past).alias("end"), w.alias("d")),
        F.struct((floor_to(F.col(ts_ms), slide_ms) + past).alias("end"), (-w).alias("d")),
    )
    exploded = df.select(*keys, F.explode(pairs).alias("_p"))
    return exploded.groupBy(*keys, F.col("_p.end").alias("end")).agg(
        F.sum("_p.d").alias(out)
    )


def _bucket_width(size_ms: int, slide_ms: int, bucket) -> int:
    """A multiple of the slide, at least ``bucket`` and one window."""
    want = max(duration_ms(bucket) if bucket else 86_400_000, size_ms)
    return slide_ms * -(-want // slide_ms)


def deltas_to_runs(
    deltas: DataFrame,
    keys: list[str],
    size,
    slide,
    delta: str = "delta",
    out: str = "cnt",
    bucket=None,
) -> DataFrame:
    """Aggregated deltas -> runs ``[start, stop)`` of window ends with a constant
    count > 0, clipped to time buckets: columns keys..., _b, start, stop, out.

    The running sum is taken per (key, time bucket) with a carry-in from the
    previous buckets, so neither a hot key nor an un-keyed total is windowed
    in a single task.  A run never leaves its bucket: the last change point of
    a bucket runs to the bucket end, and the first row of a bucket opens the
    run carried in from before it.  Between two change points the count is
    constant and a positive run ends at most ``size`` later, so with buckets
    at least ``size`` wide a carried run always meets a change point in the
    next bucket, whose rows are present.
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    width = _bucket_width(size_ms, slide_ms, bucket)
    phase = size_ms % slide_ms  # window ends are multiples of the slide plus this; so are bucket starts
    # Keys travel as one struct (never null, null fields compare equal), so the
    # same hash partitioning serves the per-bucket aggregate, the join and the
    # row-level window without further exchanges.  A fixed partition count keeps
    # AQE from coalescing this (small) exchange into a few tasks, because the
    # rows multiply by up to size/slide once runs are expanded.
    parts = int(deltas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kcols = ["_key"] if keys else []
    d = deltas.select(
        *([key_struct(keys).alias("_key")] if keys else []),
        "end",
        F.col(delta).alias("_d"),
        # non-nullable bucket: no inferred null filter lands in just one branch
        F.coalesce(F.floor((F.col("end") - F.lit(phase)) / F.lit(width)).cast("bigint"), F.lit(0).cast("bigint")).alias("_b"),
    ).repartition(parts, *kcols, "_b")
    # Deltas may arrive partly aggregated (e.g. per page before a page->url
    # join); summing per (key, end) here reuses the partitioning above.
    d = d.groupBy(*kcols, "_b", "end").agg(F.sum("_d").alias("_d"))
    # The per-bucket table reads the same columns as the row side (it needs
    # the bucket's first end), so both branches share one exchange.
    per_bucket = d.groupBy(*kcols, "_b").agg(F.sum("_d").alias("_bsum"), F.min("end").alias("_bfirst"))
    w_keys = Window.partitionBy(*kcols).orderBy("_b")
    table = per_bucket.select(
        *kcols,
        "_b",
        "_bfirst",
        F.sum("_bsum").over(w_keys.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
    )
    # The per-bucket table is hashed inside each partition of ``d``; the hint
    # keeps AQE from broadcasting ``d`` itself and funnelling the stage into
    # the (coalesced, tiny) partitions of the table side.
    joined = d.join(table.hint("shuffle_hash"), [*kcols, "_b"], "left")
    w_in = Window.partitionBy(*kcols, "_b").orderBy("end")
    carry = F.coalesce(F.col("_carry"), F.lit(0))
    cnt = carry + F.sum("_d").over(w_in.rowsBetween(Window.unboundedPreceding, 0))
    bstart = F.col("_b") * F.lit(width) + F.lit(phase)
    nxt = F.coalesce(F.lead("end").over(w_in), bstart + F.lit(width))
    first = F.col("end") == F.col("_bfirst")
    unpack = [F.col(f"_key.{k}").alias(k) for k in keys]
    marked = joined.select(
        *unpack, "_b", "end", cnt.alias("_cnt"), nxt.alias("_next"),
        F.when(first, carry).otherwise(F.lit(0)).alias("_lead_in"), bstart.alias("_bstart"),
    )
    runs = F.array(
        F.struct(F.col("end").alias("start"), F.col("_next").alias("stop"), F.col("_cnt").alias("c")),
        F.struct(F.col("_bstart").alias("start"), F.col("end").alias("stop"), F.col("_lead_in").alias("c")),
    )
    exploded = marked.select(*keys, "_b", F.explode(runs).alias("_r"))
    return exploded.select(
        *keys, "_b", F.col("_r.start").alias("start"), F.col("_r.stop").alias("stop"), F.col("_r.c").alias(out)
    ).where((F.col(out) > 0) & (F.col("stop") > F.col("start")))


def expand_runs(runs: DataFrame, keys: list[str], slide, out: str = "cnt") -> DataFrame:
    """One row per window end of each run."""
    slide_ms = duration_ms(slide)
    ends = F.sequence(F.col("start"), F.col("stop") - F.lit(slide_ms), F.lit(slide_ms).cast("bigint"))
    return runs.select(*keys, F.explode(ends).alias("window_end"), out)


def with_total_deltas(deltas: DataFrame, keys: list[str], label: str = "total", delta: str = "delta") -> DataFrame:
    """A4 from A3's deltas: append, per change point, the sum over all keys
    labelled ``label`` in every key column.  One scan and one delta pipeline
    then yield both the per-key and the total series (``rollup`` on deltas)."""
    total = deltas.groupBy("end").agg(F.sum(delta).alias(delta)).select(
        *[F.lit(label).alias(k) for k in keys], "end", delta
    )
    return deltas.select(*keys, "end", delta).unionByName(total)


def deltas_to_counts(
    deltas: DataFrame,
    keys: list[str],
    size,
    slide,
    delta: str = "delta",
    out: str = "cnt",
    bucket=None,
) -> DataFrame:
    """Aggregated deltas -> one row per (keys, window_end) with count > 0."""
    runs = deltas_to_runs(deltas, keys, size, slide, delta, out, bucket)
    return expand_runs(runs, keys, slide, out)


def deltas_top_n(
    deltas: DataFrame,
    key: str,
    size,
    slide,
    n: int,
    delta: str = "delta",
    out: str = "cnt",
    bucket="1 hour",
    rank_col: str = "rnk",
) -> DataFrame:
    """Top-n keys per window end straight from deltas.

    Runs are expanded where they were made, in (key, bucket) partitions, and
    the limit on ``row_number`` cuts each of these to ``n`` rows per window end
    before the exchange on the window end.  So a busy hour's keys are expanded
    by all tasks, and at most ``n`` rows per window end and task are shuffled.
    """
    from .rank import top_n

    runs = deltas_to_runs(deltas, [key], size, slide, delta, out, bucket)
    return top_n(expand_runs(runs, [key], slide, out), ["window_end"], out, key, n, rank_col)


def sliding_count(
    df: DataFrame,
    keys: list[str],
    ts: str,
    size,
    slide,
    out: str = "cnt",
    method: str = "auto",
    ts_ms: str | None = None,
) -> DataFrame:
    """Count per (keys, sliding window): columns keys..., window_end, ``out``.

    ``method='auto'`` picks ``F.window`` for size/slide <= 16 and the delta
    shape above it; both give identical rows.
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    if method == "auto":
        method = "window" if size_ms // slide_ms <= DELTA_RATIO_THRESHOLD else "delta"
    if method == "window":
        res = windowed_agg(df, keys, ts, size_ms, [F.count(F.lit(1)).alias(out)], slide_ms)
        return res.select(*keys, "window_end", out)
    if ts_ms is None:
        df = df.withColumn("_ts_ms", to_ms(F.col(ts)))
        ts_ms = "_ts_ms"
    deltas = window_deltas(df, keys, ts_ms, size_ms, slide_ms)
    return deltas_to_counts(deltas, keys, size_ms, slide_ms, out=out)
