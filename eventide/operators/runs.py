"""Window results in run form: stretches of consecutive window ends with one result.

A window that slides every second over an hour has 3,600 results an hour, most of
them equal to the one before.  The operators here compute the change points
only, and give rows ``start`` to ``stop`` (the first window end, and the first
one after the last) with the result that holds there:

* ``extreme_runs``: minima and maxima per key and sliding window (A8, A9 on W2);
* ``distinct_deltas``: exact distinct users per sliding window (A5 on W2), as
  deltas for ``windows.deltas_to_runs`` / ``deltas_to_counts``;
* ``top_n_runs``: rankings per sliding window (K1 on W2) from runs of counts;
* ``merge_runs``: neighbouring stretches with equal results put together.

Rows multiply by a constant, never by ``size / slide``, and every window over
rows is taken per (key, time bucket), so neither a hot key nor an un-keyed
result is one task's work.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import duration_ms, floor_to
from .rank import top_n


def _pane_ms(size_ms: int, slide_ms: int) -> int:
    """The widest panes that no window bound cuts."""
    return math.gcd(size_ms, slide_ms)


def _first_end(pane: Column, size_ms: int, slide_ms: int) -> Column:
    """End of the first window that holds a pane."""
    return floor_to(pane - F.lit(size_ms), slide_ms) + F.lit(slide_ms + size_ms)


def _end_after(pane: Column, size_ms: int, slide_ms: int) -> Column:
    """First window end after the last window that holds a pane."""
    return floor_to(pane, slide_ms) + F.lit(size_ms + slide_ms)


def merge_runs(runs: DataFrame, keys: list[str], values: list[str], bucket: str = "_b") -> DataFrame:
    """Stretches that meet with equal ``values`` as one: ``keys, start, stop, values``.

    ``runs`` has stretches ``[start, stop)`` that do not overlap within a key and
    do not cross ``bucket``, which grows with time.  They are put together per
    (key, bucket) first; of each bucket only the first and the last stretch can
    go on in a neighbour, and these (two rows per key and bucket, whatever
    the number of rows) are put together per key.
    """
    inside = _joined(runs.select(*keys, bucket, "start", "stop", *values), [*keys, bucket], values)
    in_bucket = Window.partitionBy(*keys, bucket)
    border = (F.col("start") == F.min("start").over(in_bucket)) | (F.col("stop") == F.max("stop").over(in_bucket))
    marked = inside.withColumn("_part", F.when(~border, F.col(bucket)))
    return _joined(marked, [*keys, "_part"], values).select(*keys, "start", "stop", *values)


def _joined(runs: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """Neighbouring stretches of a group that meet with equal values as one."""
    order = Window.partitionBy(*by).orderBy("start")
    same = F.lag("stop").over(order).eqNullSafe(F.col("start"))
    for v in values:
        same = same & F.lag(v).over(order).eqNullSafe(F.col(v))
    numbered = runs.select(*by, "start", "stop", *values, (~same).cast("int").alias("_opens")).withColumn(
        "_run", F.sum("_opens").over(order)
    )
    return numbered.groupBy(*by, "_run", *values).agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


# ------------------------------------------------------------------ minimum and maximum


def extreme_runs(df: DataFrame, keys: list[str], ts_ms: str, extremes: dict[str, tuple[str, str]], size, slide) -> DataFrame:
    """A8, A9 on W2: runs of extremes per key over sliding windows.

    ``extremes`` maps an output name to ``("min" or "max", column)``.  Returns
    ``keys, _b, start, stop`` and the outputs, cut at bucket borders (``merge_runs``
    joins them).  Rows in which all the columns are null do not count; windows
    without another row are left out.

    Extremes can not be undone, so deltas do not help.  Time is cut into blocks
    as long as the window: a window lies in two neighbouring blocks, and its
    extreme is that of a suffix of the first and a prefix of the second.  Rows
    are aggregated to panes first (map-side combine).  Block ``k`` and the block
    after it meet in group ``k``, on the axis of window ends: a pane at ``p`` of
    the first block is in the windows up to ``p + size``, one of the second in
    those after ``p``.  So one exchange per (key, group) serves the suffix scan,
    from the last row back, the prefix scan and the order of the change points.
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    fold = {out: F.min if kind == "min" else F.max for out, (kind, _) in extremes.items()}
    both = {out: F.least if kind == "min" else F.greatest for out, (kind, _) in extremes.items()}
    def any_set(columns) -> Column:
        return reduce(Column.__or__, [F.col(c).isNotNull() for c in columns])

    pane = floor_to(F.col(ts_ms), _pane_ms(size_ms, slide_ms))
    panes = df.where(any_set(c for _, c in extremes.values())).groupBy(*keys, pane.alias("_p")).agg(
        *[fold[out](c).alias(out) for out, (_, c) in extremes.items()]
    )
    p = F.col("_p")
    block = F.floor(p / F.lit(size_ms)).cast("bigint")
    phase = size_ms % slide_ms

    def group_start(group: Column) -> Column:
        """First window end of a group."""
        bound = (group + 1) * F.lit(size_ms) - F.lit(phase)
        return F.ceil(bound / F.lit(slide_ms)).cast("bigint") * F.lit(slide_ms) + F.lit(phase)

    def row(group: Column, y: Column, kind: int, side: str | None = None) -> Column:
        """A pane's extremes on the side of the suffixes or the prefixes, or a change point without any."""
        held = [
            (F.col(out) if s == side else F.lit(None).cast(panes.schema[out].dataType)).alias(f"_{s}_{out}")
            for s in ("suffix", "prefix") for out in extremes
        ]
        return F.struct(group.alias("_b"), y.alias("_y"), F.lit(kind).alias("_kind"), *held)

    def change(end: Column) -> Column:
        return row(F.floor(end / F.lit(size_ms)).cast("bigint") - 1, end, 0)

    rows = F.array(
        row(block, p + F.lit(size_ms), 1, "suffix"), row(block - 1, p, 1, "prefix"),
        change(_first_end(p, size_ms, slide_ms)), change(_end_after(p, size_ms, slide_ms)),
        row(block, group_start(block), 0),
    )
    spread = panes.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*").repartition(*keys, "_b")
    spread = spread.groupBy(*keys, "_b", "_y", "_kind").agg(
        *[fold[out](f"_{s}_{out}").alias(f"_{s}_{out}") for s in ("suffix", "prefix") for out in extremes]
    )
    group = Window.partitionBy(*keys, "_b")
    behind = group.orderBy("_y", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    # The rows ahead, as those behind from the other end: Spark folds a frame up to the last row anew for each row.
    ahead = group.orderBy(F.desc("_y"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    seen = spread.select(*keys, "_b", "_y", "_kind", *[
        both[out](fold[out](f"_suffix_{out}").over(ahead), fold[out](f"_prefix_{out}").over(behind)).alias(out) for out in extremes
    ]).where("_kind = 0")
    next_end = F.coalesce(F.lead("_y").over(Window.partitionBy(*keys, "_b").orderBy("_y")), group_start(F.col("_b") + 1))
    return seen.select(*keys, "_b", F.col("_y").alias("start"), next_end.alias("stop"), *extremes).where(
        any_set(extremes) & (F.col("stop") > F.col("start"))
    )


def min_max_runs(df: DataFrame, keys: list[str], ts_ms: str, value: str, size, slide) -> DataFrame:
    """A8 on W2: runs of ``min_<value>`` and ``max_<value>``; null values do not count."""
    return extreme_runs(df, keys, ts_ms, {f"min_{value}": ("min", value), f"max_{value}": ("max", value)}, size, slide)


def first_with_min_runs(df: DataFrame, keys: list[str], ts_ms: str, value: str, size, slide) -> DataFrame:
    """A9 on W2: runs of the window's first time (``first_ts``) and ``min_<value>``."""
    return extreme_runs(df, keys, ts_ms, {"first_ts": ("min", ts_ms), f"min_{value}": ("min", value)}, size, slide)


# ------------------------------------------------------------------ distinct users


def distinct_deltas(
    df: DataFrame, keys: list[str], user: str, ts_ms: str, size, slide, bucket="1 day", out: str = "delta"
) -> DataFrame:
    """A5 on W2: deltas whose running sum is the number of distinct users per sliding window.

    Returns ``keys, end, <out>`` as ``windows.window_deltas`` does.  A sighting
    covers the window ends from its first to its last window.  A user counts
    once where sightings overlap, so each adds only what the user's last sighting
    before it does not cover: +1 where its own part begins and -1 where it stops.
    All sightings cover equally much, so the last one before reaches furthest,
    and one ``lag`` per (user, time bucket) finds it: sightings at the end of a
    bucket are copied to the next one as context, so a very active user is
    spread over buckets and no second pass is needed.
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    width = max(duration_ms(bucket), size_ms + slide_ms)
    pane = floor_to(F.col(ts_ms), _pane_ms(size_ms, slide_ms))
    panes = df.where(F.col(user).isNotNull()).select(*keys, F.col(user).alias("_user"), pane.alias("_p")).distinct()
    p = F.col("_p")
    b = F.floor(p / F.lit(width)).cast("bigint")
    reaches = p + F.lit(size_ms + slide_ms) > (b + 1) * F.lit(width)
    places = F.when(reaches, F.array(b, b + 1)).otherwise(F.array(b))
    spread = panes.select(*keys, "_user", "_p", b.alias("_own"), F.explode(places).alias("_b"))
    order = Window.partitionBy(*keys, "_user", "_b").orderBy("_p")
    stop = _end_after(p, size_ms, slide_ms)
    covered = spread.select(
        *keys, (F.col("_own") == F.col("_b")).alias("_mine"), stop.alias("_stop"),
        F.greatest(_first_end(p, size_ms, slide_ms), F.lag(stop).over(order)).alias("_start"),
    ).where(F.col("_mine") & (F.col("_start") < F.col("_stop")))
    ends = F.array(
        F.struct(F.col("_start").alias("end"), F.lit(1).cast("bigint").alias("d")),
        F.struct(F.col("_stop").alias("end"), F.lit(-1).cast("bigint").alias("d")),
    )
    return covered.select(*keys, F.explode(ends).alias("_e")).groupBy(*keys, F.col("_e.end").alias("end")).agg(
        F.sum("_e.d").alias(out)
    )


# ------------------------------------------------------------------ rankings


def top_n_runs(
    runs: DataFrame, key: str, n: int, score: str = "cnt", rank_col: str = "rnk", bucket: str = "_b", salts: int = 16
) -> DataFrame:
    """K1 on W2: stretches of window ends in which a rank is held by one key with one score.

    ``runs`` are a key's stretches of one score, cut at ``bucket`` borders
    (``windows.deltas_to_runs``).  Returns ``rank_col, start, stop, key, score``.

    Within a bucket a ranking changes only where some run starts or stops.
    Runs meet their bucket's change points (at most bucket / slide of them) and
    are cut there, and ``row_number() <= n`` per elementary interval is planned
    with a partial cut in front of its exchange; so what is shuffled grows with
    the change points.  A busy bucket's runs are dealt over ``salts`` tasks by
    key, each with the bucket's points.  Neighbouring intervals in which a rank
    stays as it is are then put together.
    """
    dealt = runs.select(
        key, score, F.col(bucket).alias("_b"), "start", "stop", F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt")
    )
    ends = runs.select(F.col(bucket).alias("_b"), F.explode(F.array("start", "stop")).alias("_at"))
    points = ends.groupBy("_b").agg(F.array_sort(F.collect_set("_at")).alias("_points"))
    all_salts = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    points = points.select("_b", "_points", F.explode(all_salts).alias("_salt"))
    met = dealt.join(points.hint("shuffle_hash"), ["_b", "_salt"])
    first = F.array_position("_points", F.col("start")).cast("int")
    last = F.array_position("_points", F.col("stop")).cast("int")
    cut = F.arrays_zip(
        F.slice("_points", first, last - first).alias("start"), F.slice("_points", first + 1, last - first).alias("stop")
    )
    pieces = met.select(key, score, "_b", F.explode(cut).alias("_c")).select(key, score, "_b", "_c.*")
    ranked = top_n(pieces, ["start"], score, key, n, rank_col)  # intervals of a bucket share no start
    return merge_runs(ranked, [rank_col], [key, score]).select(rank_col, "start", "stop", key, score)
