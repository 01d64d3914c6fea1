"""Strict-contiguity sequence detection.

A match is ``len(steps)`` *adjacent* rows of one key (ordered by time, then
sequence number) where row i satisfies ``steps[i]`` and the last row is less
than ``within`` after the first.  Overlapping matches are all reported.

Hot keys: rather than ordering all rows of a key in one task, rows are cut
into time buckets of width ``within``.  A match starting in bucket b ends
before ``(b + 2) * within``, so the partition (key, b) holds bucket b's rows
as possible starts plus bucket b+1's rows as continuations.  Every row is
shipped twice; no task holds more than two buckets of one key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import duration_ms

Step = Callable[[Callable[[str], Column]], Column]


def strict_sequence(
    df: DataFrame,
    keys: list[str],
    ts_ms: str,
    seq: str,
    steps: list[Step],
    within,
    emit: list[str],
    names: list[str] | None = None,
    split_by_time: bool = True,
) -> DataFrame:
    """Return keys + ``{name}_{col}`` for each step and each ``emit`` column.

    ``steps[i]`` receives an accessor ``get(col)`` for the i-th row of the
    candidate and returns a boolean Column, e.g. ``lambda r: r('status') == 'fail'``.
    """
    within_ms = duration_ms(within)
    n = len(steps)
    names = names or [f"s{i + 1}" for i in range(n)]
    needed = sorted({ts_ms, seq, *emit, *[c for c in df.columns if c not in keys]})
    base = df.select(*keys, *needed)

    if split_by_time:
        b = F.floor(F.col(ts_ms) / F.lit(within_ms)).cast("bigint")
        home = base.withColumn("_part", b).withColumn("_home", F.lit(True))
        # a match that starts in one bucket ends among the first n - 1 rows of the next;
        # the limit is cut map-side (WindowGroupLimit), so few rows travel twice
        order = Window.partitionBy(*keys, "_part").orderBy(F.col(ts_ms), F.col(seq))
        ahead = home.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") < n)
        ahead = ahead.drop("_nth").withColumn("_part", F.col("_part") - 1).withColumn("_home", F.lit(False))
        base = home.unionByName(ahead)
        part_cols = [*keys, "_part"]
    else:
        base = base.withColumn("_home", F.lit(True))
        part_cols = list(keys)

    w = Window.partitionBy(*part_cols).orderBy(F.col(ts_ms), F.col(seq))

    def getter(i: int) -> Callable[[str], Column]:
        return (lambda c: F.col(c)) if i == 0 else (lambda c, i=i: F.lead(F.col(c), i).over(w))

    cond = F.col("_home")
    for i, step in enumerate(steps):
        cond = cond & F.coalesce(step(getter(i)), F.lit(False))
    last_ts = getter(n - 1)(ts_ms)
    cond = cond & (last_ts - F.col(ts_ms) < F.lit(within_ms))

    cols = [getter(i)(c).alias(f"{names[i]}_{c}") for i in range(n) for c in emit]
    return base.select(*keys, cond.alias("_match"), *cols).where("_match").drop("_match")
