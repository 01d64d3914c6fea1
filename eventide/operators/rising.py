"""Rising-run alert (T5): a per-key sequential rule, solved by jump tables.

Scan one key by (ts, seq) holding ``prev`` and an ``armed`` time:

* before a row, if armed and ``row.ts >= armed``: emit (key, armed), disarm;
* first row, or ``temp < prev``: disarm;
* ``temp > prev`` and not armed: arm at ``row.ts + interval``;
* equal temperatures change nothing; then ``prev = temp``.

A timer still armed after the key's last row emits too (end of input).

A drop always disarms, so the stretches between drops - runs - are
independent.  Within a run only the times of its rising rows matter: the first
one arms, and after one at ``t`` the next to arm is the first at or after ``t +
interval``.  The alerts are the nodes of this chain, moved by the interval, up
to the run's drop.

The chain of one long rise is not walked row by row.  A run is cut into time
blocks of ``FAN`` intervals.  The chain enters a block less than one interval
after its start, so a block has a small *jump table*: for each rising row where
the chain may enter, the time before which nothing arms once it has left.  Tables
of ``FAN`` blocks compose to that of their parent, ``LEVELS`` times.  A walk over
a run's top blocks then gives each the time it is entered with, these go down the
levels again, and every block emits its own part of the chain.  All of it is
done by built-in functions on arrays of one block, so no task gets a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import duration_ms
from .prefix import key_struct

# The alert text around the sensor id.
ALERT_PREFIX = "传感器id为: "
ALERT_SUFFIX = "的传感器温度值已经连续1s上升了。"

#: Intervals in a block, and blocks in a block of the next level.
FAN = 64
#: How often blocks are put together before a run's top blocks are walked.
LEVELS = 1

RUN = ["_key", "_run"]
NEVER = -(1 << 62)


def _left_at(entries: Column, exits: Column, t: Column) -> Column:
    """The time before which nothing arms behind a block, if nothing arms before ``t`` when it is reached."""
    k = F.size(F.filter(entries, lambda e: e < t))
    return F.when(k < F.size(entries), F.get(exits, k)).otherwise(t)


def _block_tables(blocks: DataFrame, interval: int) -> DataFrame:
    """Jump tables of the lowest blocks: entries are the rows of the first interval and the one after them."""
    early = F.size(F.filter("_rises", lambda t: t < F.col("_block") * F.lit(FAN * interval) + F.lit(interval)))
    entries = F.slice("_rises", F.lit(1), early + 1)
    chain_end = lambda e: F.aggregate("_rises", e, lambda t, r: F.when(r >= t, r + F.lit(interval)).otherwise(t))
    return blocks.select(*RUN, "_block", entries.alias("_in"), F.transform(entries, chain_end).alias("_out"))


def _with_children(tables: DataFrame, by: list) -> DataFrame:
    """Tables of a level, gathered in time order as ``_kids``."""
    kid = F.struct(F.col("_block").alias("block"), F.col("_in").alias("entries"), F.col("_out").alias("exits"))
    return tables.groupBy(*by).agg(F.array_sort(F.collect_list(kid)).alias("_kids"))


def _parents(tables: DataFrame) -> DataFrame:
    """Tables of the next level, with their children."""
    gathered = _with_children(tables, [*RUN, F.floor(F.col("_block") / F.lit(FAN)).alias("_block")])
    kids = F.col("_kids")
    entries = F.concat(F.get(kids, 0)["entries"], F.slice(F.coalesce(F.get(kids, 1)["entries"], F.array()), 1, 1))
    through = lambda e: F.aggregate(kids, e, lambda t, k: _left_at(k["entries"], k["exits"], t))
    return gathered.select(*RUN, "_block", "_kids", entries.alias("_in"), F.transform(entries, through).alias("_out"))


def _walked(kids: Column, t: Column) -> Column:
    """Each child with the time it is reached with."""
    start = F.struct(t.alias("t"), F.array().cast("array<struct<block:bigint,t:bigint>>").alias("seen"))
    step = lambda s, k: F.struct(
        _left_at(k["entries"], k["exits"], s["t"]).alias("t"),
        F.concat(s["seen"], F.array(F.struct(k["block"].alias("block"), s["t"].alias("t")))).alias("seen"),
    )
    return F.aggregate(kids, start, step, lambda s: s["seen"])


def _chain(rises: Column, t: Column, interval: int) -> Column:
    """Alert times of a block that is reached with ``t``."""
    start = F.struct(t.alias("t"), F.array().cast("array<bigint>").alias("fired"))
    armed = lambda r: r + F.lit(interval)
    step = lambda s, r: F.when(
        r >= s["t"], F.struct(armed(r).alias("t"), F.concat(s["fired"], F.array(armed(r))).alias("fired"))
    ).otherwise(s)
    return F.aggregate(rises, start, step, lambda s: s["fired"])


def chain_alerts(blocks: DataFrame, interval: int) -> DataFrame:
    """Adds ``alert_ts``: one row for every node of the runs' chains.

    ``blocks`` has ``_key, _run, _block, _rises``, the sorted times of a run's
    rising rows in each block of ``FAN`` intervals, and more columns that are kept.
    """
    levels = [_block_tables(blocks, interval)]
    for _ in range(LEVELS):
        levels.append(_parents(levels[-1]))
    top = _with_children(levels[-1], RUN)
    reached = top.select(*RUN, F.explode(_walked(F.col("_kids"), F.lit(NEVER).cast("bigint"))).alias("_k"))
    for tables in reversed(levels[1:]):
        at = reached.select(*RUN, F.col("_k.block").alias("_block"), F.col("_k.t").alias("_t"))
        met = tables.select(*RUN, "_block", "_kids").join(at, [*RUN, "_block"])
        reached = met.select(*RUN, F.explode(_walked(F.col("_kids"), F.col("_t"))).alias("_k"))
    at = reached.select(*RUN, F.col("_k.block").alias("_block"), F.col("_k.t").alias("_t"))
    met = blocks.join(at, [*RUN, "_block"])
    return met.select(*blocks.columns, F.explode(_chain(F.col("_rises"), F.col("_t"), interval)).alias("alert_ts"))


def _numbered_runs(rows: DataFrame, key: str, ts_ms: str, seq: str, value: str, bucket_ms: int) -> DataFrame:
    """``_key, ts, _rise, _run``: whether a row's value rose, and how many drops its key had up to it.

    Rows are partitioned once, by (key, time bucket).  A bucket needs the last
    value and the number of drops before it, and both come from one narrow table
    of each bucket's first and last value and inner drops.
    """
    bucket = F.floor(F.col(ts_ms) / F.lit(bucket_ms)).cast("bigint")
    spread = rows.select(
        key_struct([key]).alias("_key"), F.coalesce(bucket, F.lit(0)).alias("_b"), F.col(ts_ms).alias("_ts"),
        F.col(seq).alias("_seq"), F.col(value).alias("_v"),
    ).repartition("_key", "_b")
    order = Window.partitionBy("_key", "_b").orderBy("_ts", "_seq")
    seen = spread.withColumn("_before", F.lag("_v").over(order)).withColumn(
        "_dropped", (F.col("_v") < F.col("_before")).cast("bigint")
    )
    at = F.struct("_ts", "_seq")
    table = seen.groupBy("_key", "_b").agg(
        F.min_by("_v", at).alias("_first_v"), F.max_by("_v", at).alias("_last_v"),
        F.coalesce(F.sum("_dropped"), F.lit(0)).alias("_inner"),
    )
    buckets = Window.partitionBy("_key").orderBy("_b")
    came_in = table.withColumn("_prev_v", F.lag("_last_v").over(buckets)).withColumn(
        "_enters", (F.col("_prev_v").isNull() | (F.col("_first_v") < F.col("_prev_v"))).cast("bigint")
    ).withColumn("_runs", F.sum(F.col("_inner") + F.col("_enters")).over(buckets) - F.col("_inner"))
    joined = seen.join(came_in.select("_key", "_b", "_prev_v", "_runs").hint("shuffle_hash"), ["_key", "_b"])
    return joined.select(
        "_key", F.col("_ts").alias(ts_ms), (F.col("_v") > F.coalesce("_before", "_prev_v")).alias("_rise"),
        (F.col("_runs") + F.coalesce(F.sum("_dropped").over(order), F.lit(0))).alias("_run"),
    )


def rising_alerts(
    df: DataFrame,
    key: str,
    ts_ms: str,
    seq: str,
    value: str,
    interval="1 second",
    bucket="1 hour",
) -> DataFrame:
    """(id, alert_ts, msg) for every rise that held for ``interval``.

    Runs that end before their first timer are left out before any table is
    built; the others go through ``chain_alerts``.
    """
    interval_ms = duration_ms(interval)
    rows = df.where(F.col(value).isNotNull()).withColumn(key, F.col(key).cast("string"))
    rows = _numbered_runs(rows, key, ts_ms, seq, value, duration_ms(bucket))
    block = F.floor(F.col(ts_ms) / F.lit(FAN * interval_ms)).cast("bigint")
    blocks = rows.groupBy("_key", "_run", block.alias("_block")).agg(
        F.array_sort(F.collect_set(F.when(F.col("_rise"), F.col(ts_ms)))).alias("_rises"), F.min(ts_ms).alias("_start")
    )
    runs = blocks.groupBy(*RUN).agg(F.min("_start").alias("_start"), F.min(F.get("_rises", F.lit(0))).alias("_first"))
    # A run ends with the next one's first row, its drop; the key's last run does not end.
    drops = runs.select("_key", (F.col("_run") - 1).alias("_run"), F.col("_start").alias("_end"))
    firing = runs.join(drops, RUN, "left").where(
        F.col("_first").isNotNull() & (F.col("_end").isNull() | (F.col("_end") >= F.col("_first") + F.lit(interval_ms)))
    ).select(*RUN, "_end")
    rising = blocks.where(F.size("_rises") > 0).select(*RUN, "_block", "_rises").join(firing, RUN)
    fired = chain_alerts(rising, interval_ms).where(F.col("_end").isNull() | (F.col("alert_ts") <= F.col("_end")))
    sensor = F.col(f"_key.{key}")
    return fired.select(
        sensor.alias("id"), "alert_ts", F.concat(F.lit(ALERT_PREFIX), sensor, F.lit(ALERT_SUFFIX)).alias("msg")
    )
