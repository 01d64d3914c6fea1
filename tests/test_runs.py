"""Run-form window results against enumerating every window."""

import random
import re

import pytest
from pyspark.sql import functions as F

from eventide.functions.time import floor_to
from eventide.operators import aggregates, late, prefix, runs, windows
from eventide.plans import jobs
from tests.conftest import SF0001

H = 3_600_000
SIZES = [(6_000, 1_000), (10_000, 4_000), (7_000, 3_000), (5_000, 5_000), (4_000, 9_000), (3_000, 2_000)]


def ends_of(t, size, slide):
    """Ends of the windows ``[m * slide, m * slide + size)`` that hold ``t``."""
    first = (t - size) // slide + 1
    return [m * slide + size for m in range(first, t // slide + 1)]


def expanded(rows, slide):
    return {(*r[:-2], e): None for r in rows for e in range(r[-2], r[-1], slide)}


def _events(spark, n, span, seed, keys=("a", "b", None)):
    rng = random.Random(seed)
    rows = [(rng.choice(keys), rng.randrange(12), rng.randrange(-span // 2, span), rng.choice([None, *range(9)])) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "k string, u long, ts_ms long, v long")


@pytest.mark.parametrize("size,slide", SIZES)
@pytest.mark.parametrize("n", [0, 60])
def test_extreme_runs_equal_every_window(spark, size, slide, n):
    rows, df = _events(spark, n, 90_000, size)
    want = {}
    for k, _, t, v in rows:
        if v is not None:
            for e in ends_of(t, size, slide):
                want.setdefault((k, e), []).append(v)
    found = runs.min_max_runs(df, ["k"], "ts_ms", "v", size, slide)
    got = {}
    for r in found.collect():
        for e in range(r["start"], r["stop"], slide):
            assert (r["k"], e) not in got
            got[(r["k"], e)] = (r["min_v"], r["max_v"])
    assert got == {ke: (min(vs), max(vs)) for ke, vs in want.items()}
    merged = runs.merge_runs(found, ["k"], ["min_v", "max_v"]).collect()
    by_start = {(r["k"], r["start"]): r for r in merged}
    for r in merged:  # no two stretches with one result meet
        after = by_start.get((r["k"], r["stop"]))
        assert after is None or (after["min_v"], after["max_v"]) != (r["min_v"], r["max_v"])
    assert sum((r["stop"] - r["start"]) // slide for r in merged) == len(got)


def test_extreme_runs_equal_the_window_operator(spark):
    ev = jobs._sensors(spark, SF0001).withColumn("id", F.col("id").substr(1, 1))
    want = aggregates.min_max(ev, ["id"], "ts", "temperature", "12 hours", "3 hours")
    got = windows.expand_runs(
        runs.min_max_runs(ev, ["id"], "ts_ms", "temperature", "12 hours", "3 hours")
        .withColumn("both", F.struct("min_temperature", "max_temperature")), ["id"], "3 hours", "both")
    got = got.select("id", "both.*", "window_end")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("size,slide", [(60_000, 2_000), (50_000, 2_900)])
def test_often_overlapping_windows_take_the_run_form(spark, monkeypatch, size, slide):
    """Minimum, maximum and reduce of windows with and without the run form have the same rows."""
    _, df = _events(spark, 80, 400_000, slide)
    df = df.withColumn("ts", F.timestamp_millis("ts_ms")).withColumn("seq", F.monotonically_increasing_id())
    jobs_of = [
        lambda: aggregates.min_max(df, ["k"], "ts", "v", size, slide),
        lambda: aggregates.first_with_min(df, ["k"], "ts", "ts_ms", "seq", "v", size, slide),
    ]
    in_runs = [job() for job in jobs_of]
    assert all("explode(sequence(start" in r._jdf.queryExecution().optimizedPlan().toString() for r in in_runs)
    monkeypatch.setattr(aggregates, "DELTA_RATIO_THRESHOLD", 10_000)
    for got, job in zip(in_runs, jobs_of):
        want = job()
        assert got.columns == want.columns and got.count() == want.count()
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("size,slide", SIZES)
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_distinct_users_equal_every_window(spark, size, slide, keys):
    rows, df = _events(spark, 80, 90_000, slide)
    want = {}
    for k, u, t, _ in rows:
        for e in ends_of(t, size, slide):
            want.setdefault((*([k] if keys else []), e), set()).add(u)
    deltas = runs.distinct_deltas(df, keys, "u", "ts_ms", size, slide, bucket=20_000)
    got = windows.deltas_to_counts(deltas, keys, size, slide, out="uv").collect()
    assert {tuple(r)[:-1]: r["uv"] for r in got} == {ke: len(us) for ke, us in want.items()}
    assert len(got) == len(want)


def test_a_hot_user_is_spread_over_buckets(spark):
    """One user with all sightings: no (user, bucket) group holds more than two buckets' panes."""
    df = spark.range(48 * 60).select(F.expr("id div 1000000").alias("u"), (F.col("id") * 60_000).alias("ts_ms"))
    deltas = runs.distinct_deltas(df, [], "u", "ts_ms", H, 60_000, bucket="2 hours")
    plan = deltas._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_user#\d+L, _b#", plan) and "SinglePartition" not in plan
    counts = windows.deltas_to_counts(deltas, [], H, 60_000, out="uv").collect()
    assert {r["uv"] for r in counts} == {1} and len(counts) == 48 * 60 + 59


def test_merge_runs_across_buckets(spark):
    rng = random.Random(5)
    for _ in range(5):
        rows, at = [], 0
        for b in range(12):
            while at < (b + 1) * 10:
                stop = min(at + rng.choice([1, 3, 10]), (b + 1) * 10)
                if rng.random() < 0.8:
                    rows.append(("k", b, at, stop, rng.choice([1, 1, 1, None])))
                at = stop
        df = spark.createDataFrame(rows, "k string, _b long, start long, stop long, v long")
        got = sorted(tuple(r) for r in runs.merge_runs(df, ["k"], ["v"]).collect())
        want = []
        for k, _, start, stop, v in rows:
            if want and want[-1][2] == start and want[-1][3] == v:
                want[-1] = (k, want[-1][1], stop, v)
            else:
                want.append((k, start, stop, v))
        assert got == sorted(want)


@pytest.mark.parametrize("n", [1, 3])
def test_top_n_runs_expand_to_the_ranking(spark, n):
    _, df = _events(spark, 200, 200_000, n, keys=tuple("abcdef"))
    size, slide = 20_000, 1_000
    deltas = windows.window_deltas(df, ["k"], "ts_ms", size, slide)
    want = windows.deltas_top_n(deltas, "k", size, slide, n).select("rnk", "window_end", "k", "cnt")
    counted = windows.deltas_to_runs(deltas, ["k"], size, slide, bucket=30_000)
    found = runs.top_n_runs(counted, "k", n)
    got = windows.expand_runs(found.withColumn("r", F.struct("rnk", "k")), ["r"], slide, "cnt").select(
        "r.rnk", "window_end", "r.k", "cnt")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("kind", ["sum", "max", "min"])
@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("inclusive", [True, False])
def test_scan_of_spans_equals_the_plain_scan(spark, kind, keys, inclusive):
    _, df = _events(spark, 300, 3_000_000_000, 1)
    df = df.withColumn("id", F.monotonically_increasing_id()).withColumn(
        "b", F.when(F.col("ts_ms") % 7 != 0, floor_to(F.col("ts_ms"), 60_000) / 60_000).cast("bigint")
    ).withColumn("t", F.when(F.col("b").isNotNull(), F.col("ts_ms")))
    plain, spanned = [
        prefix.bucketed_running(df, keys, "b", ["t", "id"], "v", "r", kind, inclusive, spans=s) for s in (False, True)
    ]
    assert plain.exceptAll(spanned).isEmpty() and spanned.count() == 300


# ------------------------------------------------------------------ plans


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_window_is_expanded_in_run_form(spark):
    for job in (jobs.station_minmax_runs, jobs.hot_urls_runs, jobs.marketing_runs):
        plan = _plan(job(spark, SF0001))
        assert "explode(sequence(start" not in plan and "window(" not in plan, job.__name__


def test_extremes_are_scanned_from_one_end(spark):
    """Spark folds a frame that reaches to the last row anew for each row: the square of a group's rows."""
    for job in (jobs.station_minmax_runs, jobs.station_reduce_runs):
        plan = job(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "unboundedpreceding$(), currentrow$()" in plan and "currentrow$(), unboundedfollowing$()" not in plan, job.__name__


def test_extremes_of_a_dense_group_match_a_scan(spark):
    """An hour with a reading in every second of one key, and a sparse one beside it."""
    rng = random.Random(11)
    dense = [("d", t * 1000, float(rng.randrange(1000))) for t in range(7200)]
    sparse = [("s", rng.randrange(7_200_000), None if k % 5 == 0 else float(k)) for k in range(40)]
    df = spark.createDataFrame(dense + sparse, "k string, ts_ms long, v double")
    found = runs.merge_runs(runs.min_max_runs(df, ["k"], "ts_ms", "v", H, 1000), ["k"], ["min_v", "max_v"]).collect()
    got = {(r["k"], e): (r["min_v"], r["max_v"]) for r in found for e in range(r["start"], r["stop"], 1000)}
    assert len(got) == sum((r["stop"] - r["start"]) // 1000 for r in found)
    held = {k: [(t, v) for key, t, v in dense + sparse if key == k and v is not None] for k in "ds"}
    for k in "ds":
        for e in [*range(1000, 10_802_000, 97_000), *rng.sample(range(1000, 10_802_000, 1000), 60)]:
            inside = [v for t, v in held[k] if e - H <= t < e]
            assert got.get((k, e)) == ((min(inside), max(inside)) if inside else None), (k, e)


def test_top_n_runs_are_cut_before_their_exchange(spark):
    plan = jobs.hot_urls_runs(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_unkeyed_carries_are_not_one_task_per_history(spark):
    """What is brought into one partition are spans, not buckets."""
    arrivals = jobs._arrivals(spark, SF0001)
    plan = late.late_split(arrivals, "ts_ms", "arrival_ms", "seq", "1 hour")._jdf.queryExecution().executedPlan().toString()
    single = plan.split("Exchange SinglePartition")[1:]
    assert single
    for below in single:
        assert "_span" in below.splitlines()[1] and "_pbucket" not in below.splitlines()[1]
