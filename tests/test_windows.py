"""Window assignment, delta sliding counts, top-N and reports."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.functions.time import duration_ms, format_bound, timestamp_text
from eventide.operators import rank, windows

H = 3_600_000


def _rows(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts_ms bigint")
    return df.withColumn("ts", F.timestamp_millis("ts_ms"))


def _set(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_window_boundaries_half_open(spark):
    # exactly at start, end - 1 ms, and at end (belongs to the next window)
    df = _rows(spark, [("a", 0), ("a", H - 1), ("a", H)])
    got = _set(windows.tumbling_count(df, ["k"], "ts", "1 hour"), ["k", "window_end", "cnt"])
    assert got == [("a", H, 2), ("a", 2 * H, 1)]


def test_delta_equals_window_on_boundaries(spark):
    rows = [("a", 0), ("a", 299_999), ("a", 300_000), ("b", 3_599_999), ("b", 3_600_000), (None, 42)]
    df = _rows(spark, rows)
    a = windows.sliding_count(df, ["k"], "ts", "60 minutes", "5 minutes", method="window", ts_ms="ts_ms")
    b = windows.sliding_count(df, ["k"], "ts", "60 minutes", "5 minutes", method="delta", ts_ms="ts_ms")
    assert _set(a, ["k", "window_end", "cnt"]) == _set(b, ["k", "window_end", "cnt"])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 3 * 86_400_000)), min_size=1, max_size=40))
def test_delta_equals_window_property(spark, rows):
    df = _rows(spark, rows)
    a = windows.sliding_count(df, ["k"], "ts", "1 hour", "20 minutes", method="window", ts_ms="ts_ms")
    b = windows.sliding_count(df, ["k"], "ts", "1 hour", "20 minutes", method="delta", ts_ms="ts_ms")
    assert _set(a, ["k", "window_end", "cnt"]) == _set(b, ["k", "window_end", "cnt"])


def test_delta_unkeyed_across_day_buckets(spark):
    # a run that crosses the day bucket boundary, keys = []
    day = 86_400_000
    df = _rows(spark, [("a", day - 1_500), ("a", day - 500), ("a", day + 10_000)])
    a = windows.sliding_count(df, [], "ts", "10 seconds", "1 second", method="window", ts_ms="ts_ms")
    b = windows.sliding_count(df, [], "ts", "10 seconds", "1 second", method="delta", ts_ms="ts_ms")
    assert _set(a, ["window_end", "cnt"]) == _set(b, ["window_end", "cnt"])
    assert len(_set(b, ["window_end", "cnt"])) == 21


def test_hot_key_counts(spark):
    # one key holding every row: counts stay exact
    df = _rows(spark, [("hot", t * 1000) for t in range(0, 7200, 3)])
    b = windows.sliding_count(df, ["k"], "ts", "1 hour", "1 second", method="delta", ts_ms="ts_ms")
    got = dict((r["window_end"], r["cnt"]) for r in b.collect())
    assert got[3_600_000] == 1200
    assert got[1_000] == 1
    assert max(got.values()) == 1200


def test_top_n_ties_by_key(spark):
    df = spark.createDataFrame(
        [(1, "b", 5), (1, "a", 5), (1, "c", 4), (1, "d", 9), (2, "z", 1)], "window_end long, item string, cnt long"
    )
    got = _set(rank.top_n(df, ["window_end"], "cnt", "item", 3), ["window_end", "rnk", "item"])
    assert got == [(1, 1, "d"), (1, 2, "a"), (1, 3, "b"), (2, 1, "z")]


def test_report_layout(spark):
    df = spark.createDataFrame(
        [(1_511_661_600_000, 1, "12224", 2413), (1_511_661_600_000, 2, "7", 3)],
        "window_end long, rnk long, item string, cnt long",
    )
    text = rank.ranked_report(df, "window_end", "item", "cnt").first()["report"]
    assert text == (
        "====================================\n"
        "时间: 2017-11-26 02:00:00.0\n"
        "No1:  商品ID=12224  浏览量=2413\n"
        "No2:  商品ID=7  浏览量=3\n"
        "====================================\n\n"
    )


def test_time_texts(spark):
    df = spark.createDataFrame([(0,), (1_511_658_000_000,), (1_511_658_000_120,), (-1,)], "ms long")
    got = df.select(timestamp_text("ms").alias("t"), format_bound("ms").alias("b")).collect()
    assert [r["t"] for r in got] == [
        "1970-01-01 00:00:00.0", "2017-11-26 01:00:00.0", "2017-11-26 01:00:00.12", "1969-12-31 23:59:59.999",
    ]
    assert got[1]["b"] == "2017/11/26-01:00:00"


def test_duration_parse():
    assert duration_ms("5 minutes") == 300_000
    assert duration_ms("1h") == H
    assert duration_ms(7) == 7


def test_total_from_keyed_deltas(spark):
    from eventide.plans import jobs
    from tests.conftest import SF0001

    size, slide = duration_ms("1 hour"), duration_ms("1 second")
    m = jobs._marketing(spark, SF0001)
    keys = ["channel", "behavior"]
    both = windows.deltas_to_counts(
        windows.with_total_deltas(windows.window_deltas(m, keys, "ts_ms", size, slide), keys), keys, size, slide
    )
    total = both.where("channel = 'total'").select("window_end", "cnt")
    direct = windows.deltas_to_counts(windows.window_deltas(m, [], "ts_ms", size, slide), [], size, slide)
    keyed = windows.deltas_to_counts(windows.window_deltas(m, keys, "ts_ms", size, slide), keys, size, slide)
    assert total.exceptAll(direct).count() == 0 and direct.exceptAll(total).count() == 0
    assert both.where("channel != 'total'").exceptAll(keyed).count() == 0
    assert both.count() == direct.count() + keyed.count()


def test_delta_windows_equal_window_function_when_slide_does_not_divide_size(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randrange(0, 400_000)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, ts_ms long").withColumn("ts", F.timestamp_millis("ts_ms"))
    for size, slide in [("61 seconds", "3 seconds"), ("10 seconds", "3 seconds"), ("90 seconds", "90 seconds")]:
        got = windows.sliding_count(df, ["k"], "ts", size, slide, method="delta")
        want = windows.sliding_count(df, ["k"], "ts", size, slide, method="window")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), (size, slide)
    auto = windows.sliding_count(df, ["k"], "ts", "61 seconds", "3 seconds")
    assert auto.count() > 0


def test_busy_hour_top_n_is_spread_over_tasks(spark):
    keys = spark.range(4000).select(F.concat(F.lit("u"), "id").alias("url"), (F.col("id") % 600 * 1000).alias("ts_ms"))
    deltas = windows.window_deltas(keys, ["url"], "ts_ms", "10 minutes", "5 seconds")
    runs = windows.deltas_to_runs(deltas, ["url"], "10 minutes", "5 seconds", bucket="1 hour")
    held = windows.expand_runs(runs, ["url"], "5 seconds").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(held) > 1 and max(r["count"] for r in held) < 0.6 * sum(r["count"] for r in held)
