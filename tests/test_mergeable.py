"""User-defined mergeable aggregates, and bitmaps rolled up, against plain Python."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from eventide.operators import aggregates, mergeable
from eventide.operators.mergeable import Mergeable
from eventide.plans import jobs
from tests.conftest import SF0001

H = 3_600_000


def _total(acc, xs, ys):
    return (acc[0] + len(xs), acc[1] + int((xs * ys).sum()))


SUM_OF_PRODUCTS = Mergeable(
    lambda: (0, 0), _total, lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda acc: {"n": acc[0], "s": acc[1]},
    "struct<n:bigint,s:bigint>",
)


@pytest.mark.parametrize("keys", [["k", "d"], ["d"], []])
@pytest.mark.parametrize("batch_rows", [7, 1000])
def test_groups_with_null_and_nan_keys(spark, keys, batch_rows):
    rng = random.Random(len(keys))
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.5, None, float("nan")]), rng.choice([None, 1, 2, 3]), rng.randrange(9))
            for _ in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    try:
        df = spark.createDataFrame(rows, "k string, d double, x long, y long").repartition(5)
        got = mergeable.aggregate(df, keys, ["x", "y"], SUM_OF_PRODUCTS, "out").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for k, d, x, y in rows:
        key = tuple({"k": k, "d": str(d)}[c] for c in keys)
        n, s = want.get(key, (0, 0))
        want[key] = (n + 1, s + x * y) if x is not None else (n, s)
    assert {tuple(str(r[c]) if c == "d" else r[c] for c in keys): tuple(r["out"]) for r in got} == want
    assert len(got) == len(want)


def test_a_group_of_nulls_and_an_empty_table(spark):
    sketch = mergeable.histogram_quantiles(1.0, [0.5])
    df = spark.createDataFrame([("a", None), ("b", 3.0)], "k string, v double")
    assert {tuple(r) for r in df.transform(lambda d: mergeable.aggregate(d, ["k"], ["v"], sketch, "q")).select(
        "k", F.get("q", F.lit(0))).collect()} == {("a", None), ("b", 3)}
    assert mergeable.aggregate(df.where("false"), ["k"], ["v"], sketch, "q").count() == 0


def test_a_hot_group_ships_one_accumulator_per_batch(spark):
    df = spark.range(0, 50_000, numPartitions=4).select((F.col("id") % 2).alias("k"), (F.col("id") * 1.0).alias("v"))
    found = mergeable.aggregate(df, ["k"], ["v"], mergeable.histogram_quantiles(100.0, [0.5]), "q")
    assert sorted((r["k"], r["q"][0]) for r in found.collect()) == [(0, 249), (1, 249)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # two phases: what is exchanged comes out of the first
    assert plan.count("MapInArrow") == 2 and plan.index("MapInArrow") < plan.index("Exchange") < plan.rindex("MapInArrow")


@pytest.mark.parametrize("width", [1, 5, 0.5])
def test_histogram_quantiles_are_exact_bins(width):
    rng = random.Random(3)
    values = [rng.randrange(-200, 200) / 4 for _ in range(101)]
    import numpy as np
    agg = mergeable.histogram_quantiles(width, [0.01, 0.5, 0.95, 1.0])
    acc = agg.create()
    for lo in range(0, 101, 10):
        acc = agg.merge(agg.add(agg.create(), np.array(values[lo : lo + 10])), acc)
    ranked = sorted(values)
    want = [int(ranked[max(1, -(-Fraction(p) * 101 // 1)) - 1] // width) for p in ("0.01", "0.5", "0.95", "1")]
    assert agg.result(acc) == want


@pytest.mark.parametrize("size,slide", [("1 day", None), ("6 hours", "1 hour"), ("2 hours", "3 hours"), ("1 hour", None)])
def test_bitmaps_roll_up_to_any_window(spark, size, slide):
    views = jobs._views(spark, SF0001).select("user_id", "ts_ms")
    hourly = aggregates.window_bitmaps(views, "user_id", "ts_ms", "1 hour")
    rolled = aggregates.bitmap_counts(aggregates.roll_up_bitmaps(hourly, "1 hour", size, slide))
    got = {r["window_end"]: r["uv_bitmap"] for r in rolled.collect()}
    hours = {"1 day": 24, "6 hours": 6, "2 hours": 2, "1 hour": 1}[size]
    step = {None: hours, "1 hour": 1, "3 hours": 3}[slide]
    want = {}
    for u, t in views.collect():
        for m in range((t // H - hours) // step + 1, t // H // step + 1):
            want.setdefault((m * step + hours) * H, set()).add(u)
    assert got == {e: len(us) for e, us in want.items()}
    with pytest.raises(ValueError):
        aggregates.roll_up_bitmaps(hourly, "1 hour", "90 minutes")
