"""Limiter, sequence, gate, rising run, alarms: edge fixtures and hand goldens."""


import pytest
from pyspark.sql import functions as F

from eventide.operators import gate, late, rising, routing, sequence
from eventide.sources import literals

DAY = 86_400_000


def fold_rising(ids, ts, temps, interval_ms: int, state=None):
    """Fold sorted rows; ``state`` = (key, prev, armed) carried between calls.

    Returns (alerts, state) with alerts as (id, alert_ts) tuples; the caller
    flushes a still-armed timer when the key changes or the input ends.
    """
    out = []
    key, prev, armed = state if state else (None, None, None)
    for k, t, v in zip(ids, ts, temps):
        if k != key:
            if key is not None and armed is not None:
                out.append((key, armed))
            key, prev, armed = k, None, None
        if armed is not None and t >= armed:
            out.append((key, armed))
            armed = None
        if prev is None or v < prev:
            armed = None
        elif v > prev and armed is None:
            armed = t + interval_ms
        prev = v
    return out, (key, prev, armed)


def _clicks(spark, rows):
    return spark.createDataFrame(rows, "user_id long, ad_id long, province string, ts_ms long, seq long")


def test_limiter_quirk_counts(spark):
    # 121 clicks of one pair in a day, max 100 -> 101 pass, 1 warning, 19 dropped
    base = 1_511_658_000_000
    rows = [(937166, 1715, "beijing", base + i * 1000, i) for i in range(121)]
    rows += [(161501, 36156, "guangdong", base + i, 1000 + i) for i in range(4)]
    routed = routing.daily_limit(_clicks(spark, rows), ["user_id", "ad_id"], "ts_ms", "seq", 100)
    main, side = routing.limiter_outputs(routed, ["user_id", "ad_id"], 100)
    assert main.count() == 101 + 4
    warn = side.collect()
    assert len(warn) == 1 and warn[0]["msg"] == "Click over 100 times today."
    assert warn[0]["user_id"] == "937166"


def test_limiter_edges_and_midnight(spark):
    m = 2
    rows = []
    seq = 0
    for n in (m, m + 1, m + 2, m + 3):  # users 1..4 click n times before midnight
        for i in range(n):
            rows.append((n, 1, "p", DAY - 10_000 + i, seq))
            seq += 1
    rows += [(m + 3, 1, "p", DAY + 5, seq), (m + 3, 1, "p", DAY + 6, seq + 1)]  # next day resets
    routed = routing.daily_limit(_clicks(spark, rows), ["user_id", "ad_id"], "ts_ms", "seq", m)
    got = {}
    for r in routed.collect():
        got.setdefault((r["user_id"], r["_day"]), []).append(r["route"])
    assert got[(m, 0)].count("pass") == m and "warn" not in got[(m, 0)]
    assert got[(m + 1, 0)].count("pass") == m + 1 and "warn" not in got[(m + 1, 0)]
    assert got[(m + 2, 0)].count("pass") == m + 1 and got[(m + 2, 0)].count("warn") == 1
    assert len(got[(m + 3, 0)]) == m + 2  # one row silently dropped
    assert got[(m + 3, 1)] == ["pass", "pass"]
    strict = routing.daily_limit(_clicks(spark, rows), ["user_id"], "ts_ms", "seq", m, inclusive_quirk=False)
    assert strict.where("user_id = 4 and _day = 0 and route = 'pass'").count() == m


def _fail(r):
    return r("status") == "fail"


def test_login_sequence_literal(spark):
    df = literals.logins(spark)
    res = sequence.strict_sequence(df, ["user_id"], "ts_ms", "seq", [_fail] * 3, "10 seconds",
                                   emit=["ip"], names=["x", "y", "z"])
    assert [tuple(r) for r in res.collect()] == [("1", "192.168.0.1", "192.168.0.2", "192.168.0.3")]


def _logins(spark, rows):
    return spark.createDataFrame(rows, "user_id string, status string, ts_ms long, seq long")


def test_sequence_span_and_overlap(spark):
    rows = [
        ("a", "fail", 0, 0), ("a", "fail", 5_000, 1), ("a", "fail", 9_999, 2),   # span 9.999 s: match
        ("b", "fail", 0, 3), ("b", "fail", 5_000, 4), ("b", "fail", 10_000, 5),  # span 10 s: none
        ("c", "fail", 0, 6), ("c", "fail", 1, 7), ("c", "fail", 2, 8), ("c", "fail", 3, 9),  # 2 matches
        ("d", "fail", 0, 10), ("d", "success", 1, 11), ("d", "fail", 2, 12), ("d", "fail", 3, 13),
    ]
    for split in (True, False):
        res = sequence.strict_sequence(_logins(spark, rows), ["user_id"], "ts_ms", "seq", [_fail] * 3,
                                       "10 seconds", emit=["seq"], split_by_time=split)
        got = sorted(tuple(r) for r in res.collect())
        assert got == [("a", 0, 1, 2), ("c", 6, 7, 8), ("c", 7, 8, 9)]


def test_sequence_across_time_buckets(spark):
    # a match straddling a bucket boundary is found once
    rows = [("a", "fail", 9_000, 0), ("a", "fail", 10_500, 1), ("a", "fail", 18_000, 2), ("a", "fail", 19_000, 3)]
    res = sequence.strict_sequence(_logins(spark, rows), ["user_id"], "ts_ms", "seq", [_fail] * 3,
                                   "10 seconds", emit=["seq"])
    assert sorted(tuple(r) for r in res.collect()) == [("a", 0, 1, 2), ("a", 1, 2, 3)]


def test_gate_union_of_intervals(spark):
    controls = spark.createDataFrame(
        [("s1", 1000, 5000), ("s1", 2000, 1000), ("s1", 4000, 4000), ("s2", 0, 2000)],
        "cid string, cts long, dur long",
    )  # s1 open [1000, 8000); s2 open [0, 2000)
    readings = spark.createDataFrame(
        [("s1", 999, 0), ("s1", 1000, 1), ("s1", 7999, 2), ("s1", 8000, 3), ("s2", 1999, 4),
         ("s2", 2000, 5), ("s3", 1500, 6)],
        "id string, ts_ms long, seq long",
    )
    res = gate.timed_gate(readings, controls, "id", "ts_ms", "cid", "cts", "dur", seq="seq", bucket="3 seconds")
    assert sorted(r["seq"] for r in res.collect()) == [1, 2, 4]


def test_gate_literal_controls(spark):
    ctl = literals.gate_controls(spark, at_ms=0)
    readings = spark.createDataFrame([("sensor_2", 1999), ("sensor_2", 2000), ("sensor_7", 6999), ("sensor_1", 0)],
                                     "id string, ts_ms long")
    res = gate.timed_gate(readings, ctl, "id", "ts_ms", "id", "ts_ms", "duration_ms")
    assert sorted(tuple(r) for r in res.collect()) == [("sensor_2", 1999), ("sensor_7", 6999)]


def test_rising_fold_rules():
    fold = fold_rising
    # strict rise held 1 s fires at arm time; a later row after the deadline re-arms on rise
    out, st = fold(["a"] * 4, [0, 100, 200, 1500], [1.0, 2.0, 3.0, 4.0], 1000)
    assert out == [("a", 1100)] and st[2] == 2500
    # equal values keep the timer; drop before deadline cancels; drop exactly at deadline fires first
    out, _ = fold(["a"] * 4, [0, 100, 500, 900], [1.0, 2.0, 2.0, 1.0], 1000)
    assert out == []
    out, _ = fold(["a"] * 3, [0, 100, 1100], [1.0, 2.0, 1.0], 1000)
    assert out == [("a", 1100)]
    # a true 0.0 reading is an ordinary value; first row never arms
    out, st = fold(["a"] * 2, [0, 10], [0.0, 0.5], 1000)
    assert out == [] and st[2] == 1010
    # key change flushes a still-armed timer
    out, st = fold(["a", "a", "b"], [0, 10, 20], [1.0, 2.0, 5.0], 1000)
    assert out == [("a", 1010)] and st == ("b", 5.0, None)


def test_rising_alerts_batch(spark):
    rows = [("a", 0, 0, 1.0), ("a", 100, 1, 2.0), ("a", 5000, 2, 3.0), ("b", 0, 3, 5.0), ("b", 10, 4, 4.0)]
    df = spark.createDataFrame(rows, "id string, ts_ms long, seq long, temperature double")
    res = rising.rising_alerts(df, "id", "ts_ms", "seq", "temperature", "1 second")
    assert sorted((r["id"], r["alert_ts"]) for r in res.collect()) == [("a", 1100), ("a", 6000)]
    assert res.first()["msg"].startswith("传感器id为: a")


def test_alarms(spark):
    df = spark.createDataFrame([("s1", 31.9), ("s2", 32.0), ("s3", -5.0)], "id string, temperature double")
    got = sorted(r["msg"] for r in routing.threshold_alarm(df, "id", "temperature", 32.0).collect())
    assert got == ["Freezing Alarm for s1", "Freezing Alarm for s3"]
    fixed = routing.threshold_alarm(df, "id", "temperature", 1000.0, fixed_text=routing.LOW_TEMPERATURE_TEXT)
    assert fixed.count() == 3


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40), st.sampled_from([1.0, 2.0, 3.0, 0.0])),
                min_size=1, max_size=60))
def test_rising_parallel_runs_equal_sequential_fold(spark, rows):
    # times in 0.5 s steps over 20 s, buckets of 3 s: runs cross buckets, keys are hot
    data = [(k, t * 500, i, v) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id string, ts_ms long, seq long, temperature double")
    got = sorted((r["id"], r["alert_ts"]) for r in
                 rising.rising_alerts(df, "id", "ts_ms", "seq", "temperature", "1 second", bucket="3 seconds").collect())
    want = []
    for key in ("a", "b"):
        mine = sorted((t, s, v) for k, t, s, v in data if k == key)
        if mine:
            out, st_ = fold_rising([key] * len(mine), [m[0] for m in mine], [m[2] for m in mine], 1000)
            want += out + ([(key, st_[2])] if st_[2] is not None else [])
    assert got == sorted(want)


def test_late_split_keeps_rows_without_arrival_time(spark):
    rows = [(1, 1000, 1000), (2, 9_000_000, None), (3, 2000, 5000)]
    df = spark.createDataFrame(rows, "seq long, ts_ms long, arrival_ms long")
    got = {r["seq"]: r["is_late"] for r in late.late_split(df, "ts_ms", "arrival_ms", "seq", "1 second").collect()}
    assert got == {1: True, 2: False, 3: True}  # no arrival time: taken as the first to arrive


def test_limiter_counts_equal_the_ranked_routes(spark):
    rows = [(u, 1, "p", DAY * d + i, i) for u in range(6) for d in (0, 1) for i in range(u * (d + 1))]
    clicks = _clicks(spark, rows)
    for quirk in (True, False):
        routed = routing.daily_limit(clicks, ["user_id"], "ts_ms", "seq", 2, quirk)
        want = {r["route"]: r["count"] for r in routed.groupBy("route").count().collect()}
        got = {r["route"]: r["n"] for r in routing.limiter_counts(clicks, ["user_id"], "ts_ms", 2, quirk).collect()}
        assert got == {**want, "drop": len(rows) - sum(want.values())}
    empty = routing.limiter_counts(clicks.where("false"), ["user_id"], "ts_ms", 2).collect()
    assert {r["route"]: r["n"] for r in empty} == {"pass": 0, "warn": 0, "drop": 0}


def test_routes_are_written_and_counted_in_one_job(spark, scratch):
    rows = [(u, 1, "p", 100 + i, i) for u in range(5) for i in range(u)]
    routed = routing.daily_limit(_clicks(spark, rows), ["user_id"], "ts_ms", "seq", 1)
    seen = spark.sparkContext.accumulator(0)
    counting = routed.rdd.map(lambda r: (seen.add(1), r)[1])  # rows computed, whatever reads them
    written, counts = routing.write_routes(spark.createDataFrame(counting, routed.schema), scratch, ["pass", "warn", "none"])
    assert counts == {"pass": 7, "warn": 2, "none": 0} and seen.value == 9
    for name, df in written.items():
        assert df.columns == [c for c in routed.columns if c != "route"]
        assert sorted(df.collect()) == sorted(routed.where(F.col("route") == name).drop("route").collect())
    with pytest.raises(Exception, match="unknown route"):
        routing.write_routes(routed, scratch, ["pass"])
