"""Rising alerts by jump tables against the plain fold, on runs over many blocks."""

import random

import pytest

from eventide.operators import rising
from eventide.plans import jobs
from tests.conftest import SF0001
from tests.test_stateful_batch import fold_rising

SCHEMA = "id string, ts_ms long, seq long, temperature double"


def folded(rows, interval):
    want = []
    for key in {r[0] for r in rows}:
        mine = sorted(r[1:] for r in rows if r[0] == key)
        out, state = fold_rising([key] * len(mine), [m[0] for m in mine], [m[2] for m in mine], interval)
        want += out + ([(key, state[2])] if state[2] is not None else [])
    return sorted(want, key=str)


def alerts(spark, rows, interval):
    df = spark.createDataFrame(rows, SCHEMA)
    got = rising.rising_alerts(df, "id", "ts_ms", "seq", "temperature", interval, bucket=5 * interval)
    return sorted([(r["id"], r["alert_ts"]) for r in got.collect()], key=str)


@pytest.mark.parametrize("fan,levels", [(2, 1), (3, 2), (2, 3), (64, 1)])
@pytest.mark.parametrize("gap", [30, 400, 3_000])
def test_one_long_rise(spark, monkeypatch, fan, levels, gap):
    """A single run over hundreds of intervals, with sparse and dense stretches and equal times."""
    monkeypatch.setattr(rising, "FAN", fan)
    monkeypatch.setattr(rising, "LEVELS", levels)
    rng = random.Random(fan * levels + gap)
    at, rows = -20_000, []
    for i in range(400):
        at += rng.choice([0, 1, gap, gap, 2 * gap, 20 * gap if rng.random() < 0.05 else gap])
        rows.append(("a", at, i, float(i // 2)))
    assert alerts(spark, rows, 1_000) == folded(rows, 1_000)
    assert len(folded(rows, 1_000)) > 5


@pytest.mark.parametrize("seed", range(4))
def test_many_runs_and_keys(spark, monkeypatch, seed):
    monkeypatch.setattr(rising, "FAN", 2)
    monkeypatch.setattr(rising, "LEVELS", 2)
    rng = random.Random(seed)
    rows, value = [], 0.0
    for i in range(500):
        value += rng.choice([0, 1, 1, 1, 1, 1, -9])
        rows.append((rng.choice(["a", "b", None]), rng.randrange(-9_000, 60_000), i, value))
    rows += [("c", 1, 1, None), ("c", 5, 2, 3.0)]
    assert alerts(spark, rows, 700) == folded([r for r in rows if r[3] is not None], 700)


def test_blocks_pass_on_when_they_are_entered_late(spark, monkeypatch):
    """The chain passes a block whose rows all come before it may enter."""
    monkeypatch.setattr(rising, "FAN", 2)
    times = [0, 100, 1_900, 2_050, 2_100, 2_890, 2_950, 4_900, 6_100, 6_200, 9_000]
    rows = [("a", t, i, float(i)) for i, t in enumerate(times)]
    assert alerts(spark, rows, 1_000) == folded(rows, 1_000)


def test_no_python_and_no_whole_run_in_the_plan(spark):
    plan = jobs.rising_alert(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan
