"""Physical-plan properties the operators are designed for (scale guards)."""

import re

from eventide.operators import routing
from eventide.plans import jobs
from tests.conftest import SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filter_pushdown_and_column_pruning(spark):
    text = _formatted(jobs.page_views(spark, SF0001))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    assert len(pushed) == 1 and "EqualTo(event_type,view)" in pushed[0]
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert schemas == ["struct<ts:timestamp_ntz,event_type:string>"]


def test_limiter_top_k_is_partial_before_shuffle(spark):
    routed = routing.daily_limit(jobs._clicks(spark, SF0001), ["user_id"], "ts_ms", "seq", 1)
    plan = _plan(routed)
    # one WindowGroupLimit above the exchange (final) and one below it (partial)
    assert plan.count("WindowGroupLimit") == 2
    below = plan.split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below


def test_top_n_is_cut_before_the_exchange_on_window_end(spark):
    plan = _plan(jobs.hot_urls(spark, SF0001))
    above, below = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in above and "Generate" not in above
    # right below the exchange: the partial cut, then the expansion of runs
    stage = below.split("Exchange", 1)[0]
    assert stage.index("WindowGroupLimit") < stage.index("Generate explode(sequence")


def test_no_sort_aggregate_on_raw_rows(spark):
    for job in (jobs.unique_visitors_running, jobs.sensor_reduce, jobs.sensor_early):
        assert "SortAggregate" not in _plan(job(spark, SF0001)), job.__name__


def test_page_side_is_built_in_the_url_join(spark):
    plan = _plan(jobs.hot_url_deltas(spark, SF0001))
    assert "BuildRight" in plan and "BuildLeft" not in plan


def test_delta_counts_pin_partitions(spark):
    df = jobs.marketing_total(spark, SF0001)
    assert "REPARTITION_BY_NUM" in _plan(df)


def test_carry_join_is_not_broadcast(spark):
    plan = _plan(jobs.marketing_by_channel(spark, SF0001))
    assert "ShuffledHashJoin" in plan
    assert "BroadcastHashJoin" not in plan


def test_a_line_is_split_once_and_scanned_once(spark):
    for job in (jobs.ad_click_lines, jobs.action_lines, jobs.action_line_counts, jobs.access_log_lines, jobs.keyed_lines):
        plan = _plan(job(spark, SF0001))
        assert plan.count("split(") == 1 and plan.count("FileScan") == 1, job.__name__


def test_limiter_counts_do_not_rank(spark):
    plan = _plan(jobs.ad_route_counts(spark, SF0001))
    assert "Window" not in plan and plan.count("FileScan") == 1
