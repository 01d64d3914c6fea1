"""Named end-to-end queries over the driver tables.

Each job takes ``(spark, sf_dir)`` and returns a DataFrame; the reference's
concepts are mapped onto ``events`` as described in ``sources/tables.py``.
Durations that the reference states in seconds are scaled where the driver
data is too sparse for them (one reading per sensor every few hours):
``SENSOR_*`` and ``SEQUENCE_SPAN`` below.  Sliding and ranking jobs keep the
reference's own sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import equals, exclude_static_assets, is_static_asset, not_equals, split_words
from ..functions.time import duration_ms, floor_to, format_bound
from ..operators import aggregates, gate, late, lifecycle, mergeable, rank, rising, routing, runs, sequence, windows
from ..sources import connectors, tables, text

HOUR = "1 hour"


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Behaviour "pv" maps to event_type 'view'
    return equals(tables.events(spark, sf_dir), "event_type", "view")


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> P3 -> W1 60m -> A2: page views per hour."""
    v = _views(spark, sf_dir)
    res = windows.windowed_agg(v, [], "ts", HOUR, [F.count(F.lit(1)).alias("pv")])
    return res.select("window_end", "pv")


def hot_item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _views(spark, sf_dir)
    return windows.sliding_count(v, ["item_id"], "ts", "60 minutes", "5 minutes", ts_ms="ts_ms")


def hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> P3 -> W2 60m/5m -> A1 -> K1(3)."""
    counts = hot_item_counts(spark, sf_dir)
    return rank.top_n(counts, ["window_end"], "cnt", "item_id", 3).select(
        "window_end", "rnk", "item_id", "cnt"
    )


def hot_items_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hot_items -> K2 text report per window."""
    return rank.ranked_report(hot_items(spark, sf_dir), "window_end", "item_id", "cnt")


# ------------------------------------------------------------------ urls


def hot_url_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of page k -> sliding-count deltas per url (10m/5s windows).

    Deltas are pre-aggregated per (page, end) before the page dimension is
    joined, so the join sees one row per page and change point, not one per
    request, and a hot page cannot skew it.  Distinct pages may share a url;
    ``deltas_to_runs`` sums the deltas per url after its own repartition.
    """
    ev = tables.events(spark, sf_dir)
    size, slide = duration_ms("10 minutes"), duration_ms("5 seconds")
    deltas = windows.window_deltas(ev, ["item_id"], "ts_ms", size, slide)
    urls = exclude_static_assets(tables.pages(spark, sf_dir))
    # build the page side: one row per page, however many requests there are
    joined = deltas.join(urls.hint("shuffle_hash"), deltas["item_id"] == urls["page_id"])
    return joined.select("url", "end", "delta")


def _ranked_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = hot_url_deltas(spark, sf_dir)
    return windows.deltas_top_n(deltas, "url", "10 minutes", "5 seconds", 5)


def hot_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 -> P6 -> W2 10m/5s -> A1 -> K1(5)."""
    return _ranked_urls(spark, sf_dir).select("window_end", "rnk", "url", "cnt")


def hot_urls_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hot_urls -> K2, grouped on the ranking's own partitioning (no shuffle)."""
    return rank.ranked_report(_ranked_urls(spark, sf_dir), "window_end", "url", "cnt", labels=rank.URL_LABELS)


def hot_urls_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hot_urls without loss in run form: stretches of window ends in which a url holds a rank with one count."""
    size, slide = duration_ms("10 minutes"), duration_ms("5 seconds")
    counts = windows.deltas_to_runs(hot_url_deltas(spark, sf_dir), ["url"], size, slide, bucket=HOUR)
    ranked = runs.top_n_runs(counts, "url", 5)
    return ranked.select(*_run_bounds(slide), "rnk", "url", "cnt")


# ------------------------------------------------------------------ visitors


def unique_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> P3 -> W1 60m -> A5 exact distinct users."""
    return aggregates.distinct_users(_views(spark, sf_dir), "user_id", "ts", HOUR)


def unique_visitors_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> P3 -> W1 60m -> A6 bitmap of the user-id string hash."""
    return aggregates.bitmap_distinct_users(_views(spark, sf_dir), "user_id", "ts_ms", HOUR)


def _hourly_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.window_bitmaps(_views(spark, sf_dir), "user_id", "ts_ms", HOUR)


def unique_visitors_bitmap_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 rolled up: distinct bit positions per day from the hourly bitmaps."""
    return aggregates.bitmap_counts(aggregates.roll_up_bitmaps(_hourly_bitmaps(spark, sf_dir), HOUR, "1 day"))


def unique_visitors_bitmap_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 rolled up: distinct bit positions per 6h/1h sliding window from the hourly bitmaps."""
    return aggregates.bitmap_counts(aggregates.roll_up_bitmaps(_hourly_bitmaps(spark, sf_dir), HOUR, "6 hours", HOUR))


def unique_visitors_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> P3 -> W1 60m -> A7 running distinct count at each first sighting."""
    return aggregates.running_distinct_users(
        _views(spark, sf_dir), "user_id", "ts_ms", "seq", HOUR
    )


def unique_visitors_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> P3 -> W2 1h/5s -> A5: exact distinct users per sliding window."""
    size, slide = duration_ms(HOUR), duration_ms("5 seconds")
    deltas = runs.distinct_deltas(_views(spark, sf_dir), [], "user_id", "ts_ms", size, slide)
    return windows.deltas_to_counts(deltas, [], size, slide, out="uv")


# ------------------------------------------------------------------ marketing / ads


def _marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Behaviour UNINSTALL maps to event_type 'error'
    ev = not_equals(tables.events(spark, sf_dir), "event_type", "error")
    return ev.select(
        (F.col("item_id") % 6).cast("string").alias("channel"),
        F.col("event_type").alias("behavior"),
        "ts_ms",
    )


def _labelled(counts: DataFrame, size_ms: int) -> list:
    return [
        format_bound(F.col("window_end") - F.lit(size_ms)).alias("window_start"),
        format_bound("window_end").alias("window_end"),
    ]


def marketing_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 -> W2 1h/1s -> A3: count per (channel, behaviour) with formatted bounds."""
    size, slide = duration_ms("1 hour"), duration_ms("1 second")
    m = _marketing(spark, sf_dir)
    counts = windows.deltas_to_counts(
        windows.window_deltas(m, ["channel", "behavior"], "ts_ms", size, slide),
        ["channel", "behavior"], size, slide,
    )
    return counts.select(*_labelled(counts, size), "channel", "behavior", "cnt")


def marketing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 -> W2 1h/1s -> A3 without loss in run form: each (channel, behaviour)'s
    stretches of consecutive window ends with one count, as first and last end.

    Runs are cut at bucket borders inside the operator; stretches that meet
    with equal counts are joined again, within buckets first.
    """
    size, slide = duration_ms("1 hour"), duration_ms("1 second")
    keys = ["channel", "behavior"]
    deltas = windows.window_deltas(_marketing(spark, sf_dir), keys, "ts_ms", size, slide)
    merged = runs.merge_runs(windows.deltas_to_runs(deltas, keys, size, slide), keys, ["cnt"])
    return merged.select(*_run_bounds(slide), *keys, "cnt")


def _run_bounds(slide_ms: int) -> list[Column]:
    """First and last window end of a stretch ``[start, stop)``."""
    return [F.col("start").alias("first_end"), (F.col("stop") - F.lit(slide_ms)).alias("last_end")]


def marketing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 -> W2 1h/1s -> A4: one total per window, labelled total/total.

    The single (un-keyed) series is computed from pre-aggregated deltas with a
    day-bucketed running sum, so it is not funnelled through one task.
    """
    size, slide = duration_ms("1 hour"), duration_ms("1 second")
    m = _marketing(spark, sf_dir)
    counts = windows.deltas_to_counts(
        windows.window_deltas(m, [], "ts_ms", size, slide), [], size, slide
    )
    return counts.select(
        *_labelled(counts, size),
        F.lit("total").alias("channel"),
        F.lit("total").alias("behavior"),
        "cnt",
    )


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tables.events(spark, sf_dir)
    return ev.select(
        "user_id", "item_id", (F.col("item_id") % 6).cast("string").alias("province"),
        "ts_ms", "seq",
    )


def _province_counts(clicks: DataFrame) -> DataFrame:
    size, slide = duration_ms("60 minutes"), duration_ms("5 seconds")
    counts = windows.deltas_to_counts(
        windows.window_deltas(clicks, ["province"], "ts_ms", size, slide),
        ["province"], size, slide,
    )
    return counts.select(format_bound("window_end").alias("window_end"), "province", "cnt")


def ad_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> W2 60m/5s -> A1 -> P9: clicks per province."""
    return _province_counts(_clicks(spark, sf_dir))


LIMIT_KEYS = ["user_id"]
LIMIT_MAX = 1


def _limited(spark: SparkSession, sf_dir: str):
    routed = routing.daily_limit(_clicks(spark, sf_dir), LIMIT_KEYS, "ts_ms", "seq", LIMIT_MAX)
    return routing.limiter_outputs(routed, LIMIT_KEYS, LIMIT_MAX)


def ad_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> T1 -> T2 main: province counts of the clicks the limiter passed."""
    main, _ = _limited(spark, sf_dir)
    return _province_counts(main)


def ad_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> T1 -> T2 side: one warning per key and day over the limit."""
    _, side = _limited(spark, sf_dir)
    return side


USER_AD = ["user_id", "item_id"]


def _limited_per_ad(spark: SparkSession, sf_dir: str):
    routed = routing.daily_limit(_clicks(spark, sf_dir), USER_AD, "ts_ms", "seq", 0)
    return routing.limiter_outputs(routed, USER_AD, 0)


def ad_limited_per_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> T1 -> T2 main, limited per user and ad and day (max 0: the first click passes)."""
    return _province_counts(_limited_per_ad(spark, sf_dir)[0])


def ad_blacklist_per_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> T1 -> T2 side: one warning per user, ad and day, with the ad's id."""
    return _limited_per_ad(spark, sf_dir)[1]


def ad_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> T1: how many clicks the limiter passes, warns of and drops, from one scan."""
    return routing.limiter_counts(_clicks(spark, sf_dir), LIMIT_KEYS, "ts_ms", LIMIT_MAX)


# ------------------------------------------------------------------ sequences, sensors

SEQUENCE_SPAN = "3 days"  # reference: 10 seconds, on data ~10^4 times denser
SENSOR_WINDOW = "6 hours"  # reference: 5 seconds
SENSOR_SLIDING = ("12 hours", "6 hours")  # reference: 10 s / 5 s
SENSOR_PANE = "1 hour"  # reference: 1 second
RISE_INTERVAL = "1 day"  # reference: 1 second


def login_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 -> T6: three adjacent failures of one user within the span."""
    ev = tables.events(spark, sf_dir).select("user_id", "ts_ms", "seq", "event_id", "event_type")
    fail = lambda r: r("event_type") == "error"
    res = sequence.strict_sequence(
        ev, ["user_id"], "ts_ms", "seq", [fail, fail, fail], SEQUENCE_SPAN,
        emit=["event_id"], names=["first", "second", "third"],
    )
    return res


def _sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tables.events(spark, sf_dir)
    return ev.select(
        F.col("user_id").cast("string").alias("id"), "ts", "ts_ms", "seq",
        F.col("value").alias("temperature"),
    )


def sensor_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sensor and sliding window, first reading's time and min temperature."""
    size, slide = SENSOR_SLIDING
    return aggregates.first_with_min(
        _sensors(spark, sf_dir), ["id"], "ts", "ts_ms", "seq", "temperature", size, slide
    )


def sensor_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sensor and tumbling window, min and max temperature."""
    return aggregates.min_max(_sensors(spark, sf_dir), ["id"], "ts", "temperature", SENSOR_WINDOW)


STATIONS = 16  # sensors of one station; a single sensor reads once in hours


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tables.events(spark, sf_dir)
    return ev.select((F.col("user_id") % STATIONS).alias("station"), "ts_ms", F.col("value").alias("temperature"))


def station_minmax_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 on W2 1h/1s in run form: stretches of window ends with one min and max temperature per station."""
    size, slide = duration_ms(HOUR), duration_ms("1 second")
    extremes = runs.min_max_runs(_stations(spark, sf_dir), ["station"], "ts_ms", "temperature", size, slide)
    values = ["min_temperature", "max_temperature"]
    return runs.merge_runs(extremes, ["station"], values).select("station", *_run_bounds(slide), *values)


def station_reduce_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on W2 1h/5s in run form: stretches of window ends with one first reading's time and min temperature per station."""
    size, slide = duration_ms(HOUR), duration_ms("5 seconds")
    reduced = runs.first_with_min_runs(_stations(spark, sf_dir), ["station"], "ts_ms", "temperature", size, slide)
    values = ["first_ts", "min_temperature"]
    return runs.merge_runs(reduced, ["station"], values).select("station", *_run_bounds(slide), *values)


def value_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type and day, the bins (5 wide) of the median and the 95th percentile, by a user-defined aggregate."""
    ev = tables.events(spark, sf_dir).withColumn("day", F.floor(F.col("ts_ms") / routing.DAY_MS).cast("bigint"))
    sketch = mergeable.histogram_quantiles(5.0, [0.5, 0.95])
    found = mergeable.aggregate(ev, ["event_type", "day"], ["value"], sketch, "bins")
    return found.select("event_type", "day", F.get("bins", F.lit(0)).alias("median_bin"), F.get("bins", F.lit(1)).alias("p95_bin"))


def sensor_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running min/max at every pane of each sensor window, last one final."""
    return late.early_results(
        _sensors(spark, sf_dir), ["id"], "ts_ms", "temperature", SENSOR_WINDOW, SENSOR_PANE
    )


def rising_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: alert when a sensor's temperature kept rising for the interval."""
    return rising.rising_alerts(
        _sensors(spark, sf_dir), "id", "ts_ms", "seq", "temperature", RISE_INTERVAL
    )


GATE_CONTROL = "signup"
GATE_OPEN = "6 hours"


def gated_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings forwarded only while their sensor's gate is open.

    Controls are 'signup' events opening the user's gate for six hours; the
    readings are all other events.
    """
    ev = tables.events(spark, sf_dir).select(
        F.col("user_id").alias("id"), "ts_ms", "event_id", F.col("value").alias("temperature"), "event_type"
    )
    return gate.timed_gate_one_input(
        ev, "id", "ts_ms",
        is_control=F.col("event_type") == GATE_CONTROL,
        duration_ms_col=F.lit(duration_ms(GATE_OPEN)).cast("bigint"),
        payload=["id", "ts_ms", "event_id", "temperature"],
        seq="event_id",
    )


def freezing_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3: "Freezing Alarm for <id>" for every reading below 32."""
    return routing.threshold_alarm(
        _sensors(spark, sf_dir), "id", "temperature", 32.0, keep=["id", "ts_ms", "seq"]
    )


def low_temperature_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: fixed message for every reading below 1000."""
    return routing.threshold_alarm(
        _sensors(spark, sf_dir), "id", "temperature", 1000.0,
        fixed_text=routing.LOW_TEMPERATURE_TEXT, keep=["id", "ts_ms", "seq"],
    )


def cool_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 with a threshold inside the data's range: the fixed message for readings below 100."""
    return routing.threshold_alarm(
        _sensors(spark, sf_dir), "id", "temperature", 100.0,
        fixed_text=routing.LOW_TEMPERATURE_TEXT, keep=["id", "ts_ms", "seq"],
    )


# ------------------------------------------------------------------ late data

LATE_DELAY = "1 hour"
LATE_ALLOWED = "2 hours"
LATE_WINDOW = "1 hour"


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a jittered arrival time (ties by event_id): 0-10006 s late."""
    ev = tables.events(spark, sf_dir)
    jitter = F.pmod(F.col("event_id") * F.lit(7919), F.lit(10007)) * F.lit(1000)
    return ev.withColumn("arrival_ms", F.col("ts_ms") + jitter)


def late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 + L4: rows below the watermark at their arrival go to the side output."""
    res = late.late_split(_arrivals(spark, sf_dir), "ts_ms", "arrival_ms", "seq", LATE_DELAY)
    return res.select("event_id", "ts_ms", "arrival_ms", "is_late", "side_msg")


def late_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First result per (type, hour) and one revision per accepted late row."""
    return late.late_revisions(
        _arrivals(spark, sf_dir), ["event_type"], "ts_ms", "arrival_ms", "seq",
        LATE_WINDOW, LATE_DELAY, LATE_ALLOWED,
    )


# ------------------------------------------------------------------ text


def action_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 -> S1: every event encoded as a ``user,item,category,behavior,seconds``
    message and parsed back by the delimited-line parser."""
    sent = connectors.with_messages(_actions(spark, sf_dir)).where("_sendable")
    parsed, _ = text.user_actions(sent)
    return parsed.select("user_id", "item_id", "category_id", "behavior", "ts_s", "ts_ms")


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tables.events(spark, sf_dir)
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("item_id").cast("string").alias("item_id"),
        (F.col("item_id") % 6).cast("string").alias("category_id"),
        F.col("event_type").alias("behavior"),
        F.floor(F.col("ts_ms") / 1000).cast("bigint").alias("ts_s"),
    )


def action_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that S6 sends and rejects, and lines that S1 accepts and rejects.

    By a fixed rule every 11th event has a comma in its behaviour and every
    13th has none, so both outcomes occur.
    """
    ids = tables.events(spark, sf_dir).select("event_id", "user_id", "item_id", "event_type", "ts_ms")
    behavior = (
        F.when(F.col("event_id") % 11 == 0, F.concat("event_type", F.lit(",x")))
        .when(F.col("event_id") % 13 != 0, F.col("event_type"))
    )
    actions = ids.select(
        F.col("user_id").cast("string").alias("user_id"), F.col("item_id").cast("string").alias("item_id"),
        (F.col("item_id") % 6).cast("string").alias("category_id"), behavior.alias("behavior"),
        F.floor(F.col("ts_ms") / 1000).cast("bigint").alias("ts_s"),
    )
    encoded = connectors.with_messages(actions)
    # A row that is not sent has no line.
    lines = encoded.select(F.when(F.col("_sendable"), F.col("value")).alias("value"))
    seen = F.col("_raw").isNotNull()
    outputs = {"sent": seen, "unsent": ~seen, "accepted": seen & F.col("_valid"), "rejected": seen & ~F.col("_valid")}
    total = text.parsed_user_actions(lines).agg(*[F.count(F.when(test, True)).alias(name) for name, test in outputs.items()])
    return total.unpivot([], list(outputs), "output", "n")


def _counts_with_rejects(parsed: DataFrame, key: str, size, counted: Column | None = None) -> DataFrame:
    """``key, window_end, cnt`` of the good lines that are ``counted``, and of the bad ones as ``rejected``: one scan, one parse."""
    size_ms = duration_ms(size)
    counted = F.lit(True) if counted is None else counted
    rejects = parsed.sparkSession.range(1).select(
        F.lit("rejected").alias(key), F.lit(0).cast("bigint").alias("window_end"), F.lit(0).cast("bigint").alias("_one")
    )
    good = F.col("_valid")
    label = F.when(~good, F.lit("rejected")).when(counted, F.col(key))
    end = F.when(good, floor_to(F.col("ts_ms"), size_ms) + F.lit(size_ms)).otherwise(F.lit(0))
    rows = parsed.where(~good | counted).select(
        label.alias(key), end.cast("bigint").alias("window_end"), F.lit(1).cast("bigint").alias("_one")
    )
    return rows.unionByName(rejects).groupBy(key, "window_end").agg(F.sum("_one").alias("cnt"))


def _ad_click_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an S2 line; every 7th has no time and every 5th a sixth field."""
    ev = tables.events(spark, sf_dir)
    line = F.concat_ws(
        ",", F.col("user_id").cast("string"), F.col("item_id").cast("string"),
        (F.col("item_id") % 6).cast("string"), F.concat(F.lit("c"), (F.col("item_id") % 4).cast("string")),
        F.when(F.col("event_id") % 7 == 0, F.lit("x")).otherwise(F.floor(F.col("ts_ms") / 1000).cast("string")),
        F.when(F.col("event_id") % 5 == 0, F.lit("extra")),
    )
    return ev.select(line.alias("value"))


def ad_click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> W1: clicks per province and hour, parsed from text lines; lines that do not parse under 'rejected'."""
    return _counts_with_rejects(text.parsed_ad_clicks(_ad_click_texts(spark, sf_dir)), "province", HOUR)


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 -> P5 -> P6 -> W1: requests per url and day, parsed from log lines.

    Every event asks for a path of its item; by a fixed rule over all rows some
    paths are style sheets or scripts (which P6 takes out), some carry a query
    after one (which it keeps), and some lines have no readable time.  P5 keeps
    the paths under ``/p``.
    """
    ev = tables.events(spark, sf_dir)
    suffix = (
        F.when(F.col("event_id") % 4 == 0, ".css").when(F.col("event_id") % 4 == 1, ".js")
        .when(F.col("event_id") % 4 == 2, ".css?v=1").otherwise("")
    )
    folder = F.when(F.col("event_id") % 3 == 0, "/q").otherwise("/p")
    line = F.concat_ws(
        " ", F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")), F.lit("-"),
        F.col("user_id").cast("string"),
        F.when(F.col("event_id") % 17 == 0, F.lit("unknown")).otherwise(F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")),
        F.lit("+0000"), F.lit("GET"), F.concat(folder, F.col("item_id").cast("string"), suffix),
    )
    asked = F.col("url").contains("/p") & ~is_static_asset("url")
    return _counts_with_rejects(text.parsed_access_log(ev.select(line.alias("value"))), "url", "1 day", asked)


def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 -> W1: rows per key and hour from ``key seconds`` lines; every 9th line has no time."""
    ev = tables.events(spark, sf_dir)
    line = F.concat_ws(
        " ", "event_type", F.when(F.col("event_id") % 9 != 0, F.floor(F.col("ts_ms") / 1000).cast("string"))
    )
    return _counts_with_rejects(text.parsed_keyed_lines(ev.select(line.alias("value"))), "key", HOUR)


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 -> A10: whitespace tokens of every document, counted."""
    words = split_words(tables.documents(spark, sf_dir), "text", "word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def windowed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 -> W1 10s -> A10: words per ten-second window, over a line of words per event."""
    ev = tables.events(spark, sf_dir)
    line = F.concat_ws(
        " ", "event_type", F.concat(F.lit("item"), (F.col("item_id") % 6).cast("string")),
        F.when(F.col("event_id") % 3 == 0, F.lit("\tnew  item0")),
    )
    words = split_words(ev.select("ts", line.alias("line")), "line", "word")
    return windows.tumbling_count(words, ["word"], "ts", "10 seconds").select("word", "window_end", "cnt")


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body of the document that the sink writes for every event's type and item."""
    ev = tables.events(spark, sf_dir)
    element = F.concat_ws(":", "event_type", F.col("item_id").cast("string"))
    return connectors.as_documents(ev.select(element.alias("value")))


def printed_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 side -> S9: the limiter's warnings as the lines that the print sink writes, with its prefix."""
    return connectors.printed_lines(ad_blacklist(spark, sf_dir), "black list").withColumnRenamed("value", "line")


def id_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's id as a string."""
    ids = tables.events(spark, sf_dir).select(F.col("event_id").cast("int").alias("value"))
    return lifecycle.ints_to_strings(ids)


REGISTRY = {
    "page_views": page_views,
    "hot_items": hot_items,
    "hot_items_report": hot_items_report,
    "hot_urls": hot_urls,
    "hot_urls_report": hot_urls_report,
    "unique_visitors": unique_visitors,
    "unique_visitors_bitmap": unique_visitors_bitmap,
    "unique_visitors_running": unique_visitors_running,
    "marketing_by_channel": marketing_by_channel,
    "marketing_total": marketing_total,
    "ad_by_province": ad_by_province,
    "ad_limited": ad_limited,
    "ad_blacklist": ad_blacklist,
    "login_failures": login_failures,
    "sensor_reduce": sensor_reduce,
    "sensor_minmax": sensor_minmax,
    "sensor_early": sensor_early,
    "rising_alert": rising_alert,
    "gated_readings": gated_readings,
    "freezing_alarm": freezing_alarm,
    "low_temperature_alarm": low_temperature_alarm,
    "late_split": late_split,
    "late_revision": late_revision,
    "word_count": word_count,
    "action_lines": action_lines,
    "action_line_counts": action_line_counts,
    "ad_click_lines": ad_click_lines,
    "access_log_lines": access_log_lines,
    "keyed_lines": keyed_lines,
    "marketing_runs": marketing_runs,
    "ad_limited_per_ad": ad_limited_per_ad,
    "ad_blacklist_per_ad": ad_blacklist_per_ad,
    "cool_alarm": cool_alarm,
    "hot_urls_runs": hot_urls_runs,
    "unique_visitors_sliding": unique_visitors_sliding,
    "station_minmax_runs": station_minmax_runs,
    "ad_route_counts": ad_route_counts,
    "unique_visitors_bitmap_daily": unique_visitors_bitmap_daily,
    "unique_visitors_bitmap_sliding": unique_visitors_bitmap_sliding,
    "value_quantiles": value_quantiles,
    "windowed_word_count": windowed_word_count,
    "station_reduce_runs": station_reduce_runs,
    "event_documents": event_documents,
    "printed_warnings": printed_warnings,
    "id_strings": id_strings,
}
