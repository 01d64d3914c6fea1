"""Parsers, encoders, document sink body, literals and the lifecycle map."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventide.operators.lifecycle import ints_to_strings, map_with_lifecycle
from eventide.sources import connectors, literals, text


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_user_actions_and_rejects(spark):
    lines = _lines(spark, ["543462,1715,1464116,pv,1511658000", "1,2,3,pv", "1,2,3,pv,notanumber", "9,8,7,buy,1511658001,more"])
    good, bad = text.user_actions(lines)
    rows = sorted(tuple(r) for r in good.select("user_id", "behavior", "ts_ms").collect())
    assert rows == [("543462", "pv", 1511658000000), ("9", "buy", 1511658001000)]
    assert sorted(r["line"] for r in bad.collect()) == ["1,2,3,pv", "1,2,3,pv,notanumber"]


def test_ad_clicks_ids(spark):
    lines = _lines(spark, ["937166,1715,beijing,beijing,1511658000"])
    good, _ = text.ad_clicks(lines)
    assert good.first()["user_id"] == 937166
    good_s, _ = text.ad_clicks(lines, ids_as_string=True)
    assert good_s.first()["ad_id"] == "1715"


def test_access_log(spark):
    lines = _lines(spark, [
        "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash-monitorama-2013/images/kibana-search.png",
        "bad line",
        "1.2.3.4 - u 99/99/2015:10:05:03 +0000 GET /x",
    ])
    good, bad = text.access_log(lines)
    r = good.collect()
    assert len(r) == 1 and r[0]["ip"] == "83.149.9.216" and r[0]["method"] == "GET"
    assert r[0]["ts_ms"] == 1431857103000
    assert bad.count() == 2


def test_keyed_lines(spark):
    good, bad = text.keyed_lines(_lines(spark, ["a 1", "b x", "c"]))
    assert [tuple(r) for r in good.select("key", "ts_ms").collect()] == [("a", 1000)]
    assert bad.count() == 2


def test_message_round_trip(spark):
    lines = _lines(spark, ["1,2,3,pv,10", "4,5,6,cart,20"])
    actions, _ = text.user_actions(lines)
    msgs, unsent = connectors.user_action_messages(actions)
    assert unsent.count() == 0
    back, bad = connectors.parse_payload(msgs.select(F.col("value").cast("binary").alias("value")))
    assert bad.count() == 0
    assert sorted(tuple(r) for r in back.drop("ts", "ts_ms").collect()) == sorted(
        tuple(r) for r in actions.drop("ts", "ts_ms").collect()
    )


def test_messages_keep_null_fields_and_reject_separators(spark):
    rows = [("1", "2", None, "pv", 10), ("1", "a,b", "3", "pv", 10), ("1", "2\n3", "3", "pv", 10)]
    actions = spark.createDataFrame(rows, "user_id string, item_id string, category_id string, behavior string, ts_s long")
    msgs, unsent = connectors.user_action_messages(actions)
    assert [r[0] for r in msgs.collect()] == ["1,2,,pv,10"]
    assert unsent.count() == 2
    good, bad = text.user_actions(msgs)
    assert (good.count(), bad.count()) == (1, 0)


def test_documents(spark):
    docs = connectors.as_documents(literals.strings(spark)).collect()
    assert sorted(r["doc"] for r in docs) == ['{"data":"a"}', '{"data":"b"}']


def test_literals(spark):
    assert literals.ints(spark).count() == 4
    assert literals.int_pairs(spark).count() == 3
    assert literals.logins(spark).where("status = 'fail'").count() == 3


def test_lifecycle_map(spark):
    def setup():
        return {"opened": True}

    def transform(pdf, res):
        assert res["opened"]
        return pd.DataFrame({"value": pdf["value"].astype(str)})

    out = map_with_lifecycle(literals.ints(spark), transform, "value string", setup, lambda r: None)
    assert sorted(r[0] for r in out.collect()) == ["1", "2", "3", "4"]
    assert sorted(r[0] for r in ints_to_strings(literals.ints(spark)).collect()) == ["1", "2", "3", "4"]


def test_row_filters(spark):
    from eventide.functions.text import contains, equals, not_equals

    df = spark.createDataFrame([("stream rocks",), ("spark",), ("pv",)], "value string")
    assert contains(df, "value", "rocks").count() == 1
    assert equals(df, "value", "pv").count() == 1
    assert not_equals(df, "value", "pv").count() == 2


def test_document_and_print_sinks(spark, scratch):
    import os

    src = os.path.join(scratch, "in")
    literals.strings(spark).write.parquet(src)
    stream = spark.readStream.schema("value string").parquet(src)
    q = connectors.document_sink(stream, os.path.join(scratch, "docs"), os.path.join(scratch, "ck1"))
    q.processAllAvailable()
    q.stop()
    docs = sorted(r[0] for r in spark.read.text(os.path.join(scratch, "docs")).collect())
    assert docs == ['{"data":"a"}', '{"data":"b"}']
    printed_to = os.path.join(scratch, "printed")
    q = connectors.print_sink(stream, printed_to, os.path.join(scratch, "ck2"), prefix="black list")
    q.processAllAvailable()
    q.stop()
    printed = sorted(r[0] for r in spark.read.text(printed_to).collect())
    assert printed == ['black list> {"value":"a"}', 'black list> {"value":"b"}']


def test_parsed_lines_keep_rejects_and_null_lines(spark):
    lines = _lines(spark, ["1,2,p,c,5", None, "", "1,2,p,c, 7 ,more", "x,2,p,c,5", "1,2,p,c,"])
    rows = text.parsed_ad_clicks(lines).collect()
    assert [r["_valid"] for r in rows] == [True, False, False, True, False, False]
    assert [r["ts_s"] for r in rows if r["_valid"]] == [5, 7]
    good, bad = text.ad_clicks(lines)
    assert good.columns == ["user_id", "ad_id", "province", "city", "ts_s", "ts", "ts_ms"] and good.count() == 2
    assert sorted((r["line"] for r in bad.collect()), key=str) == ["", "1,2,p,c,", None, "x,2,p,c,5"]


def test_bus_options_and_payload(spark):
    """The connector itself is not on the class path: what it is told, and what is made of its payload."""
    assert connectors.source_options("h:9092", "hotitems", "consumer-group") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "hotitems", "kafka.group.id": "consumer-group", "startingOffsets": "latest",
    }
    assert connectors.sink_options("h:9092", "hotitems") == {"kafka.bootstrap.servers": "h:9092", "topic": "hotitems"}
    payload = spark.createDataFrame([(None, bytearray(b"1,2,3,pv,5")), (bytearray(b"k"), bytearray(b"1,2,3")), (None, None)],
                                    "key binary, value binary")
    good, bad = connectors.parse_payload(payload)
    assert [tuple(r)[:5] for r in good.collect()] == [("1", "2", "3", "pv", 5)]
    assert sorted((r["line"] for r in bad.collect()), key=str) == ["1,2,3", None]
    for call in (lambda: connectors.kafka_user_actions(spark, "h:9092"),
                 lambda: connectors.publish(payload, "h:9092", "hotitems")):
        with pytest.raises(Exception, match="(?i)kafka"):
            call()


def test_messages_round_trip_or_are_not_sendable(spark):
    rows = [("1", "2", "3", "pv", 5), ("1", "2,2", "3", "pv", 5), ("1", None, "3", "a\nb", 5), (None, "", "3", "pv", None)]
    actions = spark.createDataFrame(rows, "user_id string, item_id string, category_id string, behavior string, ts_s long")
    encoded = connectors.with_messages(actions).collect()
    assert [(r["value"], r["_sendable"]) for r in encoded] == [
        ("1,2,3,pv,5", True), ("1,2,2,3,pv,5", False), ("1,,3,a\nb,5", False), (",,3,pv,", True)]
