"""Data-quality rules K6-K12 on hand-written rows."""

import math


from assetlake.functions.scalars import MAX_TIMESTAMP_MS, clamp_value, full_match, iso_instant
from assetlake.operators.rules import (DESCRIPTION_KEY, END_KEY, ORIGINAL_FILE_NAME_KEY, START_KEY, cap_event_end,
                                       clean_file_names, event_rules)

EV = "id long, start_time long, end_time long, description string, metadata map<string,string>"


def _ev(spark, rows):
    return {r["id"]: r for r in event_rules(spark.createDataFrame(rows, EV)).collect()}


def test_event_rules(spark):
    out = _ev(spark, [
        (1, -5, 100, "ok", {}),          # K8: start < 0
        (2, None, -3, "ok", {}),         # K9 with start unset -> end = 0
        (3, 50, -3, "ok", {"a": "b"}),   # K9 -> end = start
        (4, 200, 100, "ok", None),       # K10: start > end
        (5, 10, None, "x" * 501, {}),    # K11: 501 chars
        (6, 10, None, "y" * 500, {}),    # 500 chars unchanged
        (7, None, None, None, {}),       # nothing set
    ])
    assert (out[1]["start_time"], out[1]["end_time"]) == (0, 100) and START_KEY in out[1]["metadata"]
    assert (out[2]["start_time"], out[2]["end_time"]) == (None, 0) and END_KEY in out[2]["metadata"]
    assert (out[3]["start_time"], out[3]["end_time"]) == (50, 50) and out[3]["metadata"]["a"] == "b"
    assert (out[4]["start_time"], out[4]["end_time"]) == (100, 100) and START_KEY in out[4]["metadata"]
    assert len(out[5]["description"]) == 500 and DESCRIPTION_KEY in out[5]["metadata"]
    assert len(out[6]["description"]) == 500 and out[6]["metadata"] == {}
    assert out[7]["metadata"] == {} and out[7]["start_time"] is None


def test_end_time_cap(spark):
    df = spark.createDataFrame([(1, MAX_TIMESTAMP_MS + 1), (2, 5), (3, None)], "id long, end_time long")
    got = {r["id"]: r["end_time"] for r in cap_event_end(df).collect()}
    assert got == {1: MAX_TIMESTAMP_MS, 2: 5, 3: None}


def test_value_clamp(spark):
    vals = [2e100, -3e100, float("inf"), float("-inf"), float("nan"), 1.5, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r["c"] for r in df.orderBy("i").select(clamp_value("v").alias("c")).collect()]
    assert got[:4] == [1e100, -1e100, 1e100, -1e100]
    assert math.isnan(got[4]) and got[5] == 1.5 and got[6] is None


def test_clean_file_names(spark):
    df = spark.createDataFrame([(1, "a/b", {}), (2, "a\\b", {}), (3, "a/b\\c", {"k": "v"}), (4, "plain", {})],
                               "id long, name string, metadata map<string,string>")
    out = {r["id"]: r for r in clean_file_names(df).collect()}
    assert out[1]["name"] == "a-b" and out[1]["metadata"][ORIGINAL_FILE_NAME_KEY] == "a/b"
    assert out[2]["name"] == "a-b"
    assert out[3]["name"] == "a-b-c" and out[3]["metadata"]["k"] == "v"
    assert out[4]["name"] == "plain" and out[4]["metadata"] == {}


def test_iso_instant(spark):
    df = spark.createDataFrame([(1706618096000,), (1706618096123,)], "ms long")
    got = [r[0] for r in df.select(iso_instant("ms")).collect()]
    assert got == ["2024-01-30T12:34:56Z", "2024-01-30T12:34:56.123Z"]


def test_full_match_rejects_partial_and_trailing_newline(spark):
    df = spark.createDataFrame([("ts:12",), ("xts:12",), ("ts:12\n",)], "s string")
    got = [r[0] for r in df.select(full_match("s", "ts:1.*")).collect()]
    assert got == [True, False, False]
