from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadloom import functions as fn
from tests.helpers import one


def value(spark, text, build):
    df = one(spark, text).select(F.parse_json("c").alias("v"))
    return df.select(build(F.col("v")).alias("r")).collect()[0].r


DOC = '{"s":"x","i":5,"b":true,"n":null,"o":{"k":[1,2]},"l":[{"a":1}],"t":"2024-01-01T10:00:00+07:00"}'


@pytest.mark.parametrize(
    "path, expected",
    [("s", "x"), ("i", "5"), ("b", "true"), ("n", None), ("o", '{"k":[1,2]}'), ("l", '[{"a":1}]'), ("z", None), ("s.k", None)],
)
def test_json_text(spark, path, expected):
    assert value(spark, DOC, lambda v: fn.json_text(v, f"$.{path}")) == expected


def test_json_text_of_null_document(spark):
    assert value(spark, None, lambda v: fn.json_text(v, "$.a")) is None


def test_json_as_drops_the_offset(spark):
    got = value(spark, DOC, lambda v: fn.json_as(v, "$.t", "timestamp_ntz"))
    assert got == dt.datetime(2024, 1, 1, 10, 0)


def test_json_as_strict_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, DOC, lambda v: fn.json_as(v, "$.s", "int"))
    assert value(spark, DOC, lambda v: fn.json_as(v, "$.s", "int", strict=False)) is None


@pytest.mark.parametrize(
    "text, expected",
    [("[1,2]", 2), ("[]", 0), ("null", None), (None, None), ("{}", None)],
)
def test_json_len(spark, text, expected):
    assert value(spark, text, fn.json_len) == expected


@pytest.mark.parametrize(
    "text, expected",
    [('{"m":{}}', True), ('{"m":{"1":2}}', True), ('{"m":null}', False), ('{"m":[1]}', False), ("{}", False), (None, False)],
)
def test_is_json_object(spark, text, expected):
    assert value(spark, text, lambda v: fn.is_json_object(v, "$.m")) is expected


@pytest.mark.parametrize("text", ["[]", "{}", "false", "0", "0.0", '""', "null"])
def test_json_pack_drops_falsy(spark, text):
    assert value(spark, text, lambda v: F.to_json(fn.json_pack(v))) is None
    assert value(spark, text, lambda v: F.to_json(fn.json_pack(v, falsy_to_null=False))) is not None


@pytest.mark.parametrize("text", ["[0]", '{"a":null}', "true", "1", '"0"', '"false"'])
def test_json_pack_keeps_the_rest(spark, text):
    assert value(spark, text, lambda v: F.to_json(fn.json_pack(v))) == text


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"m":{"1":{"s":"2024-02"},"2":{"s":"2024-01"},"3":{"s":""},"4":{},"5":7}}', "2024-01"),
        ('{"m":{"1":{"s":""}}}', None),
        ('{"m":{}}', None),
        ('{"m":null}', None),
        ("{}", None),
        (None, None),
    ],
)
def test_earliest_in_object(spark, text, expected):
    assert value(spark, text, lambda v: fn.earliest_in_object(v, "$.m", "s")) == expected


def test_enrollment_lookups(spark):
    doc = '{"started_at":"2024-01-01","tracked_time":{"total":12.5}}'
    assert value(spark, doc, fn.enrollment_start) == "2024-01-01"
    assert value(spark, doc, fn.tracked_total) == 12.5
    assert value(spark, "{}", fn.tracked_total) is None


def pair(spark, a, b, build):
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    return df.select(build(F.col("a"), F.col("b")).alias("r")).collect()[0].r


T0 = dt.datetime(2024, 1, 10, 12, 0)


@pytest.mark.parametrize(
    "days, expected", [(1.5, 1), (-2.5, -2), (0.99, 0), (-0.99, 0), (7, 7), (400.25, 400)]
)
def test_days_between(spark, days, expected):
    assert pair(spark, T0 + dt.timedelta(days=days), T0, fn.days_between) == expected


def test_days_between_null(spark):
    assert pair(spark, None, T0, fn.days_between) is None
    assert pair(spark, T0, None, fn.days_between) is None


@pytest.mark.parametrize(
    "day, expected",
    [((2024, 12, 30), (1, 2025)), ((2021, 1, 1), (53, 2020)), ((2023, 1, 2), (1, 2023)), ((2020, 12, 31), (53, 2020))],
)
def test_iso_week(spark, day, expected):
    at = dt.datetime(*day)
    assert tuple(at.isocalendar())[1::-1] == expected
    assert pair(spark, at, at, lambda a, b: fn.iso_week(a)) == expected[0]
    assert pair(spark, at, at, lambda a, b: fn.iso_year(a)) == expected[1]


def test_last_activity(spark):
    assert pair(spark, None, None, fn.last_activity) == dt.datetime(1970, 1, 1)
    assert pair(spark, None, T0, fn.last_activity) == T0


@pytest.mark.parametrize("seconds, expected", [(90, "1.50"), (0.3, "0.01"), (1.5, "0.03"), (100, "1.67")])
def test_minutes(spark, seconds, expected):
    got = one(spark, float(seconds), "double").select(fn.minutes_2dp(F.col("c")).alias("r")).collect()[0].r
    assert str(got) == expected
