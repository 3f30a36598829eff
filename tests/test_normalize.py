from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadloom import functions as fn
from leadloom.bindings import model_sql


def apply(spark, function, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {dtype}")
    got = df.select("i", function(F.col("c")).alias("r")).orderBy("i").collect()
    return [r.r for r in got]


PHONES = {
    None: None,
    "": None,
    "   ": None,
    "abc": None,
    "12345": None,
    "+62 812-0000012": "+628120000012",
    "0812 0000012": "+628120000012",
    "628120000012": "+628120000012",
    "8120000012": "+628120000012",
    "+62 0812 0000012": "+6208120000012",
    "+1 523 555 1055": "+6215235551055",
    "12345678": None,
    "123456789": "+62123456789",
    # ten digits, but only eight after the country code
    "6212345678": None,
    "62123456789": "+62123456789",
    "012345678": None,
    "0123456789": "+62123456789",
    # one prefix is removed, not two
    "62620000000": "+62620000000",
    "00123456789": "+620123456789",
    "(021) 555-012": None,
    "(021) 555-0123": "+62215550123",
    "+6+2123456789": "+62123456789",
    "62": None,
    "0": None,
}


def test_phone_values(spark):
    assert apply(spark, fn.normalize_phone, list(PHONES)) == list(PHONES.values())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789+- ()a", max_size=18), min_size=1, max_size=30))
def test_phone_against_plain_python(spark, texts):
    def expected(text):
        digits = "".join(c for c in text if c.isdigit())
        if digits.startswith("62"):
            digits = digits[2:]
        elif digits.startswith("0"):
            digits = digits[1:]
        return f"+62{digits}" if len(digits) >= 9 else None

    assert apply(spark, fn.normalize_phone, texts) == [expected(t) for t in texts]


def test_phone_idempotent(spark):
    once = [v for v in apply(spark, fn.normalize_phone, list(PHONES)) if v]
    assert apply(spark, fn.normalize_phone, once) == once


EMAILS = {
    None: None,
    "": None,
    "not-an-email": None,
    "a@b": None,
    "a.b@c": None,
    "  User1@Mail.Example.com ": "user1@mail.example.com",
    "x@y.z": "x@y.z",
    "@.": "@.",
}


def test_email_values(spark):
    got = apply(spark, fn.normalize_email, list(EMAILS))
    assert got == list(EMAILS.values())
    again = [v for v in got if v]
    assert apply(spark, fn.normalize_email, again) == again


@pytest.mark.parametrize(
    "function, values",
    [
        (fn.normalize_business_age, model_sql.BUSINESS_AGE),
        (fn.normalize_income, model_sql.INCOME),
        (fn.normalize_employee_count, model_sql.EMPLOYEE_COUNT),
    ],
)
def test_categories(spark, function, values):
    inputs = [*values, "unlisted", "", None]
    expected = [*values.values(), "unlisted", "", None]
    assert apply(spark, function, inputs) == expected
    # canonical labels pass through
    labels = [v for v in values.values() if v is not None]
    assert apply(spark, function, labels) == labels


def test_category_samples(spark):
    assert apply(spark, fn.normalize_business_age, ["diatas_10_tahun", "6-10_tahun", "diatas_20_tahun"]) == [
        "5-10 tahun",
        "5-10 tahun",
        "diatas 10 tahun",
    ]
    assert apply(spark, fn.normalize_employee_count, ["lebih_dari_10", "3-5 Karyawan", "5-10_karyawan"]) == [
        None,
        "1-5 karyawan",
        "6-10 karyawan",
    ]


def test_composite_key(spark):
    df = spark.createDataFrame([(None, None), ("a@b.c", None), (None, "+62"), ("a", "b")], "e string, p string")
    keys = [r.k for r in df.select(fn.composite_key(F.col("e"), F.col("p")).alias("k")).collect()]
    assert keys == ["|", "a@b.c|", "|+62", "a|b"]


def test_blank_to_null(spark):
    assert apply(spark, fn.blank_to_null, [None, "", "  ", " x "]) == [None, None, None, "x"]


def test_flag_in_list(spark):
    flag = lambda c: fn.flag_in_list(c, ["1", "2"])
    assert apply(spark, flag, ["1", "3", None]) == [True, False, None]
    assert apply(spark, lambda c: fn.flag_in_list(c, []), ["1", None]) == [False, None]


def test_case_map_without_entries(spark):
    assert apply(spark, lambda c: fn.case_map(c, {}), ["x", None]) == ["x", None]
