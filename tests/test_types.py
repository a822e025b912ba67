from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions import types as ct


def value(spark, text, declared, **options):
    df = spark.createDataFrame([(text,)], "raw string")
    return df.select(ct.coerce(F.col("raw"), declared, **options).alias("v")).first().v


@pytest.mark.parametrize(
    "text, declared, expected",
    [
        ("\\N", "varchar(9)", None),
        ("", "varchar(9)", ""),
        ("", "enum('a')", None),
        ("", "json", None),
        ("", "date", None),
        ("YES", "bool", True),
        ("2", "boolean", False),
        ("-128", "tinyint(1)", -128),
        (" +42 ", "int(11)", 42),
        ("4294967295", "int(10) unsigned", 4294967295),
        ("18446744073709551615", "bigint unsigned", Decimal(18446744073709551615)),
        ("12.345", "decimal(10,3)", Decimal("12.345")),
        ("1.5", "decimal(65,30)", "1.5"),
        ("2.5e3", "double", 2500.0),
        ("1.5", "float", 1.5),
        ("2024-02-29", "date", dt.date(2024, 2, 29)),
        ("2024-02-29 23:59:59.123", "datetime(3)", dt.datetime(2024, 2, 29, 23, 59, 59, 123000)),
        ("-838:59:59", "time", "-838:59:59"),
        ("2024", "year", "2024"),
        ('{"b": [1, 2], "a": null}', "json", '{"a":null,"b":[1,2]}'),
        ("<a/>", "xml", "<a/>"),
        ("x,y", "set('x','y')", "x,y"),
    ],
)
def test_values(spark, text, declared, expected):
    assert value(spark, text, declared) == expected


@pytest.mark.parametrize(
    "text, encoding, expected",
    [("aGk=", "base64", b"hi"), ("68 69", "hex", b"hi"), ("hé", "raw", "hé".encode())],
)
def test_binary(spark, text, encoding, expected):
    assert bytes(value(spark, text, "blob", binary_encoding=encoding)) == expected


def test_timestamps_are_utc_whatever_the_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.5",)], "raw string")
    seconds = F.unix_micros(ct.coerce(F.col("raw"), "timestamp(6)"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert df.select(seconds.alias("s")).first().s == 1704067200500000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "text, declared",
    [("1_000", "int"), ("x", "double"), ("1,5", "decimal(9,2)"), ("{", "json"), ("!!", "blob"), ("0000-00-00", "date"), ("300", "date")],
)
def test_bad_value_fails_with_text_and_type(spark, text, declared):
    with pytest.raises(Exception, match="cannot read") as failure:
        value(spark, text, declared)
    assert text in str(failure.value) and declared in str(failure.value)
    assert value(spark, text, declared, on_error="null") is None


def test_zero_dates(spark):
    assert value(spark, "0000-00-00", "date", zero_dates="null") is None
    assert value(spark, "2024-00-10", "datetime", zero_dates="null") is None
    assert value(spark, "0000-00-00", "date", zero_dates="string") == "0000-00-00"


def test_both_type_maps_agree(spark):
    declared = [b + s for bases in ct.LOGICAL_TYPES.values() for b in bases for s in ("", "(7,3)", "(50)", "(4) unsigned")]
    df = spark.createDataFrame([(d,) for d in declared], "d string")
    for r in df.select("d", ct.logical_type(F.col("d")).alias("l"), ct.spark_type_name(F.col("d")).alias("s")).collect():
        assert r.l == ct.logical_type_of(r.d)
        assert r.s == ct.spark_type(r.d).simpleString()


def test_json_as_variant(spark):
    assert isinstance(ct.spark_type("json", json_as="variant"), T.VariantType)
    assert value(spark, '{"a": 1}', "json", json_as="variant").toPython() == {"a": 1}
