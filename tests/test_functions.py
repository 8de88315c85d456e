import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, text


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("out")).first().out


@pytest.mark.parametrize(
    "value", ["", " ", "\t", " a ", "\ta\t", "\x00\x01 a b \r\n", "a ", " a", "é ", "\x1fx\x7f"]
)
def test_trim_strips_controls_and_spaces_only(spark, value):
    expected = value.strip("".join(chr(c) for c in range(33)))
    assert one(spark, text.trim_control(F.col("v")), v=value) == expected


@pytest.mark.parametrize("value", ["a,b,,", "", ",", "a", '"x,y",z'])
def test_tokens_keep_trailing_empties(spark, value):
    assert one(spark, text.tokens(F.col("v")), v=value) == value.split(",")


def test_tokens_take_the_separator_literally(spark):
    assert one(spark, text.tokens(F.col("v"), "|"), v="a|b") == ["a", "b"]


def test_composite_key(spark):
    frame = spark.createDataFrame([(1, 23), (12, 3), (None, 3)], "a int, b int")
    plain = frame.select(text.composite_key(F.col("a"), F.col("b")).alias("k"))
    assert [r.k for r in plain.collect()] == ["123", "123", None]
    spaced = frame.select(text.composite_key(F.col("a"), F.col("b"), separator="-").alias("k"))
    assert [r.k for r in spaced.collect()] == ["1-23", "12-3", None]


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://x", "httpsecured"),
        ("http://x", "httpnonsecured"),
        ("see https in the middle", "httpsecured"),
        ("HTTP://x", "noprotocol"),
        ("ftp://x", "noprotocol"),
        ("", "noprotocol"),
    ],
)
def test_protocol(spark, url, expected):
    assert one(spark, text.protocol_of(F.col("u")), u=url) == expected


def test_protocol_of_null(spark):
    assert one(spark, text.protocol_of(F.lit(None).cast("string"))) == "noprotocol"


@pytest.mark.parametrize("value", ["A-b_c 1!", "é%", "", "plain"])
def test_strip_special_agrees_with_its_udf(spark, value):
    frame = spark.createDataFrame([(value,), (None,)], "v string")
    strip = text.strip_special_udf()
    rows = frame.select(text.strip_special(F.col("v")).alias("a"), strip("v").alias("b")).collect()
    assert all(row.a == row.b for row in rows)
    assert rows[1].a is None


def test_known_or_default(spark):
    name = F.col("v")
    frame = spark.createDataFrame([("a-b",), (None,), ("",)], "v string")
    out = frame.select(text.known_or_default(name, text.strip_special(name)).alias("o")).collect()
    assert [r.o for r in out] == ["ab", "Unknown", ""]


def test_letters_route_predicate(spark):
    frame = spark.createDataFrame([("TN",), ("401",), (None,), ("",), ("4a",)], "v string")
    out = frame.select(text.has_letters(F.col("v")).alias("o")).collect()
    assert [r.o for r in out] == [True, False, None, False, True]


def test_parse_day_patterns(spark):
    assert one(spark, dates.parse_day(F.col("v")), v="2019-10-07") == dt.date(2019, 10, 7)
    assert one(spark, dates.parse_day(F.col("v"), dates.DAY_FIRST), v="07-10-2019") == dt.date(2019, 10, 7)
    for bad in ("07-10-2019", "2019-13-01", "", "x", "2019-10-07T01:02:03Z"):
        assert one(spark, dates.parse_day(F.col("v")), v=bad) is None


def test_parse_iso_day(spark):
    for good in ("1980-05-06", "1980-05-06T07:08:09Z", "1980-05-06T07:08:09.123Z"):
        assert one(spark, dates.parse_iso_day(F.col("v")), v=good) == dt.date(1980, 5, 6)
    assert one(spark, dates.parse_iso_day(F.col("v")), v="6 May 1980") is None


def test_clock_text_uses_minutes(spark):
    moment = F.lit(dt.datetime(2024, 3, 1, 7, 45)).cast("timestamp_ntz")
    assert one(spark, dates.clock_text(moment)) == "0745"
    assert one(spark, dates.clock_text(moment, "HHMM")) == "0703"


@pytest.mark.parametrize("days, age", [(0, 0), (182, 0), (183, 1), (365, 1), (547, 1), (548, 2), (14600, 40)])
def test_age_rounds_half_up(spark, days, age):
    today = dt.date(2024, 6, 30)
    born = F.lit(today - dt.timedelta(days=days))
    assert one(spark, dates.age_in_years(born, dates.as_of_date(today))) == age


def test_age_flag(spark):
    assert one(spark, dates.age_flag(F.lit(3), F.lit(3))) == "valid"
    assert one(spark, dates.age_flag(F.lit(3), F.lit(4))) == "invalid"
    assert one(spark, dates.age_flag(F.lit(None).cast("int"), F.lit(4))) == "invalid"


def test_today_is_the_default(spark):
    row = spark.range(1).select(dates.as_of_date(None).alias("d"), dates.as_of_time(None).alias("t"))
    assert dict(row.dtypes) == {"d": "date", "t": "timestamp"}
