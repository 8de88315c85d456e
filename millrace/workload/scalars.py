"""Projections, scalar functions and UDFs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import (
    DAY_FIRST,
    age_flag,
    age_in_years,
    as_of_date,
    clock_text,
    parse_day,
    parse_iso_day,
)
from ..functions.text import (
    composite_key,
    known_or_default,
    protocol_of,
    strip_special,
    strip_special_udf,
)
from ..operators.tables import lower_names
from .base import query, table

AS_OF = dt.date(2024, 6, 30)


@query(
    """
    SELECT c_custkey AS custkey, c_name AS nm, CAST(c_nationkey AS VARCHAR) || CAST(c_custkey AS VARCHAR) AS compositekey,
           CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS separatedkey, c_mktsegment AS segment,
           DATE '2024-06-30' AS sysdt
    FROM customer
    """
)
def stage_projection(spark, sf_dir):
    """Rename, derive, drop, alias and lower-case column names."""
    parts = F.col("c_nationkey"), F.col("CustKey")
    staged = (
        table(spark, sf_dir, "customer")
        .withColumnsRenamed({"c_custkey": "CustKey", "c_name": "Nm"})
        .withColumn("CompositeKey", composite_key(*parts))
        .withColumn("SeparatedKey", composite_key(*parts, separator="-"))
        .withColumn("SysDt", as_of_date(AS_OF))
        .drop("c_acctbal")
    )
    return lower_names(
        staged.select("CustKey", "Nm", "CompositeKey", "SeparatedKey", F.col("c_mktsegment").alias("Segment"), "SysDt")
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN NULLIF(o_orderpriority, '5-LOW') IS NULL THEN 'Unknown'
           ELSE regexp_replace(o_orderpriority, '[^A-Za-z0-9 ]', '', 'g') END AS priority
    FROM orders
    """
)
def default_unknown(spark, sf_dir):
    name = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", known_or_default(name, strip_special(name)).alias("priority")
    )


_STRIPPED = """
    SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9 ]', '', 'g') AS plain FROM documents
"""


@query(_STRIPPED)
def strip_special_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", strip_special(F.col("text")).alias("plain"))


@query(_STRIPPED)
def strip_special_text_udf(spark, sf_dir):
    strip = strip_special_udf()
    return table(spark, sf_dir, "documents").select("doc_id", strip("text").alias("plain"))


@query(
    """
    SELECT page_id, CASE WHEN strpos(url, 'https') > 0 THEN 'httpsecured'
                         WHEN strpos(url, 'http') > 0 THEN 'httpnonsecured' ELSE 'noprotocol' END AS protocol,
           CAST(strpos(url, 'example') AS BIGINT) AS position
    FROM pages
    """
)
def protocol_class(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", protocol_of(url).alias("protocol"), F.instr(url, "example").cast("long").alias("position")
    )


@query(
    """
    SELECT event_id, CAST(YEAR(ts) AS BIGINT) AS y, CAST(MONTH(ts) AS BIGINT) AS m,
           CAST(DAY(ts) AS BIGINT) AS d, strftime(ts, '%H%M') AS clock, strftime(ts, '%H%m') AS hour_and_month
    FROM events
    """
)
def date_parts(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.year(ts).cast("long").alias("y"),
        F.month(ts).cast("long").alias("m"),
        F.dayofmonth(ts).cast("long").alias("d"),
        clock_text(ts).alias("clock"),
        clock_text(ts, "HHMM").alias("hour_and_month"),
    )


@query(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS year_first, CAST(o_orderdate AS DATE) AS day_first,
           CAST(o_orderdate AS DATE) AS iso, CAST(NULL AS DATE) AS wrong_pattern
    FROM orders
    """
)
def parse_dates(spark, sf_dir):
    day = F.col("o_orderdate")
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(day, "yyyy-MM-dd").alias("a"),
        F.date_format(day, "dd-MM-yyyy").alias("b"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("c"),
    )
    return texts.select(
        "o_orderkey",
        parse_day(F.col("a")).alias("year_first"),
        parse_day(F.col("b"), DAY_FIRST).alias("day_first"),
        parse_iso_day(F.col("c")).alias("iso"),
        parse_day(F.col("a"), DAY_FIRST).alias("wrong_pattern"),
    )


@query(
    """
    WITH ages AS (
        SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-06-30') AS days,
               2024 - YEAR(o_orderdate) AS stated FROM orders)
    SELECT o_orderkey, CAST(days AS BIGINT) AS days, CAST(round(days / 365.0::DOUBLE) AS BIGINT) AS age,
           CASE WHEN round(days / 365.0::DOUBLE) = stated THEN 'valid' ELSE 'invalid' END AS ageflag
    FROM ages
    """
)
def age_check(spark, sf_dir):
    born, today = F.col("o_orderdate").cast("date"), as_of_date(AS_OF)
    age = age_in_years(born, today)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.datediff(today, born).cast("long").alias("days"),
        age.cast("long").alias("age"),
        age_flag(age, F.lit(AS_OF.year) - F.year(born)).alias("ageflag"),
    )


@query(
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 35
    """
)
def json_field(spark, sf_dir):
    props = F.from_json("props", "k bigint")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k")).where("k > 35")
