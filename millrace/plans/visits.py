"""Customer visit messages: parse, quarantine and flatten.

The functions work alike on batch and streaming frames.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import age_flag, age_in_years, as_of_date, as_of_time, parse_iso_day
from ..sources.layouts import CORRUPT, VISIT, with_corrupt


def parse_messages(messages: DataFrame, schema: T.StructType = VISIT, value: str = "value") -> DataFrame:
    """Parse JSON text into ``doc``; the text stays for the quarantine.

    A message that is a list of documents becomes one row per document, since
    parsing to a single document would keep only the first.
    """
    text = F.col(value)
    listed = F.coalesce(F.from_json(text, "array<string>"), F.array(text))
    is_list = F.ltrim(text, F.lit(" \t\r\n")).startswith("[")
    texts = F.when(is_list, listed).otherwise(F.array(text))
    others = [name for name in messages.columns if name != value]
    each = messages.select(*others, F.explode_outer(texts).alias(value))
    doc = F.from_json(value, with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT})
    return each.withColumn("doc", doc).select(*messages.columns, "doc")


def malformed(parsed: DataFrame) -> DataFrame:
    """Messages that cannot be read in full, with their text."""
    return parsed.where(F.col(f"doc.{CORRUPT}").isNotNull()).drop("doc")


def flatten_visits(
    parsed: DataFrame,
    *,
    keep: tuple[str, ...] = (),
    as_of: dt.date | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    """One row per visitor of each well-formed message.

    The test for well-formedness comes after the explode and looks at the
    visitor's position too.  Placed earlier, Catalyst would move it below the
    parsing and parse every message once more for it.
    """
    today = as_of_date(as_of)
    parts = parsed.select(*keep, F.col(f"doc.{CORRUPT}").alias("bad"), F.col("doc.results").alias("results"))
    visitors = parts.select(*keep, "bad", F.posexplode_outer("results").alias("pos", "res"))
    visitors = visitors.where(F.when(F.col("bad").isNull(), F.col("pos")).isNotNull())
    born = parse_iso_day(F.col("res.dob.date"))
    place = F.col("res.location.coordinates")
    return visitors.select(
        *keep,
        F.col("res.login.username").alias("custid"),
        F.col("res.cell").alias("cell"),
        F.col("res.name.first").alias("first"),
        F.col("res.dob.age").alias("age"),
        F.col("res.email").alias("email"),
        F.col("res.location.city").alias("city"),
        F.concat(place["latitude"], F.lit(","), place["longitude"]).alias("coordinates"),
        born.alias("dob"),
        F.dayofmonth(born).alias("dob_date"),
        F.col("res.location.country").alias("country"),
        F.col("res.location.state").alias("state"),
        F.col("res.location.timezone").alias("timezone"),
        age_in_years(born, today).alias("agecompute"),
        today.alias("curdt"),
        as_of_time(now).alias("curts"),
    ).withColumn("ageflag", age_flag(F.col("agecompute"), F.col("age")))


def older_visitors(visits: DataFrame, above: int = 35) -> DataFrame:
    return visits.where(F.col("age") > above)
