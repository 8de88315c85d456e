"""Row routing and row-level checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_letters

OTHER = "other"


def route_by_width(tokenised: DataFrame, routes: dict[str, int]) -> DataFrame:
    """Name the route of each line by its token count; the rest is "other"."""
    route = F.lit(OTHER)
    for name, width in routes.items():
        route = F.when(F.col("width") == width, name).otherwise(route)
    return tokenised.withColumn("route", route)


def route_by_letters(frame: DataFrame, key: str, with_letters: str = "state", without: str = "customer") -> DataFrame:
    """Route rows by whether their key has letters; a NULL key is "other"."""
    lettered = has_letters(F.col(key))
    route = F.when(lettered, with_letters).when(~lettered, without).otherwise(OTHER)
    return frame.withColumn("route", route)


def on_route(routed: DataFrame, name: str) -> DataFrame:
    return routed.where(F.col("route") == name).drop("route")


def drop_incomplete(frame: DataFrame) -> DataFrame:
    """Rows without any NULL."""
    return frame.na.drop("any")


def slice_of(frame: DataFrame, column: str, value: object) -> DataFrame:
    """Rows with one value of a column, such as one business day."""
    return frame.where(F.col(column) == F.lit(value))
