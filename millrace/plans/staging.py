"""Staging and reporting: policies, states and customers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import CLOCK, as_of_date, as_of_time, clock_text
from ..functions.text import composite_key, known_or_default, protocol_of, strip_special
from ..operators.rows import on_route, route_by_letters
from ..operators.tables import group_report, lower_names, precount
from ..sinks.bucketed import SALT, colocate


def stage_policies(
    policies: DataFrame,
    *,
    as_of: dt.date | None = None,
    now: dt.datetime | None = None,
    clock: str = CLOCK,
    key_separator: str = "",
) -> DataFrame:
    """Rename, derive and drop columns of accepted policy records."""
    return (
        policies.withColumnsRenamed({"StateCode": "stcd", "SourceName": "srcnm"})
        .withColumn(
            "issueridcomposite",
            composite_key(F.col("IssuerId"), F.col("IssuerId2"), separator=key_separator),
        )
        .drop("DentalOnlyPlan")
        .withColumns({"sysdt": as_of_date(as_of), "systs": clock_text(as_of_time(now), clock)})
    )


def clean_network_names(staged: DataFrame) -> DataFrame:
    """Replace the network name by its cleansed form; lower-case all names."""
    name = F.col("NetworkName")
    cleansed = staged.withColumn("cleansed_Networkname", known_or_default(name, strip_special(name)))
    return lower_names(cleansed.drop("NetworkName"))


def states_and_customers(mixed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split the mixed file; the third frame holds rows that fit neither."""
    routed = route_by_letters(mixed, "_c0")
    states = on_route(routed, "state").select(
        F.col("_c0").alias("statecode"), F.col("_c1").alias("statedesc")
    )
    customers = on_route(routed, "customer").toDF("custcode", "custname", "lname", "age", "proffession")
    return states, customers, on_route(routed, "other")


def colocate_policies(network: DataFrame, customers: DataFrame, folder: str, **layout: int) -> tuple[DataFrame, DataFrame]:
    """Policies and customers stored for joins that do not shuffle them; see ``colocate``."""
    return colocate(network, "custnum", customers, "custcode", folder, **layout)


def enrich(network: DataFrame, states: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per policy with its state, customer, protocol, year and month.

    No side is forced: Spark broadcasts what its size statistics allow and
    splits skewed partitions of the shuffled joins at run time.  Frames from
    ``colocate_policies`` are joined where they lie.
    """
    same = network["custnum"] == customers["custcode"]
    if SALT in network.columns and SALT in customers.columns:
        same = same & (network[SALT] == customers[SALT])
    return (
        network.join(customers, same)
        .join(states, F.col("stcd") == F.col("statecode"))
        .select(
            *[network[name] for name in network.columns if name != SALT],
            protocol_of(F.col("networkurl")).alias("protocol"),
            F.year("businessdate").alias("year"),
            F.month("businessdate").alias("m"),
            F.col("statedesc").alias("statesdesc"),
            "custname",
            "age",
            "proffession",
        )
    )


def protocol_report(network: DataFrame, states: DataFrame, customers: DataFrame) -> DataFrame:
    """Mean age and policy count per state, protocol and profession.

    Same groups as aggregating ``enrich``, but policies are counted per state
    code, customer and protocol first, so the joins see no hot customer.
    """
    counts = precount(
        network.select("stcd", "custnum", protocol_of(F.col("networkurl")).alias("protocol")),
        ["stcd", "custnum", "protocol"],
        "protocol",
    )
    joined = counts.join(states, F.col("stcd") == F.col("statecode")).join(
        customers, F.col("custnum") == F.col("custcode")
    )
    report = group_report(
        joined.withColumnRenamed("statedesc", "statesdesc"),
        ["statesdesc", "protocol", "proffession"],
        within="protocol",
        measure=F.col("age").try_cast("double"),
        mean_name="avg_age",
    )
    return report.orderBy("protocol", "seqno")
