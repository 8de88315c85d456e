"""Delimited records: accepted and rejected rows always agree with counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.dates import DAY_FIRST
from millrace.operators.rows import drop_incomplete, on_route, route_by_letters, route_by_width
from millrace.operators.lines import tokenise
from millrace.plans.staging import (
    clean_network_names,
    enrich,
    protocol_report,
    stage_policies,
    states_and_customers,
)
from millrace.sources.files import accepted, load_delimited, read_mixed, read_records, record_audit, rejected
from millrace.sources.layouts import CATEGORY, POLICY, POLICY_FIELDS

HEADER = ",".join(POLICY_FIELDS)
GOOD = [
    "1,23,2019-10-01,TN,src,Net-Work!,https://a,401,Ind,No",
    "12,3,2019-11-02,TN,src,,http://a,401,Ind,No",
    "5,6,2019-10-03,KA,src,\"quo,ted\",nothing,402,Ind,No",
    "7,8,2019-10-04,KA,src,Net,,403,Ind,No",
    "9,9,2019-10-05,ZZ,src,Net,http://z,404,Ind,No",
]
BAD = [
    "x,6,2019-10-03,KA,src,Net,http://a,402,Ind,No",
    "5,6,03-10-2019,KA,src,Net,http://a,402,Ind,No",
    "5,6,2019-10-03,KA",
    "5,6,2019-10-03,KA,src,Net,http://a,402,Ind,No,more",
    "footer,5",
]


@pytest.fixture
def policies(spark, tmp_path):
    (tmp_path / "insurance1.csv").write_text("\n".join([HEADER, *GOOD, *BAD]) + "\n")
    return read_records(spark, str(tmp_path / "insurance1.csv"), POLICY)


def test_accepted_and_rejected(policies):
    assert accepted(policies).count() == len(GOOD)
    assert sorted(r[0] for r in rejected(policies).collect()) == sorted(BAD)
    assert record_audit(policies).first().asDict() == {
        "raw_records": 10,
        "accepted_records": 5,
        "rejected_records": 5,
        "complete_records": 3,
    }


@pytest.mark.parametrize("column", POLICY_FIELDS)
def test_any_projection_sees_the_same_rows(policies, column):
    assert accepted(policies).select(column).count() == len(GOOD)
    assert len(accepted(policies).select(column).collect()) == len(GOOD)


def test_day_first_dates(spark, tmp_path):
    path = tmp_path / "insurance2.csv"
    path.write_text("\n".join([HEADER, *[g.replace("2019-10-01", "01-10-2019") for g in GOOD]]) + "\n")
    records = accepted(read_records(spark, str(path), POLICY, date_format=DAY_FIRST))
    assert [r.BusinessDate for r in records.collect()] == [dt.date(2019, 10, 1)]


def test_staging(policies):
    staged = stage_policies(accepted(policies), as_of=dt.date(2024, 6, 30), now=dt.datetime(2024, 6, 30, 7, 45))
    assert "DentalOnlyPlan" not in staged.columns
    assert [r.issueridcomposite for r in staged.orderBy("BusinessDate").collect()].count("123") == 2
    assert drop_incomplete(staged).count() == 3
    network = clean_network_names(staged)
    assert network.columns == [name.lower() for name in network.columns]
    names = [r.cleansed_networkname for r in network.orderBy("businessdate").collect()]
    assert names == ["NetWork", "quoted", "Net", "Net", "Unknown"]
    assert {r.systs for r in network.collect()} == {"0745"}


CUSTOMERS = ["401,Ann,A,30,Pilot", "402,Bob,B,na,Cook", "403,Cyd,C,old,Cook", "na,Nil,N,50,Cook"]
STATES = ["TN,Tamil Nadu", "KA,Karnataka"]


@pytest.fixture(params=["customers first", "states first"])
def mixed(request, spark, tmp_path):
    rows = CUSTOMERS + STATES if request.param == "customers first" else STATES + CUSTOMERS
    (tmp_path / "custs_states.csv").write_text("\n".join(rows) + "\n")
    return read_mixed(spark, str(tmp_path / "custs_states*"))


def test_mixed_file(mixed):
    states, customers, other = states_and_customers(mixed)
    assert sorted(r.statecode for r in states.collect()) == ["KA", "TN"]
    assert sorted((r.custcode, r.age) for r in customers.collect()) == [("401", "30"), ("402", None), ("403", "old")]
    assert [r._c1 for r in other.collect()] == ["Nil"]


def test_mixed_lines_by_width(spark):
    lines = spark.createDataFrame([(v,) for v in [*CUSTOMERS, *STATES, "a,b,c"]], "value string")
    routed = route_by_width(tokenise(lines), {"customer": 5, "state": 2})
    assert on_route(routed, "customer").count() == 4
    assert on_route(routed, "state").count() == 2
    assert on_route(routed, "other").count() == 1


def test_letter_routes_cover_every_row(spark):
    frame = spark.createDataFrame([("TN",), ("401",), (None,), ("",)], "k string")
    rows = [r.route for r in route_by_letters(frame, "k").collect()]
    assert rows == ["state", "customer", "other", "customer"]


def test_report_equals_aggregated_detail(policies, mixed):
    network = clean_network_names(stage_policies(accepted(policies)))
    states, customers, _ = states_and_customers(mixed)
    detail = enrich(network, states, customers)
    assert detail.columns[-7:] == ["protocol", "year", "m", "statesdesc", "custname", "age", "proffession"]
    assert len(set(detail.columns)) == len(detail.columns)
    groups = detail.groupBy("statesdesc", "protocol", "proffession").agg(
        F.avg(F.col("age").try_cast("double")).alias("avg_age"), F.count("protocol").alias("count")
    )
    report = protocol_report(network, states, customers)
    assert report.columns == ["seqno", "avg_age", "count", "statesdesc", "protocol", "proffession"]
    key = lambda row: (row.statesdesc, row.protocol, row.proffession, row.avg_age, row["count"])
    assert sorted(map(key, report.collect()), key=repr) == sorted(map(key, groups.collect()), key=repr)
    assert [r.protocol for r in report.collect()] == sorted(r.protocol for r in report.collect())
    assert all(r.seqno == 1 for r in report.where("protocol = 'httpsecured'").collect())


def test_delimited_load(spark, tmp_path):
    (tmp_path / "part-0").write_text("1,2,Cleats\n2,x,Shoes\n")
    rows = load_delimited(spark, str(tmp_path), CATEGORY).collect()
    assert [tuple(r) for r in rows] == [(1, 2, "Cleats"), (2, None, "Shoes")]


def test_missing_values_in_reports(spark, tmp_path):
    """Missing ages, URLs and a whole group without any age."""
    network = spark.createDataFrame(
        [("S", "1", None), ("S", "1", "https://x"), ("S", "2", None), ("S", "2", None), (None, "1", "http://x"), ("S", None, "http://x")],
        "stcd string, custnum string, networkurl string",
    )
    states = spark.createDataFrame([("S", "State")], "statecode string, statedesc string")
    customers = spark.createDataFrame(
        [("1", "40", "cook"), ("2", None, "pilot")], "custcode string, age string, proffession string"
    )
    rows = protocol_report(network, states, customers).collect()
    assert [tuple(r) for r in rows] == [
        (1, 40.0, 1, "State", "httpsecured", "cook"),
        (1, None, 2, "State", "noprotocol", "pilot"),
        (2, 40.0, 1, "State", "noprotocol", "cook"),
    ]
