"""Message parsing and flattening."""

import datetime as dt
import json

import pytest

from millrace.plans.visits import flatten_visits, malformed, older_visitors, parse_messages
from millrace.sources.layouts import VISIT

AS_OF = dt.date(2024, 6, 30)

# Columns of the indexed document, in order; two more are computed on the way.
COLUMNS = (
    "custid cell first age email city coordinates dob dob_date country state timezone curdt curts"
).split()


def visitor(name, age, latitude="1.5", date="1980-05-06T07:08:09.123Z"):
    return {
        "login": {"username": name},
        "cell": "123",
        "name": {"first": name.upper()},
        "dob": {"age": age, "date": date},
        "email": f"{name}@example.com",
        "location": {
            "city": "C",
            "state": "S",
            "country": "D",
            "coordinates": {"latitude": latitude, "longitude": "2.5"},
            "timezone": {"offset": "+1:00", "description": "x"},
        },
    }


def message(*visitors):
    return json.dumps({"results": list(visitors)})


MESSAGES = [
    message(visitor("ann", 44), visitor("bob", 36), visitor("cyd", 35)),
    message(),
    message(visitor("dan", 50, latitude=None)),
    message(visitor("eve", 50, date="not a date")),
    json.dumps({"info": 1}),
    "{ broken",
    '{"results": "text"}',
    None,
]


@pytest.fixture
def parsed(spark):
    return parse_messages(spark.createDataFrame([(m,) for m in MESSAGES], "value string"))


def test_flatten(parsed):
    visits = older_visitors(flatten_visits(parsed, as_of=AS_OF))
    assert [c for c in visits.columns if c not in ("agecompute", "ageflag")] == COLUMNS
    rows = {r.custid: r for r in visits.collect()}
    assert sorted(rows) == ["ann", "bob", "dan", "eve"]
    ann = rows["ann"]
    assert (ann.first, ann.coordinates, ann.dob, ann.dob_date) == ("ANN", "1.5,2.5", dt.date(1980, 5, 6), 6)
    assert (ann.timezone.offset, ann.curdt, ann.agecompute, ann.ageflag) == ("+1:00", AS_OF, 44, "valid")
    assert rows["bob"].ageflag == "invalid"
    assert rows["dan"].coordinates is None
    assert (rows["eve"].dob, rows["eve"].agecompute, rows["eve"].ageflag) == (None, None, "invalid")


def test_quarantine_holds_exactly_the_unreadable(parsed):
    assert sorted(r.value for r in malformed(parsed).collect()) == sorted(['{"results": "text"}', "{ broken"])


def test_unused_derivations_do_not_reach_the_plan(parsed):
    visits = flatten_visits(parsed, as_of=AS_OF).select("custid")
    plan = visits._jdf.queryExecution().executedPlan().toString()
    assert "valid" not in plan


def test_parsed_once(parsed):
    visits = older_visitors(flatten_visits(parsed, as_of=AS_OF))
    plan = visits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(results") == 1


LISTS = [
    f"[{message(visitor('a', 40))}, {message(visitor('b', 41), visitor('c', 42))}]",
    f"  [ {message(visitor('d', 43))} ]",
    "[]",
    "[ {broken",
    message(visitor("e", 44)),
]


def test_lists_of_documents(spark, tmp_path):
    """The same documents as Spark's own reader gives, which drops bad ones."""
    parsed = parse_messages(spark.createDataFrame([(m,) for m in LISTS], "value string"))
    visits = flatten_visits(parsed, as_of=AS_OF)
    (tmp_path / "in.json").write_text("\n".join(LISTS) + "\n")
    documents = spark.read.schema(VISIT).option("mode", "DROPMALFORMED").json(str(tmp_path))
    expected = documents.selectExpr("explode(results.login.username) as custid")
    assert sorted(r.custid for r in visits.collect()) == sorted(r.custid for r in expected.collect()) == list("abcde")
    assert [r.value for r in malformed(parsed).collect()] == ["[ {broken"]
