"""Nested messages, in batch and as streams.

Every event becomes one JSON message.  Purchases carry two visitors, clicks an
empty list, and error events start with a stray brace, so they cannot be parsed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans.visits import flatten_visits, malformed, older_visitors, parse_messages
from ..session import fresh_path
from ..sources.streams import table_rows
from ..streaming.run import append_files, run_available, split_batch
from ..streaming.ledger import read_written
from ..streaming.schemas import LearntMessages, field_paths
from ..streaming.upsert import KeyedState, latest_per_key
from .base import query, table

AS_OF = dt.date(2063, 7, 15)
KEYS = ("ts", "event_id")


def _visitor(name, age):
    def text(column):
        return F.col(column).cast("string")

    place = F.struct(
        F.concat(F.lit("City "), text("event_type")).alias("city"),
        F.lit("State").alias("state"),
        F.lit("Country").alias("country"),
        F.struct(
            F.when(F.col("event_type") != "view", text("user_id")).alias("latitude"),
            text("event_id").alias("longitude"),
        ).alias("coordinates"),
        F.struct(F.lit("+0:00").alias("offset"), F.lit("UTC").alias("description")).alias("timezone"),
    )
    return F.struct(
        F.struct(name.alias("username")).alias("login"),
        text("event_type").alias("cell"),
        F.struct(F.upper("event_type").alias("first")).alias("name"),
        F.struct(
            age.alias("age"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date")
        ).alias("dob"),
        F.concat(text("user_id"), F.lit("@example.com")).alias("email"),
        place.alias("location"),
    )


def _messages(events):
    """One message per event; the number of visitors depends on its type."""
    kind, k = F.col("event_type"), F.from_json("props", "k int")["k"]
    user = F.col("user_id").cast("string")
    count = F.when(kind == "purchase", 2).when(kind == "click", 0).otherwise(1)

    def visitor(number):
        return _visitor(F.concat(user, F.when(number == 1, "-guest").otherwise("")), k + number)

    results = F.transform(F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), count), visitor)
    start = F.when(kind == "error", "{").otherwise("")
    value = F.concat(start, F.to_json(F.struct(results.alias("results"))))
    return events.select("event_id", "ts", value.alias("value"))


def _visits(events):
    parsed = parse_messages(_messages(events))
    return older_visitors(flatten_visits(parsed, keep=KEYS, as_of=AS_OF))


def _report(visits):
    """Comparable columns: plain types, and without the moment of the run."""
    return visits.select(
        "custid",
        "cell",
        "first",
        F.col("age").cast("long").alias("age"),
        "email",
        "city",
        "coordinates",
        "dob",
        F.col("dob_date").cast("long").alias("dob_date"),
        "country",
        "state",
        F.col("timezone.offset").alias("timezone_offset"),
        F.col("agecompute").cast("long").alias("agecompute"),
        "ageflag",
        "curdt",
    )


_VISITS = """
    WITH entries AS (
        SELECT event_id, ts, event_type, user_id, CAST(user_id AS VARCHAR) AS custid,
               CAST(json_extract(props, '$.k') AS BIGINT) AS age
        FROM events WHERE COALESCE(event_type, '') NOT IN ('error', 'click')
        UNION ALL
        SELECT event_id, ts, event_type, user_id, CAST(user_id AS VARCHAR) || '-guest',
               CAST(json_extract(props, '$.k') AS BIGINT) + 1
        FROM events WHERE event_type = 'purchase'),
    aged AS (
        SELECT *, CAST(round(date_diff('day', CAST(ts AS DATE), DATE '2063-07-15') / 365.0::DOUBLE) AS BIGINT) AS agecompute
        FROM entries WHERE age > 35),
    visits AS (
        SELECT event_id, ts, custid, event_type AS cell, upper(event_type) AS first, age,
               CAST(user_id AS VARCHAR) || '@example.com' AS email, 'City ' || event_type AS city,
               CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) || ',' || CAST(event_id AS VARCHAR) END AS coordinates,
               CAST(ts AS DATE) AS dob, CAST(DAY(ts) AS BIGINT) AS dob_date, 'Country' AS country, 'State' AS state,
               '+0:00' AS timezone_offset, agecompute,
               CASE WHEN agecompute = age THEN 'valid' ELSE 'invalid' END AS ageflag, DATE '2063-07-15' AS curdt
        FROM aged)
"""
_FLAT = _VISITS + "SELECT * EXCLUDE (event_id, ts) FROM visits"
_NEWEST = (
    _VISITS
    + """
    SELECT * EXCLUDE (event_id, ts, place) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY custid ORDER BY ts DESC, event_id DESC) AS place FROM visits)
    WHERE place = 1
"""
)
_CUT = "SELECT event_id FROM events WHERE event_type = 'error'"


@query(_FLAT)
def envelope_flatten(spark, sf_dir):
    """Parse, explode, derive and filter, as a batch."""
    return _report(_visits(table(spark, sf_dir, "events")))


@query(_CUT)
def message_quarantine(spark, sf_dir):
    parsed = parse_messages(_messages(table(spark, sf_dir, "events")))
    return malformed(parsed).select("event_id")


@query(
    """
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
    WHERE place = 1
    """
)
def latest_event_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return latest_per_key(events, "user_id", ["ts", "event_id"]).drop("ts")


def _event_stream(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    return table_rows(spark, path, spark.read.parquet(path).schema, maxFilesPerTrigger="1000")


@query(_FLAT)
def stream_flatten(spark, sf_dir):
    """The batch transformation on a stream that appends to files."""
    out, checkpoint = fresh_path(spark, "visits"), fresh_path(spark, "offsets")
    visits = _report(_visits(_event_stream(spark, sf_dir)))
    append_files(visits, out, checkpoint)
    return read_written(spark, out, visits.schema)


@query(_NEWEST)
def stream_upsert(spark, sf_dir):
    """Micro-batches upserted by visitor, then the current state.

    The newest visit wins by its own time, so the result does not depend on how
    the input is cut into batches.
    """
    visits = _visits(_event_stream(spark, sf_dir))
    log = KeyedState(fresh_path(spark, "visit-log"), "custid", KEYS, arrival=False)
    run_available(visits, log.write_batch, fresh_path(spark, "offsets"))
    return _report(log.current(spark, visits.schema))


@query(_CUT)
def stream_quarantine(spark, sf_dir):
    """Bad messages of each micro-batch set aside, the others upserted."""
    parsed = parse_messages(_messages(_event_stream(spark, sf_dir)))
    visits_log, bad = fresh_path(spark, "visit-log"), fresh_path(spark, "bad-messages")
    log = KeyedState(visits_log, "custid", KEYS)

    def upsert(batch, batch_id):
        log.write_batch(older_visitors(flatten_visits(batch, keep=KEYS, as_of=AS_OF)), batch_id)

    run_available(parsed, split_batch(malformed, upsert, bad), fresh_path(spark, "offsets"))
    schema = "event_id bigint, ts timestamp_ntz, value string, batch_id bigint"
    return read_written(spark, f"{bad}/*", schema).select("event_id")


# --- several micro-batches -----------------------------------------------------

# Fixed value: batches that the events are cut into.
PARTS = 6

# Rows of a file of a batch, about: a file may be read by one task only.
ROWS_PER_FILE = 100_000


def _cut_events(spark, sf_dir):
    """A stream of the events, and a function that lets those of one remainder of their id arrive.

    A batch is as many files as its rows need, so that its tasks grow with it;
    what arrives between two runs of the stream is one batch.
    """
    events = table(spark, sf_dir, "events")
    path = fresh_path(spark, "cut-events")
    files = events.count() // (PARTS * ROWS_PER_FILE) + 1

    def arrive(part):
        events.where(F.pmod("event_id", F.lit(PARTS)) == part).repartition(files).write.mode("append").parquet(path)

    return table_rows(spark, path, events.schema), arrive


def _run_batches(stream, arrive, batch, offsets):
    """A run for each part, and one without new input at the end."""
    for part in range(PARTS):
        arrive(part)
        run_available(stream, batch, offsets)
    run_available(stream, batch, offsets)


def _upsert_batches(spark, sf_dir, arrival):
    """Every batch upserted, the last one twice, and a run without new input at the end."""
    events, arrive = _cut_events(spark, sf_dir)
    visits = _visits(events)
    state = KeyedState(fresh_path(spark, "visit-state"), "custid", KEYS, arrival=arrival, buckets=8, position="event_id")

    def batch(rows, batch_id):
        state.write_batch(rows, batch_id)
        if batch_id == PARTS - 1:
            state.write_batch(rows, batch_id)

    _run_batches(visits, arrive, batch, fresh_path(spark, "offsets"))
    return state, visits.schema


@query(_NEWEST)
def stream_upsert_batches(spark, sf_dir):
    """The same state as of one batch."""
    state, schema = _upsert_batches(spark, sf_dir, False)
    return _report(state.current(spark, schema))


@query(
    _VISITS
    + f"""
    SELECT * EXCLUDE (event_id, ts, place) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY custid ORDER BY event_id % {PARTS} DESC, ts DESC, event_id DESC) AS place FROM visits)
    WHERE place = 1
    """
)
def stream_upsert_by_arrival(spark, sf_dir):
    """A later batch wins, whatever the times of its visits."""
    state, schema = _upsert_batches(spark, sf_dir, True)
    return _report(state.current(spark, schema))


@query(
    _VISITS
    + f"""
    SELECT CAST(event_id % {PARTS} AS BIGINT) AS batch_id, COUNT(*) AS n_rows, CAST(MIN(event_id) AS VARCHAR) AS first_position,
           CAST(MAX(event_id) AS VARCHAR) AS last_position FROM visits GROUP BY 1
    """
)
def stream_ledger(spark, sf_dir):
    """Rows and positions of each committed batch; the replayed one is there once."""
    state, _ = _upsert_batches(spark, sf_dir, True)
    return state.ledger.entries(spark).select("batch_id", "n_rows", "first_position", "last_position")


# --- schemas that change between batches -----------------------------------------


def _drifting(events):
    """From the middle batch on, a visitor has a nationality and ages have a fraction."""
    later = F.pmod("event_id", F.lit(PARTS)) >= PARTS // 2
    age = F.from_json("props", "k int")["k"].cast("string")
    login = F.concat(F.lit('{"login":{"username":"'), F.coalesce(F.col("user_id").cast("string"), F.lit("")), F.lit('"},"dob":{"age":'), F.coalesce(age, F.lit("null")))
    entry = F.concat(login, F.when(later, F.concat(F.lit('.5},"nat":"'), F.lit("N"), F.col("event_id").cast("string"), F.lit('"}'))).otherwise("}}"))
    start = F.when(F.col("event_type") == "error", "{").otherwise("")
    return events.select("event_id", F.concat(start, F.lit('{"results":['), entry, F.lit("]}")).alias("value"))


def _learnt(spark, sf_dir):
    events, arrive = _cut_events(spark, sf_dir)
    rows = _drifting(events.where("event_id is not null and get_json_object(props, '$.k') is not null"))
    messages = LearntMessages(fresh_path(spark, "learnt"))
    _run_batches(rows, arrive, messages.write_batch, fresh_path(spark, "offsets"))
    return messages, rows.schema


_DRIFT = f"""
    WITH rows AS (
        SELECT event_id, event_id % {PARTS} AS part, event_type, CAST(user_id AS VARCHAR) AS username, CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events WHERE json_extract(props, '$.k') IS NOT NULL)
"""


@query(
    _DRIFT
    + f"""
    SELECT event_id, COALESCE(username, '') AS username, CASE WHEN part >= {PARTS // 2} THEN k + 0.5::DOUBLE ELSE CAST(k AS DOUBLE) END AS age,
           CASE WHEN part >= {PARTS // 2} THEN 'N' || CAST(event_id AS VARCHAR) END AS nat
    FROM rows WHERE COALESCE(event_type, '') <> 'error'
    """
)
def stream_learnt_schema(spark, sf_dir):
    """Messages of all batches under the schema that they have taught: a field is new and a type has widened half way."""
    messages, schema = _learnt(spark, sf_dir)
    entries = messages.read(spark, schema).select("event_id", F.explode("doc.results").alias("res"))
    return entries.select("event_id", F.col("res.login.username").alias("username"), F.col("res.dob.age").alias("age"), F.col("res.nat").alias("nat"))


@query(
    _DRIFT
    + f"""
    , batches AS (SELECT DISTINCT CAST(part AS BIGINT) AS batch_id FROM rows WHERE COALESCE(event_type, '') <> 'error')
    SELECT batch_id, 'results[].login.username' AS field, 'string' AS kind FROM batches
    UNION ALL SELECT batch_id, 'results[].dob.age', CASE WHEN batch_id >= {PARTS // 2} THEN 'double' ELSE 'bigint' END FROM batches
    UNION ALL SELECT batch_id, 'results[].nat', 'string' FROM batches WHERE batch_id >= {PARTS // 2}
    """
)
def stream_schema_history(spark, sf_dir):
    """Every field and its type after each batch."""
    messages, _ = _learnt(spark, sf_dir)
    rows = [(batch, *leaf) for batch, schema in messages.history(spark) for leaf in field_paths(schema)]
    return spark.createDataFrame(rows, "batch_id long, field string, kind string")
