"""Streams, upserts and replays."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.plans.visits import flatten_visits, malformed, older_visitors, parse_messages
from millrace.sources.streams import kafka_messages, kafka_options, table_rows, text_messages
from millrace.streaming.run import append_files, run_available, run_every, split_batch
from millrace.streaming import upsert
from millrace.streaming.ledger import BatchLedger, read_written
from millrace.streaming.upsert import Content, KeyedState, index_batches, latest_per_key
from millrace.workload import messages
from test_visits import AS_OF, MESSAGES, message, visitor

NOW = dt.datetime(2024, 6, 30, 7, 45)


def arrive(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(m for m in messages if m is not None) + "\n")


def visits_of(messages):
    return older_visitors(flatten_visits(parse_messages(messages), as_of=AS_OF, now=NOW))


def plain(frame):
    return sorted(frame.collect(), key=repr)


def test_stream_equals_batch(spark, tmp_path):
    arrive(tmp_path / "in", "1.json", MESSAGES)
    arrive(tmp_path / "in", "2.json", [message(visitor("zoe", 70))])
    stream = visits_of(text_messages(spark, str(tmp_path / "in")))
    append_files(stream, str(tmp_path / "out"), str(tmp_path / "offsets"))
    batch = visits_of(spark.read.text(str(tmp_path / "in")))
    assert plain(spark.read.schema(batch.schema).parquet(str(tmp_path / "out"))) == plain(batch)


def upsert_once(spark, tmp_path, log, checkpoint="offsets"):
    batches = []

    def batch(rows, batch_id):
        batches.append(batch_id)
        log.write_batch(rows, batch_id)

    run_available(visits_of(text_messages(spark, str(tmp_path / "in"))), batch, str(tmp_path / checkpoint))
    return batches


def test_later_batches_win_and_replays_change_nothing(spark, tmp_path):
    log = KeyedState(str(tmp_path / "log"), "custid", ("age",))
    schema = visits_of(spark.createDataFrame([], "value string")).schema
    ages = lambda current: {r.custid: r.age for r in current.current(spark, schema).collect()}

    arrive(tmp_path / "in", "1.json", [message(visitor("ann", 60), visitor("ann", 61)), message(visitor("bob", 40))])
    assert upsert_once(spark, tmp_path, log) == [0]
    assert ages(log) == {"ann": 61, "bob": 40}

    arrive(tmp_path / "in", "2.json", [message(visitor("ann", 50))])
    assert upsert_once(spark, tmp_path, log) == [1]
    assert ages(log) == {"ann": 50, "bob": 40}

    assert upsert_once(spark, tmp_path, log) == []  # nothing new: not called

    again = spark.createDataFrame([(message(visitor("ann", 50)),)], "value string")
    log.write_batch(visits_of(again), 1)
    assert log.ledger.entries(spark).count() == 2
    assert ages(log) == {"ann": 50, "bob": 40}
    with pytest.raises(ValueError, match="other rows"):
        log.write_batch(visits_of(spark.createDataFrame([(message(visitor("cal", 50)),)], "value string")), 1)
    later = spark.createDataFrame([(message(visitor("bob", 38)),)], "value string")
    log.write_batch(visits_of(later), 2)
    assert ages(log) == {"ann": 50, "bob": 38}


def test_nothing_before_the_first_batch(spark, tmp_path):
    log = KeyedState(str(tmp_path / "log"), "k", ("t",))
    schema = spark.createDataFrame([], "k string, t int").schema
    assert log.current(spark, schema).collect() == []
    assert log.ledger.entries(spark).collect() == []
    assert log.ledger.last(spark) is None
    assert read_written(spark, str(tmp_path / "none"), schema).columns == ["k", "t"]


@pytest.mark.parametrize("arrival", [True, False])
def test_many_batches_leave_few_folders(spark, tmp_path, monkeypatch, arrival):
    """Tails are merged and folded; NULL keys and map columns are rows like others."""
    monkeypatch.setattr(upsert, "MOST_TAILS", 2)
    log = KeyedState(str(tmp_path / "log"), "k", ("t",), arrival=arrival, buckets=3)
    schema = "k string, t long, v map<string,long>"
    known = {}
    for batch_id in range(9):
        size = 200 if batch_id == 0 else 13
        rows = [(None if k % 12 == 5 else f"k{(k * 7 + batch_id) % 210}", (k * 31 + batch_id * 17) % 97, {"n": 1000 * batch_id + k}) for k in range(size)]
        log.write_batch(spark.createDataFrame(rows, schema).repartition(2), batch_id)
        batch = {}
        for k, t, v in rows:  # equal places: the larger text of the map
            if k not in batch or (t, str(v)) > (batch[k][0], str(batch[k][1])):
                batch[k] = (t, v)
        for k, (t, v) in batch.items():
            if arrival or k not in known or (t, str(v)) > (known[k][0], str(known[k][1])):
                known[k] = (t, v)
        content = Content.of(log.ledger.last(spark)["content"])
        assert len(content.tails) <= 2
        if batch_id in (0, 4, 8):
            found = log.current(spark, spark.createDataFrame([], schema).schema).collect()
            assert {r.k: (r.t, r.v) for r in found} == known and len(found) == len(known)
    bases = [p for p in (tmp_path / "log").iterdir() if p.name.startswith("base")]
    assert 1 <= len(bases) < 4


def test_base_is_not_shuffled(spark, tmp_path):
    log = KeyedState(str(tmp_path / "log"), "k", ("t",), buckets=8)
    log.write_batch(spark.range(400).selectExpr("cast(id as string) as k", "id as t"), 0)
    log.write_batch(spark.range(3).selectExpr("cast(id as string) as k", "id + 9 as t"), 1)
    content = Content.of(log.ledger.last(spark)["content"])
    assert content.base_rows == 400 and len(content.tails) == 1
    current = log.current(spark, spark.createDataFrame([], "k string, t long").schema)
    assert current.count() == 400 and current.agg(F.max("t")).first()[0] == 399
    text = current._jdf.queryExecution().executedPlan().toString()
    join = text[text.index("SortMergeJoin") :]
    base_side = join[: join.index("base-")]
    assert "Exchange" not in base_side
    assert "Bucketed: true" in text


def test_uncommitted_batch_leaves_no_trace(spark, tmp_path, monkeypatch):
    log = KeyedState(str(tmp_path / "log"), "k", ("t",))
    schema = "k string, t int"
    log.write_batch(spark.createDataFrame([("a", 1)], schema), 0)
    commit = BatchLedger.commit

    def fail(*_):
        raise RuntimeError("lost before the entry")

    monkeypatch.setattr(BatchLedger, "commit", fail)
    with pytest.raises(RuntimeError):
        log.write_batch(spark.createDataFrame([("a", 5), ("b", 5)], schema), 1)
    monkeypatch.setattr(BatchLedger, "commit", commit)
    fields = spark.createDataFrame([], schema).schema
    assert plain(log.current(spark, fields)) == [("a", 1)]
    assert [r.batch_id for r in log.ledger.entries(spark).collect()] == [0]
    log.write_batch(spark.createDataFrame([("a", 5), ("b", 6)], schema), 1)
    assert plain(log.current(spark, fields)) == [("a", 5), ("b", 6)]


def test_ledger_reads_its_newest_folder(spark, tmp_path, monkeypatch):
    ledger = BatchLedger(str(tmp_path / "ledger"))
    for batch_id in (0, 999, 1000, 12_345):
        ledger.commit(spark, batch_id, {"n_rows": batch_id}, "{}")
    assert ledger.last(spark)["batch_id"] == 12_345
    assert ledger.entry(spark, 999)["n_rows"] == 999 and ledger.entry(spark, 5) is None
    assert ledger.entries(spark).count() == 4


def test_order_makes_batching_irrelevant(spark, tmp_path):
    """One file per batch, in any order, gives the state of one single batch."""
    rows = spark.range(400).selectExpr("cast(id % 50 as string) as k", "(id * 37) % 400 as t", "id as v")
    rows.repartition(6).write.parquet(str(tmp_path / "in"))
    log = KeyedState(str(tmp_path / "log"), "k", ("t",), arrival=False)
    batches = []

    def batch(frame, batch_id):
        batches.append(batch_id)
        log.write_batch(frame, batch_id)

    stream = table_rows(spark, str(tmp_path / "in"), rows.schema, maxFilesPerTrigger="1")
    run_available(stream, batch, str(tmp_path / "offsets"))
    assert batches == list(range(6))
    assert plain(log.current(spark, rows.schema)) == plain(latest_per_key(rows, "k", ["t"]))


def test_order_instead_of_arrival(spark, tmp_path):
    log = KeyedState(str(tmp_path / "log"), "k", ("t",), arrival=False)
    for batch_id, (t, v) in enumerate([(5, "new"), (3, "late")]):
        log.write_batch(spark.createDataFrame([("a", t, v)], "k string, t int, v string"), batch_id)
    schema = spark.createDataFrame([], "k string, t int, v string").schema
    assert [r.v for r in log.current(spark, schema).collect()] == ["new"]


def test_failed_batch_is_run_again(spark, tmp_path):
    arrive(tmp_path / "in", "1.json", [message(visitor("ann", 60))])
    log = KeyedState(str(tmp_path / "log"), "custid", ("age",))
    stream = lambda: visits_of(text_messages(spark, str(tmp_path / "in")))

    def write_then_fail(rows, batch_id):
        log.write_batch(rows, batch_id)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        run_available(stream(), write_then_fail, str(tmp_path / "offsets"))
    run_available(stream(), log.write_batch, str(tmp_path / "offsets"))
    assert [r.n_rows for r in log.ledger.entries(spark).collect()] == [1]
    assert log.current(spark, stream().schema).count() == 1


def test_bad_messages_are_set_aside(spark, tmp_path):
    arrive(tmp_path / "in", "1.json", MESSAGES)
    log = KeyedState(str(tmp_path / "log"), "custid", ("age",))

    def upsert(parsed, batch_id):
        log.write_batch(older_visitors(flatten_visits(parsed, as_of=AS_OF, now=NOW)), batch_id)

    parsed = parse_messages(text_messages(spark, str(tmp_path / "in")))
    run_available(parsed, split_batch(malformed, upsert, str(tmp_path / "bad")), str(tmp_path / "offsets"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    schema = visits_of(spark.createDataFrame([], "value string")).schema
    assert log.current(spark, schema).count() == 4


def test_interval_trigger_runs_until_stopped(spark, tmp_path):
    arrive(tmp_path / "in", "1.json", [message(visitor("ann", 60))])
    log = KeyedState(str(tmp_path / "log"), "custid", ("age",))
    stream = visits_of(text_messages(spark, str(tmp_path / "in")))
    query = run_every(stream, log.write_batch, str(tmp_path / "offsets"), "100 milliseconds")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert log.current(spark, stream.schema).count() == 1


def test_latest_per_key_with_a_hot_key(spark):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    latest = latest_per_key(rows, "k", ["id"])
    assert latest.columns == ["k", "id"]
    assert latest.where("k = 'hot'").first().id == 1998
    assert latest.count() == rows.select("k").distinct().count()


def test_latest_per_key_with_equal_order_is_repeatable(spark):
    rows = spark.range(300).selectExpr("id % 3 as k", "0 as t", "cast(id as string) as v", "struct(id) as nested")
    picks = [plain(latest_per_key(rows.repartition(n), "k", ["t"])) for n in (1, 3, 7)]
    assert picks[0] == picks[1] == picks[2]
    assert len(picks[0]) == 3


def test_index_receives_the_newest_row_of_each_key(spark, tmp_path):
    """Files stand for the index; its connector is not installed."""
    send = index_batches(str(tmp_path / "index"), "k", ["t"], {}, source="parquet")
    send(spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "k string, t int, v string"), 0)
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "index")).collect()) == ["new", "only"]


def test_kafka_options():
    options = kafka_options("a:1,b:2", ["t1", "t2"], maxOffsetsPerTrigger="5")
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t1,t2",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5",
    }


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka_messages(spark, "a:1", "t")


@pytest.fixture
def cut_events(spark, tmp_path, monkeypatch):
    """A folder with events whose batches need ten files each; what the queries store is below it."""
    monkeypatch.setattr(messages, "ROWS_PER_FILE", 10, raising=False)
    monkeypatch.setattr(messages, "fresh_path", lambda _, label: str(tmp_path / label))
    kind = "element_at(array('view', 'purchase', 'click', 'error'), cast(id % 4 + 1 as int)) as event_type"
    ts = "cast(timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id * 7919 % 1000 as int), 0) as timestamp_ntz) as ts"
    rows = spark.range(600).selectExpr("id as event_id", ts, "id % 50 as user_id", kind, "1.5d as value", "concat('{\"k\": ', 40 + id % 9, '}') as props")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    return tmp_path


def files_of_batches(folder):
    return len(list((folder / "cut-events").glob("*.parquet")))


def test_upsert_batches_are_read_by_many_tasks(spark, cut_events):
    state = plain(messages.stream_upsert_batches(spark, str(cut_events)))
    assert files_of_batches(cut_events) > 5 * messages.PARTS  # one file a batch before: one task parsed all of it
    visits = messages._visits(spark.read.parquet(str(cut_events / "events.parquet")))
    assert state == plain(messages._report(latest_per_key(visits, "custid", ["ts", "event_id"])))


def test_ledger_knows_batches_of_many_files(spark, cut_events):
    entries = {r.batch_id: r for r in messages.stream_ledger(spark, str(cut_events)).collect()}
    assert files_of_batches(cut_events) > 5 * messages.PARTS
    visits = messages._visits(spark.read.parquet(str(cut_events / "events.parquet")))
    counts = visits.groupBy((F.col("event_id") % messages.PARTS).alias("part")).count().collect()
    assert {b: r.n_rows for b, r in entries.items()} == {r.part: r["count"] for r in counts}


def test_later_batches_of_many_files_win(spark, cut_events):
    state = plain(messages.stream_upsert_by_arrival(spark, str(cut_events)))
    assert files_of_batches(cut_events) > 5 * messages.PARTS
    visits = messages._visits(spark.read.parquet(str(cut_events / "events.parquet"))).withColumn("part", F.col("event_id") % messages.PARTS)
    assert state == plain(messages._report(latest_per_key(visits, "custid", ["part", "ts", "event_id"])))
