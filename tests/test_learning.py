"""Types learnt from delimited files and from JSON messages."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import types as T

from millrace.sources.files import infer_delimited, read_inferred
from millrace.streaming.schemas import LearntMessages, field_paths, joined_type, learn_schema

LINES = ["1,a,2024-01-05,true,7", "20,bb", "na,c,na,FALSE,3000000000,1.5", "-3, d ,2024-02-29,,5,2e3", ",x"]


def write(folder, lines):
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.mark.parametrize("first", range(len(LINES)))
def test_schema_whichever_row_comes_first(spark, tmp_path, first):
    path = write(tmp_path / "in", [LINES[first], *LINES[:first], *LINES[first + 1 :]])
    schema = infer_delimited(spark, path, null_value="na")
    assert [f.dataType.simpleString() for f in schema] == ["int", "string", "date", "boolean", "bigint", "double"]


def test_rows_under_the_schema(spark, tmp_path):
    rows = read_inferred(spark, write(tmp_path / "in", LINES), null_value="na").collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == [
        (1, "a", dt.date(2024, 1, 5), True, 7, None),
        (20, "bb", None, None, None, None),
        (None, "c", None, False, 3_000_000_000, 1.5),
        (-3, "d", dt.date(2024, 2, 29), None, 5, 2000.0),
        (None, "x", None, None, None, None),
    ]


def test_one_token_decides(spark, tmp_path):
    """The only text of a position stands in the last of many rows."""
    path = write(tmp_path / "in", ["1,2"] * 5000 + ["1,two"])
    assert [f.dataType for f in infer_delimited(spark, path)] == [T.IntegerType(), T.StringType()]


def test_no_rows_and_no_values(spark, tmp_path):
    assert infer_delimited(spark, write(tmp_path / "a", [""])) == T.StructType()
    only_empty = infer_delimited(spark, write(tmp_path / "b", [",na", "na,"]), null_value="na")
    assert [f.dataType for f in only_empty] == [T.StringType(), T.StringType()]


TYPES = [
    T.NullType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType()),
    T.StructType().add("a", T.LongType()), T.StructType().add("a", T.DoubleType()).add("b", T.StringType()),
]


def by_name(kind):
    if isinstance(kind, T.StructType):
        return {f.name: by_name(f.dataType) for f in kind}
    return [by_name(kind.elementType)] if isinstance(kind, T.ArrayType) else kind.simpleString()


def test_types_form_a_lattice():
    for a, b, c in itertools.product(TYPES, repeat=3):
        assert by_name(joined_type(a, a)) == by_name(a)
        assert by_name(joined_type(a, b)) == by_name(joined_type(b, a))
        assert by_name(joined_type(joined_type(a, b), c)) == by_name(joined_type(a, joined_type(b, c)))


def test_schema_of_all_messages(spark):
    messages = ['{"a":1}', '{"a":2.5,"b":[{"c":null}]}', '{"b":[{"c":"x","d":{"e":true}}]}', "{bad", "", None, "[1]", "3", '{"b":[]}']
    frame = spark.createDataFrame([(m,) for m in messages], "value string").repartition(4)
    assert dict(field_paths(learn_schema(frame))) == {"a": "double", "b[].c": "string", "b[].d.e": "boolean"}
    assert learn_schema(frame.where("value = '{bad'")) == T.StructType()
    conflict = spark.createDataFrame([('{"a":1}',), ('{"a":{"b":2}}',)], "value string")
    assert dict(field_paths(learn_schema(conflict))) == {"a": "string"}


def test_batches_widen_the_schema(spark, tmp_path):
    learnt = LearntMessages(str(tmp_path / "learnt"))
    rows = T.StructType().add("n", T.LongType()).add("value", T.StringType())
    assert learnt.read(spark, rows).collect() == [] and learnt.schema(spark) == T.StructType()
    batches = [['{"a":1,"z":null}'], ["{bad"], [], ['{"a":"text","b":{"c":[1]}}', '{"z":false}']]
    for batch_id, messages in enumerate(batches):
        frame = spark.createDataFrame([(batch_id, m) for m in messages], rows)
        learnt.write_batch(frame, batch_id)
        learnt.write_batch(frame, batch_id)  # run again
    docs = [json.loads(r[0]) for r in learnt.read(spark, rows).selectExpr("to_json(struct(n, doc))").collect()]
    assert sorted(docs, key=str) == sorted(
        [
            {"n": 0, "doc": {"a": "1"}},
            {"n": 1, "doc": {"_corrupt_record": "{bad"}},
            {"n": 3, "doc": {"a": "text", "b": {"c": [1]}}},
            {"n": 3, "doc": {"z": False}},
        ],
        key=str,
    )
    kinds = [dict(field_paths(schema)) for _, schema in learnt.history(spark)]
    assert kinds[0] == kinds[1] == kinds[2] == {"a": "bigint", "z": "void"}
    assert kinds[3] == {"a": "string", "z": "boolean", "b.c[]": "bigint"}


def test_uncommitted_messages_are_not_read(spark, tmp_path):
    learnt = LearntMessages(str(tmp_path / "learnt"))
    frame = spark.createDataFrame([('{"a":1}',)], "value string")
    learnt.write_batch(frame, 0)
    frame.write.parquet(str(tmp_path / "learnt/messages/000000000001-lost"))
    assert learnt.read(spark, frame.schema).count() == 1
