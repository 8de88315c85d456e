"""Writers.  Database and index connectors are replaced by a recorder."""

import os
import uuid

import pytest
from pyspark.errors import AnalysisException

from millrace.sinks.writers import (
    append_external_table,
    append_jdbc,
    publish_views,
    upsert_search_index,
    write_csv,
    write_records_text,
)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (3, "c,d")], "id int, v string").repartition(3)


def parts(path):
    return [name for name in os.listdir(path) if name.startswith("part-")]


def test_text_form_of_records(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    write_records_text(rows, path, partitions=2)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["insureclass(1,a)", "insureclass(2,null)", "insureclass(3,c,d)"]
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_records_text(rows, path)


def test_text_by_slice(spark, tmp_path):
    path = str(tmp_path / "out")
    days = spark.createDataFrame([(1, "2019-10-01"), (2, "2019-10-02"), (3, "2019-10-01")], "id int, day string")
    write_records_text(days, path, by="day")
    first = spark.read.text(path).where("day_slice = '2019-10-01'")
    assert sorted(r.value for r in first.collect()) == ["insureclass(1,2019-10-01)", "insureclass(3,2019-10-01)"]


def test_views(spark, rows):
    publish_views(shop_view=rows)
    assert spark.sql("select count(v) as n from shop_view").first().n == 2
    publish_views(shop_view=rows.limit(0))
    assert spark.table("shop_view").isEmpty()
    spark.catalog.dropTempView("shop_view")


def test_csv_is_replaced_and_single_file_is_opt_in(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    write_csv(rows, path)
    assert len(parts(path)) > 1
    write_csv(rows, path, single_file=True)
    assert len(parts(path)) == 1
    assert spark.read.schema(rows.schema).csv(path).count() == 3


def test_csv_by_partition_folder(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    write_csv(rows, path, by=("id",))
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["id=1", "id=2", "id=3"]


def test_slices_are_not_scattered_and_hot_slices_are_split(spark, tmp_path):
    """Most slices are one file; the hot one is several, as are its shuffle neighbours."""
    rows = spark.range(40_000, numPartitions=16).selectExpr(
        "if(id % 3 > 0, 0, id % 50) as slice", "sha2(cast(id as string), 512) as filler"
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, "512KB")
    try:
        write_csv(rows, str(tmp_path / "out"), by=("slice",))
    finally:
        spark.conf.set(name, old)
    files = {f"slice={i}": len([n for n in os.listdir(tmp_path / "out" / f"slice={i}") if n.endswith(".csv")]) for i in range(50)}
    assert files.pop("slice=0") > 1
    assert sum(n == 1 for n in files.values()) > 35
    assert max(files.values()) < 16  # as many as the tasks that hold the rows
    assert spark.read.csv(str(tmp_path / "out")).count() == 40_000


def test_duplicate_names_are_refused(spark, rows, tmp_path):
    with pytest.raises(AnalysisException, match="COLUMN_ALREADY_EXISTS"):
        append_external_table(rows.select("id", "id"), f"stage_{uuid.uuid4().hex}", str(tmp_path / "out"))


def test_external_table_appends(spark, rows, tmp_path):
    name = f"stage_{uuid.uuid4().hex}"
    for _ in range(2):
        append_external_table(rows, name, str(tmp_path / "stage"))
    assert spark.table(name).count() == 6
    assert spark.catalog.getTable(name).tableType == "EXTERNAL"
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 6


class Recorder:
    """Stands for a frame and its writer, and notes the calls."""

    def __init__(self):
        self.calls = []

    @property
    def write(self):
        return self

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


def test_jdbc_call():
    frame = Recorder()
    append_jdbc(frame, "jdbc:x://host:1/db", "aggregated", {"user": "u"}, connections=4)
    assert frame.calls == [
        ("repartition", (4,), {}),
        ("mode", ("append",), {}),
        ("jdbc", ("jdbc:x://host:1/db", "aggregated"), {"properties": {"user": "u"}}),
    ]


def test_index_call_uses_the_key_as_document_id():
    frame = Recorder()
    upsert_search_index(frame, "index/type", "custid", {"es.nodes": "n"})
    assert frame.calls == [
        ("format", ("org.elasticsearch.spark.sql",), {}),
        ("mode", ("append",), {}),
        ("options", (), {"es.mapping.id": "custid", "es.nodes": "n"}),
        ("save", ("index/type",), {}),
    ]
