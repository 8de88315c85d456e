"""File line cleansing against plain Python on small files."""

import random

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from millrace.operators import lines as L
from millrace.plans.cleansing import cleanse_files, cleanse_to_files, merge
from millrace.sources.files import file_census, read_lines
from millrace.sources.layouts import POLICY_FIELDS

CONTROL = "".join(chr(c) for c in range(33))


@pytest.fixture(params=[134217728, 64], ids=["one block", "tiny blocks"])
def block_size(request, spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 16)
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def marks_joined(request, spark):
    if not request.param:
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        yield
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    else:
        yield


def stored(spark, path):
    return L.store_lines(read_lines(spark, path))


def write(folder, files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        (folder / name).write_text("".join(line + "\n" for line in content), newline="")
    return str(folder)


def expected_kept(files, scope, header=True, footer=True):
    groups = list(files.values()) if scope == "file" else [sum((files[n] for n in sorted(files)), [])]
    kept = []
    for group in groups:
        last = len(group) - 1
        for i, line in enumerate(group):
            if (header and i == 0) or (footer and i == last) or line == "":
                continue
            kept.append(line.strip(CONTROL))
    return sorted(kept)


def ragged(seed):
    """Random files: empty, single-line, blank lines, and very long last lines."""
    rng = random.Random(seed)
    words = ["", " ", "\t", "a,b", "x" * 5, " padded ", "1,2,3,", "y" * 40, "dup", "dup"]
    files = {}
    for i in range(rng.randint(1, 6)):
        body = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        if body and rng.random() < 0.4:
            body[-1] = "tail" * rng.randint(1, 100)
        files[f"in{i}.txt"] = body
    return files


@pytest.mark.parametrize("scope", ["file", "dataset"])
@pytest.mark.parametrize("seed", range(2))
def test_kept_lines_like_plain_python(spark, tmp_path, block_size, marks_joined, scope, seed):
    files = ragged(seed)
    labelled = L.label_file_lines(stored(spark, write(tmp_path / "in", files)), scope=scope)
    kept = sorted(row.value for row in L.kept_lines(labelled).select("value").collect())
    assert kept == expected_kept(files, scope)
    assert labelled.count() == sum(map(len, files.values()))


@pytest.mark.parametrize("header, footer", [(True, False), (False, True), (False, False)])
def test_header_and_footer_are_optional(spark, tmp_path, header, footer):
    files = {"a.txt": ["h", "1", "f"], "b.txt": ["h", "", "2", "f"]}
    labelled = L.label_file_lines(stored(spark, write(tmp_path / "in", files)), header=header, footer=footer)
    kept = sorted(row.value for row in L.kept_lines(labelled).select("value").collect())
    assert kept == expected_kept(files, "file", header, footer)


def test_roles_of_a_single_line_file(spark, tmp_path):
    path = write(tmp_path / "in", {"a.txt": ["only"], "b.txt": []})
    roles = [r.role for r in L.label_file_lines(stored(spark, path)).collect()]
    assert roles == [L.HEADER]


@pytest.mark.parametrize("scope", ["file", "dataset"])
def test_numbering(spark, tmp_path, block_size, marks_joined, scope):
    files = {f"p{i}.txt": [f"{i}-{j}" for j in range(n)] for i, n in enumerate([50, 0, 1, 120, 7])}
    numbered = L.number_lines(stored(spark, write(tmp_path / "in", files)), scope=scope)
    got = {row.value: row.line_no for row in numbered.collect()}
    if scope == "file":
        expected = {line: i for content in files.values() for i, line in enumerate(content)}
    else:
        everything = sum((files[name] for name in sorted(files)), [])
        expected = {line: i for i, line in enumerate(everything)}
    assert got == expected


def test_first_and_last_survivor(spark, tmp_path, block_size, marks_joined):
    files = {"a.txt": ["h", "", " one ", "two", "three", "", "f"], "b.txt": ["h", "solo", "f"], "c.txt": ["h", "f"]}
    kept = L.kept_lines(L.label_file_lines(stored(spark, write(tmp_path / "in", files))))
    rows = L.edge_file_lines(kept).collect()
    got = sorted((r.file_path[-5:], r.value, r.is_first, r.is_last) for r in rows)
    assert got == [
        ("a.txt", "one", True, False),
        ("a.txt", "three", False, True),
        ("b.txt", "solo", True, True),
    ]


def test_unknown_scope(spark, tmp_path):
    lines = stored(spark, write(tmp_path / "in", {"a.txt": ["x"]}))
    with pytest.raises(ValueError):
        L.label_file_lines(lines, scope="folder")
    with pytest.raises(ValueError):
        L.number_lines(lines, scope="folder")
    with pytest.raises(ValueError):
        L.edge_file_lines(lines.lines, scope="folder")


@pytest.mark.parametrize("scope", ["file", "dataset"])
def test_numbers_of_filtered_lines(spark, tmp_path, block_size, scope):
    """A line keeps its number whatever else has been filtered away."""
    files = {f"p{i}.txt": [f"{i}-{j}" for j in range(n)] for i, n in enumerate([30, 0, 1, 77])}
    store = stored(spark, write(tmp_path / "in", files))
    whole = {r.value: r.line_no for r in L.number_lines(store, scope=scope).collect()}
    some = L.number_lines(store, store.lines.where("value like '%5'"), scope=scope).collect()
    assert len(some) == 3 + 7 + 1
    assert all(whole[r.value] == r.line_no for r in some)


def test_first_and_last_of_everything(spark, tmp_path, block_size):
    files = {"a.txt": ["h", "f"], "b.txt": ["h", " one ", "two", "f"], "c.txt": ["h", "three", "f"], "d.txt": []}
    kept = L.kept_lines(L.label_file_lines(stored(spark, write(tmp_path / "in", files))))
    rows = L.edge_file_lines(kept, scope="dataset").collect()
    assert sorted((r.value, r.is_first, r.is_last) for r in rows) == [("one", True, False), ("three", False, True)]
    assert L.edge_file_lines(kept.where("value = 'none'"), scope="dataset").collect() == []


def test_lines_of_no_file(spark, tmp_path):
    store = stored(spark, write(tmp_path / "in", {"a.txt": [], "b.txt": []}))
    for scope in ("file", "dataset"):
        assert L.label_file_lines(store, scope=scope).collect() == []
        assert L.number_lines(store, scope=scope).collect() == []


def test_text_is_scanned_once(spark, tmp_path):
    """After the store is written, no plan reads text."""
    store = stored(spark, write(tmp_path / "in", {"a.txt": ["h", "1", "f"]}))
    kept = L.kept_lines(L.label_file_lines(store))
    for frame in (kept, L.number_lines(store, kept), L.edge_file_lines(kept), L.line_audit(L.label_file_lines(store), 1)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in text
        assert "FileScan parquet" in text


ROW = "1,2,2019-10-01,TN,src,net,http://x,c1,Individual,No"
FIRST = {
    "insuranceinfo1_a.csv": [
        ",".join(POLICY_FIELDS),
        ROW,
        ROW,
        "",
        "   ",
        "\t" + ROW.replace("1,2", "3,4", 1) + "\t",
        "short,1",
        "footer,5",
    ],
    "insuranceinfo1_b.csv": [
        ",".join(POLICY_FIELDS),
        ROW.replace("2019-10-01", "2019-10-02"),
        ROW + ",extra",
        "7,8" + "," * 8,
        '"q,uoted"' + ROW[1:],
        "footer,4",
    ],
}
SECOND = {"insuranceinfo2.csv": ["header", ROW, "9" + ROW[1:], "footer"]}


def test_cleanse_and_merge(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, FIRST | SECOND)
    first = cleanse_files(spark, f"{folder}/insuranceinfo1*")
    second = cleanse_files(spark, f"{folder}/insuranceinfo2*")
    assert first.records.columns == POLICY_FIELDS
    assert first.records.count() == 5
    rejects = sorted((r.width, r.first_token) for r in first.rejects.collect())
    assert rejects == [(1, ""), (2, "short"), (11, '"q'), (11, "1")]
    assert first.audit.first().asDict() == {
        "raw_lines": 14,
        "header_lines": 2,
        "footer_lines": 2,
        "blank_lines": 1,
        "kept_lines": 9,
        "accepted_lines": 5,
        "rejected_lines": 4,
    }
    merged = merge(first.records, second.records)
    assert merged.audit.first().asDict() == {"merged_rows": 7, "distinct_rows": 5, "duplicate_rows": 2}
    assert merged.records.count() == 5
    day = merged.records.where(F.col("BusinessDate") == "2019-10-01")
    assert day.count() == 3


@pytest.mark.parametrize("options", [{}, {"scope": "dataset"}, {"header": False, "footer": False}])
def test_one_job_gives_the_same_results(spark, tmp_path, options):
    folder = tmp_path / "in"
    write(folder, FIRST)
    lazily = cleanse_files(spark, f"{folder}/insuranceinfo1*", **options)
    at_once = cleanse_to_files(spark, f"{folder}/insuranceinfo1*", **options)
    for name in ("records", "rejects", "audit"):
        assert getattr(at_once, name).dtypes == getattr(lazily, name).dtypes
        assert sorted(getattr(at_once, name).collect()) == sorted(getattr(lazily, name).collect())


def test_one_job_over_empty_files(spark, tmp_path):
    done = cleanse_to_files(spark, write(tmp_path / "in", {"a.txt": []}))
    assert done.records.collect() == done.rejects.collect() == []
    assert set(done.audit.first()) == {0}


def test_held_lines_give_the_same_results(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, FIRST)
    free = cleanse_files(spark, f"{folder}/insuranceinfo1*")
    held = cleanse_files(spark, f"{folder}/insuranceinfo1*", hold=StorageLevel.MEMORY_AND_DISK)
    for name in ("records", "rejects", "audit"):
        assert sorted(getattr(held, name).collect()) == sorted(getattr(free, name).collect())
    assert "InMemoryTableScan" in held.audit._jdf.queryExecution().executedPlan().toString()
    spark.catalog.clearCache()


def test_dataset_scope_leaks_the_second_header(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, FIRST)
    literal = cleanse_files(spark, f"{folder}/insuranceinfo1*", scope="dataset")
    assert literal.records.where("IssuerId = 'IssuerId'").count() == 1
    assert literal.rejects.where("first_token = 'footer'").count() == 1
    assert cleanse_files(spark, f"{folder}/insuranceinfo1*").records.where("IssuerId = 'IssuerId'").isEmpty()


def test_census(spark, tmp_path):
    path = write(tmp_path / "in", {"a.txt": ["1", "", "3"], "b.txt": ["x"]})
    rows = {r.file_path[-5:]: r.lines for r in file_census(spark, path).collect()}
    assert rows == {"a.txt": 3, "b.txt": 1}


def test_lines_inside_a_column(spark):
    frame = spark.createDataFrame(
        [(1, "h\n\n a \nb\nf"), (2, "only"), (3, "h\nf"), (4, ""), (5, None), (6, "h\n \nf")], "id int, text string"
    )
    labelled = L.label_column_lines(L.split_column_lines(frame, "text"))
    kept = L.kept_lines(labelled).select("id", "value").collect()
    assert sorted(map(tuple, kept)) == [(1, "a"), (1, "b"), (6, "")]
    edges = {r.id: (r.first_line, r.last_line) for r in L.edge_column_lines(frame, "text").collect()}
    nothing = (None, None)
    assert edges == {1: ("a", "b"), 2: nothing, 3: nothing, 4: nothing, 5: nothing, 6: ("", "")}
    audit = {r.id: (r.raw_lines, r.kept_lines, r.rejected_lines) for r in L.line_audit(labelled, 1, ("id",)).collect()}
    assert audit == {1: (5, 2, 0), 2: (1, 0, 0), 3: (2, 0, 0), 4: (1, 0, 0), 6: (3, 1, 0)}
