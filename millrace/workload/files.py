"""Whole jobs over files that Spark derives from the given tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..operators.lines import (
    edge_file_lines,
    kept_lines,
    label_file_lines,
    line_audit,
    number_lines,
    split_column_lines,
    store_lines,
    tokenise,
)
from ..operators.rows import route_by_letters
from ..plans.cleansing import cleanse_files, cleanse_to_files, merge
from ..plans.staging import (
    clean_network_names,
    colocate_policies,
    enrich,
    protocol_report,
    stage_policies,
    states_and_customers,
)
from ..session import fresh_path
from ..sources.files import (
    accepted,
    file_census,
    infer_delimited,
    load_delimited,
    read_inferred,
    read_lines,
    read_mixed,
    read_records,
    read_table,
    record_audit,
    rejected,
)
from ..sources.layouts import POLICY, POLICY_FIELDS
from ..sinks.writers import append_external_table, publish_views, write_csv, write_records_text
from .base import query, table

AS_OF = dt.date(2024, 6, 30)
NOW = dt.datetime(2024, 6, 30, 7, 45)


# --- policies: one per order, with the ten fields of a policy record ---------

_POLICY_TEXT = """
    policy_text AS (
        SELECT o_orderkey AS IssuerId, o_custkey AS IssuerId2,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS BusinessDate,
               'NATION_' || CAST(o_custkey % 25 AS VARCHAR) AS StateCode, 'src' AS SourceName,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS NetworkName,
               CASE o_orderstatus WHEN 'F' THEN 'https://' WHEN 'O' THEN 'http://' ELSE 'ftp://' END || 'example.com' AS NetworkURL,
               CAST(o_custkey AS VARCHAR) AS custnum, 'Individual' AS MarketCoverage, 'No' AS DentalOnlyPlan
        FROM orders),
    policies AS (SELECT * FROM policy_text WHERE BusinessDate IS DISTINCT FROM 'unknown'),
    network AS (
        SELECT *, CAST(IssuerId AS VARCHAR) || CAST(IssuerId2 AS VARCHAR) AS issueridcomposite,
               CASE WHEN NetworkName IS NULL THEN 'Unknown'
                    ELSE regexp_replace(NetworkName, '[^A-Za-z0-9 ]', '', 'g') END AS cleansed_networkname,
               CASE WHEN strpos(NetworkURL, 'https') > 0 THEN 'httpsecured'
                    WHEN strpos(NetworkURL, 'http') > 0 THEN 'httpnonsecured' ELSE 'noprotocol' END AS protocol
        FROM policies),
    people AS (
        SELECT CAST(c_custkey AS VARCHAR) AS custcode, c_name AS custname,
               CASE WHEN c_nationkey <> 3 THEN c_nationkey + 20 END AS age, c_mktsegment AS proffession FROM customer)
"""


def _policy_rows(spark, sf_dir):
    """Policies as text; the lowest priority has a date that is none."""
    status = F.col("o_orderstatus")
    scheme = F.when(status == "F", "https://").when(status == "O", "http://").otherwise("ftp://")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("IssuerId"),
        F.col("o_custkey").cast("string").alias("IssuerId2"),
        F.when(F.col("o_orderpriority") == "5-LOW", "unknown")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("BusinessDate"),
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string")).alias("StateCode"),
        F.lit("src").alias("SourceName"),
        F.when(status != "P", F.col("o_orderpriority")).alias("NetworkName"),
        F.concat(scheme, F.lit("example.com")).alias("NetworkURL"),
        F.col("o_custkey").cast("string").alias("custnum"),
        F.lit("Individual").alias("MarketCoverage"),
        F.lit("No").alias("DentalOnlyPlan"),
    )


def _policy_records(spark, sf_dir):
    path = fresh_path(spark, "policies")
    write_csv(_policy_rows(spark, sf_dir), path, header=True)
    return read_records(spark, path, POLICY)


def _mixed_path(spark, sf_dir):
    """Customers (five fields), nations (two fields) and regions without a key in one folder."""
    path = fresh_path(spark, "custs-states")
    age = F.when(F.col("c_nationkey") != 3, (F.col("c_nationkey") + 20).cast("string")).otherwise("na")
    customers = table(spark, sf_dir, "customer").select(
        F.concat_ws(",", "c_custkey", "c_name", F.lit("last"), age, "c_mktsegment").alias("value")
    )
    states = table(spark, sf_dir, "nation").select(
        F.concat_ws(",", "n_name", F.concat(F.lit("State "), F.col("n_regionkey"))).alias("value")
    )
    keyless = table(spark, sf_dir, "region").select(F.concat_ws(",", F.lit("na"), "r_name").alias("value"))
    customers.unionByName(states).unionByName(keyless).write.text(path)
    return path


def _mixed_file(spark, sf_dir):
    return read_mixed(spark, _mixed_path(spark, sf_dir))


def _network(spark, sf_dir):
    staged = stage_policies(accepted(_policy_records(spark, sf_dir)), as_of=AS_OF, now=NOW)
    return clean_network_names(staged)


@query(
    "WITH"
    + _POLICY_TEXT
    + """
    SELECT CAST(IssuerId AS BIGINT) AS issuerid, CAST(IssuerId2 AS BIGINT) AS issuerid2, CAST(BusinessDate AS DATE) AS businessdate,
           StateCode AS stcd, SourceName AS srcnm, NetworkURL AS networkurl, custnum, MarketCoverage AS marketcoverage,
           issueridcomposite, DATE '2024-06-30' AS sysdt, '0745' AS systs, cleansed_networkname
    FROM network
    """
)
def policy_staging(spark, sf_dir):
    """CSV in, bad dates dropped, staged columns out."""
    network = _network(spark, sf_dir)
    return network.withColumns({name: F.col(name).cast("long") for name in ("issuerid", "issuerid2")})


@query(
    "WITH"
    + _POLICY_TEXT
    + """
    SELECT (SELECT COUNT(*) FROM policy_text) AS raw_records, (SELECT COUNT(*) FROM policies) AS accepted_records,
           (SELECT COUNT(*) FROM policy_text WHERE BusinessDate = 'unknown') AS rejected_records,
           (SELECT COUNT(*) FROM policies
            WHERE IssuerId2 IS NOT NULL AND BusinessDate IS NOT NULL AND NetworkName IS NOT NULL) AS complete_records
    """
)
def policy_audit(spark, sf_dir):
    return record_audit(_policy_records(spark, sf_dir))


@query(
    "WITH"
    + _POLICY_TEXT
    + """
    SELECT concat_ws(',', CAST(IssuerId AS VARCHAR), COALESCE(CAST(IssuerId2 AS VARCHAR), ''), BusinessDate, COALESCE(StateCode, ''), SourceName,
                     COALESCE(NetworkName, ''), NetworkURL, COALESCE(custnum, ''), MarketCoverage, DentalOnlyPlan) AS record
    FROM policy_text WHERE BusinessDate = 'unknown'
    """
)
def policy_rejects(spark, sf_dir):
    """Rejected records keep their text."""
    return rejected(_policy_records(spark, sf_dir)).toDF("record")


_MIXED = """
    WITH mixed AS (
        SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS label, 'last' AS lname,
               CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey + 20 AS VARCHAR) END AS age, c_mktsegment AS proffession
        FROM customer
        UNION ALL SELECT n_name, 'State ' || n_regionkey, NULL, NULL, NULL FROM nation
        UNION ALL SELECT NULL, r_name, NULL, NULL, NULL FROM region)
"""


@query(_MIXED + "SELECT *, CASE WHEN key IS NULL THEN 'other' WHEN upper(key) <> lower(key) THEN 'state' ELSE 'customer' END AS route FROM mixed")
def mixed_file_routes(spark, sf_dir):
    """Both shapes of the mixed file and the rows that fit neither, from one scan."""
    routed = route_by_letters(_mixed_file(spark, sf_dir), "_c0")
    return routed.toDF("key", "label", "lname", "age", "proffession", "route")


@query(
    _MIXED
    + r"""
    , tokens AS (
        SELECT unnest(range(5)) AS position, unnest([key, label, lname, age, proffession]) AS token FROM mixed),
    kinds AS (
        SELECT position, COUNT(token) AS n,
               COUNT(*) FILTER (regexp_full_match(token, '[+-]?[0-9]+') AND TRY_CAST(token AS INTEGER) IS NOT NULL) AS ints,
               COUNT(*) FILTER (regexp_full_match(token, '[+-]?[0-9]+') AND TRY_CAST(token AS BIGINT) IS NOT NULL) AS longs
        FROM tokens GROUP BY position)
    SELECT CAST(position AS BIGINT) AS position, CASE WHEN n > 0 AND ints = n THEN 'int' WHEN n > 0 AND longs = n THEN 'bigint' ELSE 'string' END AS kind
    FROM kinds
    """
)
def mixed_file_schema(spark, sf_dir):
    """The types that all rows of the mixed file allow, position by position."""
    schema = infer_delimited(spark, _mixed_path(spark, sf_dir), null_value="na")
    rows = [(k, f.dataType.simpleString()) for k, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "position long, kind string")


@query(_MIXED + "SELECT key, label, lname, CAST(age AS INTEGER) AS age, proffession FROM mixed")
def mixed_file_inferred(spark, sf_dir):
    """Rows of the mixed file under the types found."""
    path = _mixed_path(spark, sf_dir)
    return read_inferred(spark, path, null_value="na").toDF("key", "label", "lname", "age", "proffession")


_DETAIL = (
    "WITH"
    + _POLICY_TEXT
    + """
    SELECT CAST(IssuerId AS BIGINT) AS issuerid, cleansed_networkname, protocol, CAST(BusinessDate AS DATE) AS businessdate,
           CAST(YEAR(CAST(BusinessDate AS DATE)) AS BIGINT) AS year, CAST(MONTH(CAST(BusinessDate AS DATE)) AS BIGINT) AS m,
           'State ' || n_regionkey AS statesdesc, custname, CAST(age AS VARCHAR) AS age, proffession
    FROM network JOIN nation ON StateCode = n_name JOIN people ON custnum = custcode
    """
)


def _detail(network, states, customers):
    detail = enrich(network, states, customers)
    longs = {name: F.col(name).cast("long") for name in ("issuerid", "year", "m")}
    return detail.withColumns(longs).select(
        "issuerid", "cleansed_networkname", "protocol", "businessdate", "year", "m",
        "statesdesc", "custname", "age", "proffession",
    )


@query(_DETAIL)
def policy_detail(spark, sf_dir):
    states, customers, _ = states_and_customers(_mixed_file(spark, sf_dir))
    return _detail(_network(spark, sf_dir), states, customers)


@query(_DETAIL)
def policy_detail_colocated(spark, sf_dir):
    """The same from policies and customers that are stored in the same buckets."""
    states, customers, _ = states_and_customers(_mixed_file(spark, sf_dir))
    folder = fresh_path(spark, "colocated")
    return _detail(*_around(states, colocate_policies(_network(spark, sf_dir), customers, folder, buckets=8)))


def _around(states, stored):
    network, customers = stored
    return network, states, customers


@query(
    "WITH"
    + _POLICY_TEXT
    + """,
    groups AS (
        SELECT 'State ' || n_regionkey AS statesdesc, protocol, proffession,
               CAST(SUM(age) AS DOUBLE) / COUNT(age) AS avg_age, COUNT(protocol) AS count
        FROM network JOIN nation ON StateCode = n_name JOIN people ON custnum = custcode GROUP BY 1, 2, 3)
    SELECT CAST(ROW_NUMBER() OVER (PARTITION BY protocol ORDER BY count DESC, statesdesc NULLS FIRST, proffession NULLS FIRST) AS BIGINT) AS seqno,
           * FROM groups
    """
)
def policy_report(spark, sf_dir):
    """The whole staging job: files in, ranked report out."""
    states, customers, _ = states_and_customers(_mixed_file(spark, sf_dir))
    return protocol_report(_network(spark, sf_dir), states, customers)


# --- text drops: one line per policy, a header and a footer per file ---------


def _text_files(rows, place, header, label):
    """Text files of ``rows`` (file, place, value): lines in the order of ``place`` between a header and a footer.

    Each value of ``file`` is a folder with one file.
    """
    path = fresh_path(rows.sparkSession, label)
    ends = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    frame = F.array(
        F.struct(F.lit(0).alias("kind"), F.lit(header).alias("value")),
        F.struct(F.lit(2).alias("kind"), F.concat(F.lit("footer,"), F.col("n").cast("string")).alias("value")),
    )
    body = rows.select("file", F.lit(1).alias("kind"), *place, "value")
    everything = body.unionByName(ends.select("file", F.inline(frame)), allowMissingColumns=True)
    in_order = everything.repartition(F.col("file")).sortWithinPartitions("file", "kind", *place)
    in_order.select("file", "value").write.partitionBy("file").text(path, lineSep="\n")
    return path


def _file_name(number):
    return F.lpad(F.floor(number).cast("string"), 9, "0")


def _drop_file(rows, label):
    """Policies, 5,000 order keys to a file."""
    number = F.col("IssuerId").cast("long")
    line = F.concat_ws(",", *[F.coalesce(name, F.lit("")) for name in rows.columns])
    lines = rows.select(_file_name(number / 5000).alias("file"), number.alias("place"), line.alias("value"))
    return _text_files(lines, ["place"], ",".join(rows.columns), label)


_DROPS = (
    "WITH"
    + _POLICY_TEXT
    + """,
    first_drop AS (
        SELECT CAST(IssuerId AS VARCHAR) AS IssuerId, COALESCE(CAST(IssuerId2 AS VARCHAR), '') AS IssuerId2,
               COALESCE(BusinessDate, '') AS BusinessDate, COALESCE(StateCode, '') AS StateCode, SourceName,
               COALESCE(NetworkName, '') AS NetworkName, NetworkURL, COALESCE(custnum, '') AS custnum, MarketCoverage, DentalOnlyPlan
        FROM policy_text),
    second_drop AS (
        SELECT * REPLACE (CASE WHEN NetworkURL LIKE 'https%' THEN SourceName ELSE 'other' END AS SourceName) FROM first_drop)
"""
)


def _cleansed_drops(spark, sf_dir):
    """Two drops of several files; the second repeats the secured policies of the first."""
    rows = _policy_rows(spark, sf_dir)
    secured = F.col("NetworkURL").startswith("https")
    again = rows.withColumn("SourceName", F.when(secured, F.col("SourceName")).otherwise("other"))
    return [cleanse_to_files(spark, _drop_file(drop, "drop")) for drop in (rows, again.select(*POLICY_FIELDS))]


@query(_DROPS + "SELECT * FROM first_drop UNION SELECT * FROM second_drop")
def merged_drops(spark, sf_dir):
    """The whole cleansing job: text files in, distinct records out."""
    first, second = _cleansed_drops(spark, sf_dir)
    return merge(first.records, second.records).records


@query(
    _DROPS
    + """, merged AS (SELECT * FROM first_drop UNION ALL SELECT * FROM second_drop),
    distinct_rows AS (SELECT DISTINCT * FROM merged)
    SELECT (SELECT COUNT(*) FROM merged) AS merged_rows, (SELECT COUNT(*) FROM distinct_rows) AS distinct_rows,
           (SELECT COUNT(*) FROM merged) - (SELECT COUNT(*) FROM distinct_rows) AS duplicate_rows
    """
)
def merged_drops_audit(spark, sf_dir):
    first, second = _cleansed_drops(spark, sf_dir)
    return merge(first.records, second.records).audit


# --- ragged text: the lines of a hundred documents make a file ----------------

# Places of the two lines that follow a document.
_EMPTY_AT, _BLANKS_AT = 1_000_000_000, 1_000_000_001

_DOCUMENT_FILES = f"""
    WITH raw AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
    body AS (
        SELECT doc_id, pos, CASE WHEN (doc_id + pos) % 5 = 0 THEN chr(9) || line || ' ' || chr(9) ELSE line END AS value FROM raw
        UNION ALL SELECT doc_id, {_EMPTY_AT}, '' FROM documents
        UNION ALL SELECT doc_id, {_BLANKS_AT}, ' ' || chr(9) FROM documents WHERE doc_id % 3 = 0),
    placed AS (
        SELECT *, lpad(CAST(doc_id // 100 AS VARCHAR), 9, '0') AS file,
               row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id, pos) AS line_no FROM body),
    ends AS (SELECT file, MAX(line_no) AS n FROM placed GROUP BY file),
    text_lines AS (
        SELECT file, line_no, value FROM placed
        UNION ALL SELECT file, 0, 'header' FROM ends UNION ALL SELECT file, n + 1, 'footer,' || CAST(n AS VARCHAR) FROM ends),
    kept AS (
        SELECT file, line_no, regexp_replace(value, '^[\\x01-\\x20]+|[\\x01-\\x20]+$', '', 'g') AS line FROM placed WHERE value <> ''),
    lines AS (SELECT *, string_split(line, ',') AS tok FROM kept)
"""


def _document_lines(spark, sf_dir):
    """The stored lines of files with blank lines, and with tabs and spaces at the edges of others."""
    documents = table(spark, sf_dir, "documents")
    inner = split_column_lines(documents.select("doc_id", "text"), "text")
    padded = F.concat(F.lit("\t"), F.col("value"), F.lit(" \t"))
    value = F.when((F.col("doc_id") + F.col("pos")) % 5 == 0, padded).otherwise(F.col("value"))
    after = [
        documents.select("doc_id", F.lit(_EMPTY_AT).alias("pos"), F.lit("").alias("value")),
        documents.where("doc_id % 3 = 0").select("doc_id", F.lit(_BLANKS_AT).alias("pos"), F.lit(" \t").alias("value")),
    ]
    rows = inner.select("doc_id", "pos", value.alias("value")).unionByName(after[0]).unionByName(after[1])
    path = _text_files(rows.withColumn("file", _file_name(F.col("doc_id") / 100)), ["doc_id", "pos"], "header", "document-lines")
    return store_lines(read_lines(spark, path, "\n"))


def _folder():
    return F.regexp_extract("file_path", "file=([0-9]+)/", 1).alias("file")


@query(_DOCUMENT_FILES + "SELECT line, CAST(len(tok) AS BIGINT) AS width, tok[1] AS first_token FROM lines")
def file_lines(spark, sf_dir):
    """Lines of many text files without the header and footer of each."""
    tokenised = tokenise(kept_lines(label_file_lines(_document_lines(spark, sf_dir))))
    return tokenised.select(
        F.col("value").alias("line"), F.col("width").cast("long").alias("width"), F.col("tok")[0].alias("first_token")
    )


_COUNTS = """
    SELECT (SELECT COUNT(*) FROM text_lines) AS raw_lines, {edges} AS header_lines, {edges} AS footer_lines,
           (SELECT COUNT(*) FROM placed WHERE value = '') AS blank_lines, COUNT(*) AS kept_lines,
           COUNT(*) FILTER (len(string_split(line, ',')) = 3) AS accepted_lines,
           COUNT(*) FILTER (len(string_split(line, ',')) <> 3) AS rejected_lines
"""


@query(_DOCUMENT_FILES + _COUNTS.format(edges="(SELECT COUNT(*) FROM ends)") + "FROM lines")
def file_lines_audit(spark, sf_dir):
    """Audit of the same files; every file has one header and one footer."""
    return line_audit(label_file_lines(_document_lines(spark, sf_dir)), 3)


_ALL_BUT_TWO = """
    (SELECT line FROM kept
     UNION ALL SELECT value FROM text_lines WHERE line_no = 0 AND file > (SELECT MIN(file) FROM ends)
     UNION ALL SELECT value FROM text_lines WHERE value LIKE 'footer,%' AND (file, line_no) IN (SELECT (file, n + 1) FROM ends)
               AND file < (SELECT MAX(file) FROM ends))
"""


@query(_DOCUMENT_FILES + _COUNTS.format(edges="LEAST(1, (SELECT COUNT(*) FROM ends))") + "FROM" + _ALL_BUT_TWO)
def dataset_lines_audit(spark, sf_dir):
    """The literal first and last line of everything: inner headers and footers stay."""
    return line_audit(label_file_lines(_document_lines(spark, sf_dir), scope="dataset"), 3)


@query(
    _DOCUMENT_FILES
    + """
    SELECT file, line, line_no = MIN(line_no) OVER (PARTITION BY file) AS is_first, line_no = MAX(line_no) OVER (PARTITION BY file) AS is_last
    FROM kept QUALIFY is_first OR is_last
    """
)
def file_edges(spark, sf_dir):
    """First and last surviving line of every file."""
    edges = edge_file_lines(kept_lines(label_file_lines(_document_lines(spark, sf_dir))))
    return edges.select(_folder(), F.col("value").alias("line"), "is_first", "is_last")


@query(
    _DOCUMENT_FILES
    + """
    SELECT file, line, place = MIN(place) OVER () AS is_first, place = MAX(place) OVER () AS is_last
    FROM (SELECT *, {'file': file, 'line_no': line_no} AS place FROM kept) QUALIFY is_first OR is_last
    """
)
def dataset_edges(spark, sf_dir):
    """First and last surviving line of all files in path order."""
    edges = edge_file_lines(kept_lines(label_file_lines(_document_lines(spark, sf_dir))), scope="dataset")
    return edges.select(_folder(), F.col("value").alias("line"), "is_first", "is_last")


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS line, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS line_no FROM orders
    """
)
def numbered_lines(spark, sf_dir):
    """Position of every line over all files of a sorted text folder."""
    path = fresh_path(spark, "sorted-lines")
    orders = table(spark, sf_dir, "orders").select("o_orderkey").orderBy("o_orderkey")
    orders.select(F.col("o_orderkey").cast("string").alias("value")).write.text(path)
    return number_lines(store_lines(read_lines(spark, path))).select(F.col("value").alias("line"), "line_no")


@query(_DOCUMENT_FILES + "SELECT file, line_no, line FROM kept")
def numbered_file_lines(spark, sf_dir):
    """Surviving lines with their position in the file as it was."""
    store = _document_lines(spark, sf_dir)
    numbered = number_lines(store, kept_lines(label_file_lines(store)), scope="file")
    return numbered.select(_folder(), "line_no", F.col("value").alias("line"))


@query(
    _DROPS
    + """
    SELECT 'accepted' AS result, COUNT(*) AS n, COUNT(DISTINCT IssuerId) AS issuers FROM first_drop
    UNION ALL SELECT 'rejected', 0, 0 UNION ALL SELECT 'raw', COUNT(*) + 2 * COUNT(DISTINCT CAST(IssuerId AS BIGINT) // 5000), 0 FROM first_drop
    """
)
def held_drop_counts(spark, sf_dir):
    """Three actions on the lines of one drop, which are held in memory and on disk between them."""
    path = _drop_file(_policy_rows(spark, sf_dir), "drop")
    done = cleanse_files(spark, path, hold=StorageLevel.MEMORY_AND_DISK)
    accepted_rows = done.records.agg(F.lit("accepted").alias("result"), F.count(F.lit(1)).alias("n"), F.countDistinct("IssuerId").alias("issuers"))
    rejected_rows = done.rejects.agg(F.lit("rejected").alias("result"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("issuers"))
    raw = done.audit.select(F.lit("raw").alias("result"), F.col("raw_lines").alias("n"), F.lit(0).cast("long").alias("issuers"))
    return accepted_rows.unionByName(rejected_rows).unionByName(raw)


# --- round trips -------------------------------------------------------------

_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders
"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority"
    )


@query(_ORDERS)
def csv_roundtrip(spark, sf_dir):
    """CSV with a header and day-first dates."""
    orders, path = _orders(spark, sf_dir), fresh_path(spark, "orders-csv")
    write_csv(orders, path, header=True, dateFormat="dd-MM-yyyy")
    return accepted(read_records(spark, path, orders.schema, date_format="dd-MM-yyyy"))


@query(_ORDERS)
def delimited_roundtrip(spark, sf_dir):
    """Plain delimited files without a header, loaded under a schema."""
    orders, path = _orders(spark, sf_dir), fresh_path(spark, "orders-plain")
    write_csv(orders, path)
    return load_delimited(spark, path, orders.schema)


@query(_ORDERS)
def text_roundtrip(spark, sf_dir):
    """Records in text form, one per line."""
    orders, path = _orders(spark, sf_dir), fresh_path(spark, "orders-text")
    write_records_text(orders, path, "record")
    fields = F.split(F.regexp_extract("value", r"^record\((.*)\)$", 1), ",", -1)
    return read_lines(spark, path).select(
        *[F.nullif(fields[i], F.lit("null")).cast(f.dataType).alias(f.name) for i, f in enumerate(orders.schema)]
    )


@query(
    """
    SELECT CAST(ts AS DATE) AS day,
           'insureclass(' || concat_ws(',', COALESCE(CAST(event_id AS VARCHAR), 'null'), COALESCE(CAST(user_id AS VARCHAR), 'null'),
               COALESCE(event_type, 'null'), COALESCE(CAST(CAST(ts AS DATE) AS VARCHAR), 'null')) || ')' AS line
    FROM events
    """
)
def records_by_day(spark, sf_dir):
    """Records in text form, a folder for each business day; the day comes from the folder."""
    path = fresh_path(spark, "events-by-day")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"))
    write_records_text(events, path, by="day")
    day = F.url_decode(F.regexp_extract("file_path", "day_slice=([^/]*)/", 1))
    return read_lines(spark, path).select(day.try_cast("date").alias("day"), F.col("value").alias("line"))


@query("SELECT 3 AS files, COUNT(*) AS records, COUNT(DISTINCT o_orderkey) AS orders FROM orders")
def records_in_partitions(spark, sf_dir):
    """Records in text form, written by as many tasks as asked for."""
    path = fresh_path(spark, "orders-in-three")
    write_records_text(_orders(spark, sf_dir), path, partitions=3)
    lines = read_lines(spark, path)
    return lines.agg(
        F.countDistinct("file_path").cast("int").alias("files"), F.count(F.lit(1)).alias("records"), F.countDistinct("value").alias("orders")
    )


@query(_ORDERS)
def table_roundtrip(spark, sf_dir):
    """Two appends to an external table, read back through a view.

    The table entry is dropped at the end; the files stay.
    """
    orders, path = _orders(spark, sf_dir), fresh_path(spark, "orders-table")
    name = f"orders_{uuid.uuid4().hex}"
    finished = F.col("o_orderstatus") == "F"
    for part in (orders.where(finished), orders.where(~finished | finished.isNull())):
        append_external_table(part, name, path)
    publish_views(**{f"{name}_view": read_table(spark, name)})
    result = spark.sql(f"SELECT * FROM {name}_view")
    spark.catalog.dropTempView(f"{name}_view")
    spark.sql(f"DROP TABLE {name}")
    return result


@query("SELECT o_orderpriority AS folder, COUNT(*) AS lines FROM orders GROUP BY 1")
def file_census_by_folder(spark, sf_dir):
    """Lines per file, added up per partition folder."""
    path = fresh_path(spark, "orders-by-priority")
    write_csv(_orders(spark, sf_dir), path, by=("o_orderpriority",))
    folder = F.url_decode(F.regexp_extract("file_path", "o_orderpriority=([^/]*)/", 1))
    folder = F.nullif(folder, F.lit("__HIVE_DEFAULT_PARTITION__"))  # fixed value: folder of NULL
    return file_census(spark, path).groupBy(folder.alias("folder")).agg(F.sum("lines").alias("lines"))
