"""Cleansing of the lines inside a text column."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators.lines import (
    bind,
    edge_column_lines,
    kept_lines,
    label_column_lines,
    line_audit,
    reject_report,
    split_column_lines,
    tokenise,
)
from ..operators.rows import route_by_letters, route_by_width
from .base import query, table

WIDTH = 3
KEYS = ("doc_id", "pos")

_LINES = """
    WITH parts AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
    numbered AS (
        SELECT doc_id, source, len(lines) AS n, CAST(i - 1 AS BIGINT) AS pos, lines[i] AS line
        FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM parts)),
    labelled AS (
        SELECT *, CASE WHEN pos = 0 THEN 'header' WHEN pos = n - 1 THEN 'footer'
                       WHEN line = '' THEN 'blank' ELSE 'line' END AS role FROM numbered),
    kept AS (
        SELECT doc_id, source, pos, trim(line) AS line, string_split(trim(line), ',') AS tok
        FROM labelled WHERE role = 'line')
"""


def _labelled(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    lines = split_column_lines(documents, "text")
    return label_column_lines(lines.withColumn("pos", F.col("pos").cast("long")))


def _tokenised(spark, sf_dir):
    return tokenise(kept_lines(_labelled(spark, sf_dir)))


@query(_LINES + "SELECT doc_id, pos, line FROM kept")
def lines_cleaned(spark, sf_dir):
    return kept_lines(_labelled(spark, sf_dir)).select("doc_id", "pos", F.col("value").alias("line"))


@query(
    _LINES
    + f"SELECT doc_id, pos, CAST(len(tok) AS BIGINT) AS width, tok[1] AS first_token FROM kept WHERE len(tok) <> {WIDTH}"
)
def lines_rejected(spark, sf_dir):
    rejects = reject_report(_tokenised(spark, sf_dir), WIDTH, KEYS)
    return rejects.withColumn("width", F.col("width").cast("long"))


@query(
    _LINES
    + f"SELECT doc_id, pos, tok[1] AS one, tok[2] AS two, tok[3] AS three FROM kept WHERE len(tok) = {WIDTH}"
)
def lines_bound(spark, sf_dir):
    return bind(_tokenised(spark, sf_dir), ["one", "two", "three"], KEYS)


@query(
    _LINES
    + """, edges AS (SELECT doc_id, min_by(line, pos) AS first_line, max_by(line, pos) AS last_line FROM kept GROUP BY 1)
    SELECT d.doc_id, first_line, last_line FROM documents d LEFT JOIN edges e ON e.doc_id = d.doc_id
    """
)
def lines_first_last(spark, sf_dir):
    return edge_column_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


_AUDIT = f"""
           COUNT(*) AS raw_lines, COUNT(*) FILTER (role = 'header') AS header_lines,
           COUNT(*) FILTER (role = 'footer') AS footer_lines, COUNT(*) FILTER (role = 'blank') AS blank_lines,
           COUNT(*) FILTER (role = 'line') AS kept_lines,
           COUNT(*) FILTER (role = 'line' AND len(string_split(trim(line), ',')) = {WIDTH}) AS accepted_lines,
           COUNT(*) FILTER (role = 'line' AND len(string_split(trim(line), ',')) <> {WIDTH}) AS rejected_lines
    FROM labelled
"""


@query(_LINES + "SELECT" + _AUDIT)
def lines_audit(spark, sf_dir):
    return line_audit(_labelled(spark, sf_dir), WIDTH)


@query(_LINES + "SELECT source, " + _AUDIT + " GROUP BY source")
def lines_audit_by_source(spark, sf_dir):
    return line_audit(_labelled(spark, sf_dir), WIDTH, ("source",))


@query(
    _LINES
    + """
    SELECT doc_id, pos, CASE len(tok) WHEN 5 THEN 'customer' WHEN 2 THEN 'state' ELSE 'other' END AS route FROM kept
    """
)
def route_by_width_lines(spark, sf_dir):
    routed = route_by_width(_tokenised(spark, sf_dir), {"customer": 5, "state": 2})
    return routed.select("doc_id", "pos", "route")


@query(
    """
    WITH mixed AS (
        SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS detail FROM customer
        UNION ALL SELECT s_name, CAST(s_nationkey AS VARCHAR) FROM supplier
        UNION ALL SELECT NULLIF(o_orderstatus, 'P'), o_orderpriority FROM orders)
    SELECT key, detail, CASE WHEN upper(key) <> lower(key) THEN 'state'
                             WHEN upper(key) = lower(key) THEN 'customer' ELSE 'other' END AS route
    FROM mixed
    """
)
def route_by_alpha(spark, sf_dir):
    mixed = (
        table(spark, sf_dir, "customer").selectExpr("cast(c_custkey as string) as key", "c_mktsegment as detail")
        .unionByName(table(spark, sf_dir, "supplier").selectExpr("s_name as key", "cast(s_nationkey as string) as detail"))
        .unionByName(table(spark, sf_dir, "orders").selectExpr("nullif(o_orderstatus, 'P') as key", "o_orderpriority as detail"))
    )
    return route_by_letters(mixed, "key")


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS id, COALESCE(CAST(user_id AS VARCHAR), '') AS who,
           COALESCE(event_type, '') AS kind, '' AS rest
    FROM events
    """
)
def record_bind(spark, sf_dir):
    """Events as delimited text with an empty last field, bound again; NULL is empty text."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("event_id", "user_id", "event_type")]
    lines = table(spark, sf_dir, "events").select(F.concat_ws(",", *fields, F.lit("")).alias("value"))
    split = lines.select(tokens(F.col("value")).alias("tok")).withColumn("width", F.size("tok"))
    return bind(split, ["id", "who", "kind", "rest"])
