"""File, table, database and index sinks.

Locations and credentials always come from the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: type name in the text form of a record.
RECORD_NAME = "insureclass"

# Fixed value: data source of the search index connector.
SEARCH_INDEX = "org.elasticsearch.spark.sql"


def record_text(frame: DataFrame, name: str = RECORD_NAME) -> Column:
    """Text form of a row: ``name(a,b,...)``, with ``null`` for NULL."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in frame.columns]
    return F.concat(F.lit(f"{name}("), F.concat_ws(",", *parts), F.lit(")"))


def _by_slice(frame: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Bring rows of a slice together, in as many tasks as its size needs.

    Otherwise every task would write a file for each slice it holds.  Large
    slices are split and small ones share a task at run time.
    """
    return frame.hint("rebalance", *[F.col(name) for name in by])


def publish_views(**frames: DataFrame) -> None:
    """Make frames available to SQL text under the given names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def write_records_text(
    frame: DataFrame, path: str, name: str = RECORD_NAME, *, partitions: int | None = None, by: str | None = None
) -> None:
    """One line per record; fails if the path exists.

    ``by`` writes one folder per value of a column, such as the business day.
    """
    slices = [F.col(by).alias(f"{by}_slice")] if by else []
    lines = frame.select(record_text(frame, name).alias("value"), *slices)
    if by:
        lines = _by_slice(lines, (f"{by}_slice",))
    elif partitions:
        lines = lines.repartition(partitions)
    writer = lines.write.mode("errorifexists")
    (writer.partitionBy(f"{by}_slice") if by else writer).text(path)


def write_csv(frame: DataFrame, path: str, *, single_file: bool = False, by: tuple[str, ...] = (), **options) -> None:
    """Replace a CSV folder.  ``single_file`` puts all rows into one task."""
    out = _by_slice(frame, by) if by else frame
    if single_file:
        out = out.repartition(1)
    writer = out.write.mode("overwrite").options(**options)
    (writer.partitionBy(*by) if by else writer).csv(path)


def append_external_table(frame: DataFrame, table: str, path: str) -> None:
    """Append to a catalog table whose files stay at ``path``."""
    frame.write.mode("append").option("path", path).saveAsTable(table)


def append_jdbc(frame: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 8) -> None:
    """Append to a database table, over as many connections as given.

    The rows are dealt out anew for the writing, so the work before it keeps
    its own number of tasks.
    """
    frame.repartition(connections).write.mode("append").jdbc(url, table, properties=properties)


def upsert_search_index(
    frame: DataFrame, resource: str, key: str, options: dict[str, str], source: str = SEARCH_INDEX
) -> None:
    """Write documents whose id is ``key``, so a replay replaces them.

    Needs the index connector on the class path.
    """
    frame.write.format(source).mode("append").options(**{"es.mapping.id": key, **options}).save(resource)
