"""File and table readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import YEAR_FIRST
from ..functions.text import tokens
from .layouts import CORRUPT, MIXED, with_corrupt

# Smallest 64-bit integer: no hash value lies below it.
_LOWEST_HASH = -(2**63)


def read_lines(spark: SparkSession, paths: str | list[str], separator: str | None = None) -> DataFrame:
    """Text lines with the keys that place them in their file.

    ``line_id`` grows with the position inside one (file_path, block_start).
    It may differ from one reading to the next; ``store_lines`` settles it.
    """
    options = {"lineSep": separator} if separator else {}
    return spark.read.options(**options).text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def read_records(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    *,
    header: bool = True,
    delimiter: str = ",",
    escape: str = "'",
    date_format: str = YEAR_FIRST,
    **options: str,
) -> DataFrame:
    """Delimited records under a declared schema; bad ones keep their text.

    The result has a ``_corrupt_record`` column; see ``accepted`` and
    ``rejected``.
    """
    return (
        spark.read.schema(with_corrupt(schema))
        .options(
            header=header,
            sep=delimiter,
            escape=escape,
            dateFormat=date_format,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT,
            **options,
        )
        .csv(paths)
    )


def _every_field_parsed(records: DataFrame) -> Column:
    """Always true, but needs every column.

    Spark checks only the columns a query uses, so without this the same record
    would be bad in one query and good in another (``count`` uses none).
    """
    names = [name for name in records.columns if name != CORRUPT]
    return F.xxhash64(*names) >= F.lit(_LOWEST_HASH)


def accepted(records: DataFrame) -> DataFrame:
    """Records that fit the schema, the same ones whatever is selected later."""
    fits = F.col(CORRUPT).isNull() & _every_field_parsed(records)
    return records.where(fits).drop(CORRUPT)


def rejected(records: DataFrame) -> DataFrame:
    """Text of the records that do not fit the schema."""
    misfits = F.col(CORRUPT).isNotNull() & _every_field_parsed(records)
    return records.where(misfits).select(CORRUPT)


def record_audit(records: DataFrame) -> DataFrame:
    """Counts of raw, accepted, rejected and complete records in one pass."""
    fits = F.col(CORRUPT).isNull()
    names = [name for name in records.columns if name != CORRUPT]
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in names])
    return records.where(_every_field_parsed(records)).agg(
        F.count(F.lit(1)).alias("raw_records"),
        F.count_if(fits).alias("accepted_records"),
        F.count_if(~fits).alias("rejected_records"),
        F.count_if(fits & complete).alias("complete_records"),
    )


def read_mixed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The two-shape customer / state file as five text columns.

    The schema is declared, so it does not depend on which shape comes first;
    short records are padded with NULL.
    """
    return (
        spark.read.schema(MIXED)
        .options(sep=",", header=False, escape="'", nullValue="na", nanValue="0")
        .csv(paths)
    )


# Texts of numbers and truth values.
_WHOLE, _NUMBER, _TRUTH = r"^[+-]?\d+$", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$", r"(?i)^(true|false)$"


_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(), "boolean": T.BooleanType()}


def _kinds(token: Column) -> dict[str, Column]:
    """Does a token fit a type?  From the narrowest to the widest; anything is a string."""
    return {
        "int": token.rlike(_WHOLE) & token.try_cast("int").isNotNull(),
        "bigint": token.rlike(_WHOLE) & token.try_cast("long").isNotNull(),
        "double": token.rlike(_NUMBER),
        "date": token.rlike(r"^\d{4}-\d{2}-\d{2}$") & token.try_cast("date").isNotNull(),
        "boolean": token.rlike(_TRUTH),
    }


def infer_delimited(
    spark: SparkSession, paths: str | list[str], *, delimiter: str = ",", null_value: str = ""
) -> T.StructType:
    """The narrowest type of each position that all its tokens fit, from all rows of ragged files.

    The width is that of the longest row, whichever shape comes first.  Empty
    tokens and ``null_value`` fit every type; a position without any other is
    a string.  Both passes are aggregations that tasks begin by themselves.
    """
    lines = spark.read.text(paths)
    parts = lines.where(F.length("value") > 0).select(tokens(F.col("value"), delimiter).alias("tok"))
    width = parts.agg(F.max(F.size("tok"))).first()[0] or 0
    checks = []
    for k in range(width):
        token = F.trim(F.try_element_at("tok", F.lit(k + 1)))
        token = F.when(~token.isin("", null_value), token)
        checks.append(F.count(token).alias(f"n_{k}"))
        checks += [F.bool_and(F.when(token.isNotNull(), fits)).alias(f"{kind}_{k}") for kind, fits in _kinds(token).items()]
    found = parts.agg(*checks).first() if width else {}
    schema = T.StructType()
    for k in range(width):
        fitting = [kind for kind in _kinds(F.lit("")) if found[f"n_{k}"] and found[f"{kind}_{k}"]]
        schema.add(f"_c{k}", _TYPES[fitting[0]] if fitting else T.StringType())
    return schema


def read_inferred(
    spark: SparkSession, paths: str | list[str], *, delimiter: str = ",", null_value: str = "", **options: str
) -> DataFrame:
    """Ragged files under the schema that ``infer_delimited`` finds; short rows are padded with NULL."""
    schema = infer_delimited(spark, paths, delimiter=delimiter, null_value=null_value)
    return spark.read.schema(schema).csv(paths, sep=delimiter, nullValue=null_value, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, **options)


def load_delimited(spark: SparkSession, paths: str | list[str], schema: T.StructType, delimiter: str = ",") -> DataFrame:
    """Plain delimited load with named, typed fields; unreadable values are NULL."""
    return spark.read.schema(schema).csv(paths, sep=delimiter)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or a temporary view."""
    return spark.table(name)


def file_census(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Number of lines in each file."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"))
    return lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("lines"))
