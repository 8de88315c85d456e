"""Line-level cleansing: header and footer removal, numbering, width checks.

A labelled frame has ``value`` and ``role``; the role is one of header,
footer, blank and line.  Lines come from files (``store_lines``,
``label_file_lines``) or from a text column (``label_column_lines``);
everything after that is shared.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens, trim_control
from ..session import fresh_path
from .numbering import running_sums

HEADER, FOOTER, BLANK, LINE = "header", "footer", "blank", "line"

FILE, DATASET = "file", "dataset"


def _stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _check(scope: str) -> None:
    if scope not in (FILE, DATASET):
        raise ValueError(f"scope must be 'file' or 'dataset', not {scope!r}")


def _edges(blocks: DataFrame, scope: str) -> DataFrame:
    if scope == FILE:
        return blocks.groupBy("file_path").agg(
            F.min_by("first_id", "block_start").alias("first_id"), F.max_by("last_id", "block_start").alias("last_id")
        )
    place = F.struct("file_path", "block_start")
    ends = blocks.agg(F.min_by("first_id", place).alias("first_id"), F.max_by("last_id", place).alias("last_id"))
    return ends.where("first_id is not null")


@dataclass(frozen=True)
class LineStore:
    """Lines of text files as one scan has found them, and the directory of their blocks.

    ``lines`` has ``value``, ``file_path``, ``block_start`` and ``line_id``.
    ``blocks`` has a row per input split with lines: its first and last id and
    how many lines it has.  Positions and edges are looked up here, so they do
    not depend on what a caller has filtered since, nor on a second scan that
    might cut the files in another way.
    """

    folder: str
    lines: DataFrame
    blocks: DataFrame

    def edges(self, scope: str) -> DataFrame:
        """``first_id`` and ``last_id`` of every file, or of everything in path order."""
        _check(scope)
        return _edges(self.blocks, scope)

    @cached_property
    def starts(self) -> DataFrame:
        """``lines_before``: the lines of all blocks in front of each one, in path order."""
        sums = running_sums(self.blocks, "n_lines", ["file_path", "block_start"], name="lines_before")
        return _stored(sums, f"{self.folder}/starts")


def store_lines(lines: DataFrame, folder: str | None = None) -> LineStore:
    """Keep the result of ``read_lines`` in the shared folder.

    The text is scanned once; the directory comes from the stored keys.  This
    runs jobs.
    """
    folder = folder or fresh_path(lines.sparkSession, "lines")
    stored = _stored(lines, f"{folder}/lines")
    blocks = stored.groupBy("file_path", "block_start").agg(
        F.min("line_id").alias("first_id"), F.max("line_id").alias("last_id"), F.count(F.lit(1)).alias("n_lines")
    )
    return LineStore(folder, stored, _stored(blocks, f"{folder}/blocks"))


def label_file_lines(store: LineStore, *, scope: str = FILE, header: bool = True, footer: bool = True) -> DataFrame:
    """Give each stored line its role.

    ``scope="file"`` finds a header and a footer in every file; ``"dataset"``
    only the first line of the first file and the last line of the last one.
    A line that is both counts as header.

    The marks are joined by the unique ``line_id``: Spark broadcasts them if
    they are few, and otherwise no key of the shuffle is hot.
    """
    marks = store.edges(scope).select(
        F.inline(
            F.array(
                F.struct(F.col("first_id").alias("line_id"), F.lit(HEADER).alias("mark")),
                F.struct(F.col("last_id").alias("line_id"), F.lit(FOOTER).alias("mark")),
            )
        ),
        "first_id",
    )
    marks = marks.where((F.col("mark") == HEADER) | (F.col("line_id") != F.col("first_id")))
    wanted = [name for name, keep in ((HEADER, header), (FOOTER, footer)) if keep]
    marks = _stored(marks.where(F.col("mark").isin(wanted)).select("line_id", "mark"), fresh_path(store.lines.sparkSession, "marks"))
    return store.lines.join(marks, "line_id", "left").select(
        *store.lines.columns, F.coalesce("mark", _inner_role()).alias("role")
    )


def split_column_lines(frame: DataFrame, text: str, separator: str = "\n") -> DataFrame:
    """One row per line of a text column, with ``pos`` and ``n_lines``."""
    others = [name for name in frame.columns if name != text]
    parts = frame.select(*others, tokens(F.col(text), separator).alias("_lines"))
    return parts.select(
        *others, F.size("_lines").alias("n_lines"), F.posexplode("_lines").alias("pos", "value")
    )


def label_column_lines(lines: DataFrame, *, header: bool = True, footer: bool = True) -> DataFrame:
    """Roles for the lines of ``split_column_lines``; each text is a file."""
    role = _inner_role()
    if footer:
        role = F.when(F.col("pos") == F.col("n_lines") - 1, FOOTER).otherwise(role)
    if header:
        role = F.when(F.col("pos") == 0, HEADER).otherwise(role)
    return lines.withColumn("role", role)


def _inner_role() -> Column:
    """Blank means empty before trimming; a spaces-only line is not blank."""
    return F.when(F.length("value") == 0, BLANK).otherwise(LINE)


def kept_lines(labelled: DataFrame) -> DataFrame:
    """Lines that are no header, footer or blank, trimmed."""
    return labelled.where(F.col("role") == LINE).withColumn("value", trim_control(F.col("value")))


def tokenise(kept: DataFrame, separator: str = ",") -> DataFrame:
    """Add the tokens of each line and how many there are."""
    split = kept.withColumn("tok", tokens(F.col("value"), separator))
    return split.withColumn("width", F.size("tok"))


def of_width(tokenised: DataFrame, width: int) -> DataFrame:
    return tokenised.where(F.col("width") == width)


def reject_report(tokenised: DataFrame, width: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Width and first token of every line that has another width."""
    return tokenised.where(F.col("width") != width).select(
        *keep, "width", F.col("tok")[0].alias("first_token")
    )


def bind(tokenised: DataFrame, names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Name the tokens of lines that have exactly ``len(names)`` of them."""
    fitting = of_width(tokenised, len(names))
    return fitting.select(*keep, *[F.col("tok")[i].alias(name) for i, name in enumerate(names)])


def _line_counts(width: int, separator: str) -> list[Column]:
    is_line = F.col("role") == LINE
    fits = F.size(tokens(trim_control(F.col("value")), separator)) == width
    return [
        F.count(F.lit(1)).alias("raw_lines"),
        F.count_if(F.col("role") == HEADER).alias("header_lines"),
        F.count_if(F.col("role") == FOOTER).alias("footer_lines"),
        F.count_if(F.col("role") == BLANK).alias("blank_lines"),
        F.count_if(is_line).alias("kept_lines"),
        F.count_if(is_line & fits).alias("accepted_lines"),
        F.count_if(is_line & ~fits).alias("rejected_lines"),
    ]


def line_audit(labelled: DataFrame, width: int, by: tuple[str, ...] = (), separator: str = ",") -> DataFrame:
    """All row counts of the cleansing in one pass, overall or per ``by``."""
    counts = _line_counts(width, separator)
    return labelled.groupBy(*by).agg(*counts) if by else labelled.agg(*counts)


def observed_audit(labelled: DataFrame, width: int, separator: str = ",") -> tuple[DataFrame, Observation]:
    """The same lines, and the counts of ``line_audit`` that the job which writes them will find.

    The counts are there once that job has ended; they need no scan of their own.
    """
    audit = Observation()
    return labelled.observe(audit, *_line_counts(width, separator)), audit


def edge_file_lines(kept: DataFrame, *, scope: str = FILE) -> DataFrame:
    """The first and the last surviving line of files, or of everything in path order.

    ``kept`` keeps the keys of the store.  Only longs are aggregated; the
    texts are looked up afterwards.  This runs a job.
    """
    _check(scope)
    blocks = kept.groupBy("file_path", "block_start").agg(F.min("line_id").alias("first_id"), F.max("line_id").alias("last_id"))
    ids = _edges(blocks, scope).select(
        F.explode(F.array_distinct(F.array("first_id", "last_id"))).alias("line_id"), "first_id", "last_id"
    )
    ids = _stored(ids, fresh_path(kept.sparkSession, "edges"))
    return kept.join(ids, "line_id").select(
        "file_path",
        "value",
        (F.col("line_id") == F.col("first_id")).alias("is_first"),
        (F.col("line_id") == F.col("last_id")).alias("is_last"),
    )


def edge_column_lines(frame: DataFrame, text: str, separator: str = "\n") -> DataFrame:
    """First and last surviving line of each text, without a shuffle.

    NULL where nothing survives.
    """
    others = [name for name in frame.columns if name != text]
    inner = frame.select(*others, tokens(F.col(text), separator).alias("_lines"))
    last = F.size("_lines") - 1
    inner = inner.select(
        *others,
        F.filter("_lines", lambda line, pos: (pos > 0) & (pos < last) & (F.length(line) > 0)).alias("_kept"),
    )
    return inner.select(
        *others,
        trim_control(F.try_element_at("_kept", F.lit(1))).alias("first_line"),
        trim_control(F.try_element_at("_kept", F.lit(-1))).alias("last_line"),
    )


def number_lines(store: LineStore, lines: DataFrame | None = None, *, scope: str = DATASET) -> DataFrame:
    """Add ``line_no``: 0-based position in the file, or over all files in path order.

    ``lines`` may be any part of the store's lines that keeps their keys; a
    line has the same number in all of them.  The join is by input split, so
    no key is hot.
    """
    _check(scope)
    lines = store.lines if lines is None else lines
    starts = store.starts
    if scope == FILE:
        files = starts.groupBy("file_path").agg(F.min("lines_before").alias("_earlier"))
        starts = starts.join(files, "file_path").withColumn("lines_before", F.col("lines_before") - F.col("_earlier"))
    shifts = starts.select("file_path", "block_start", (F.col("lines_before") - F.col("first_id")).alias("_shift"))
    numbered = lines.join(shifts, ["file_path", "block_start"])
    return numbered.select(*lines.columns, (F.col("line_id") + F.col("_shift")).alias("line_no"))
