"""A training corpus from documents: the stages in order, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, ngram_join, suffix_dedup, toxicity
from millrace.session import fresh_path

#: Column with the identity of a row.
PLACE = "_place_of_document"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumn("low_quality", 1 - F.col("quality"))
    chain = toxicity.train_chain(docs, labels, ["low_quality", "toxic"])
    scored = toxicity.score_chain(docs.select(F.struct(*docs.columns).alias("_row")), chain, text="_row.text", keep=["_row"])
    return scored.where(~F.col("rejected")).select("_row.*")


def with_place(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Add the file and row that each document was read from: an identity that no two rows share.

    A frame that is no plain reading of files is written first.
    """

    def placed(frame: DataFrame) -> DataFrame:
        source = frame.metadataColumn("_metadata")
        place = F.struct(source["file_path"].alias("file"), source["row_index"].alias("row"))
        return frame.select(*[F.col(f"`{c}`") for c in docs.columns], place.alias(PLACE))

    try:
        return placed(docs)
    except AnalysisException:
        path = fresh_path(spark, "documents")
        docs.write.parquet(path)
        return placed(spark.read.schema(docs.schema).parquet(path))


def _same_place(docs: DataFrame, chosen: DataFrame) -> Column:
    return (docs[PLACE]["file"] == chosen["file"]) & (docs[PLACE]["row"] == chosen["row"])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id.

    Of rows that share this id one stays, the first in the files; a row
    without an id stays only if no row of its component has one.
    """
    docs = with_place(spark, docs)
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", PLACE)
    found = ngram_join.ngram_components(docs.select(key.alias("key"), "text"), width=5, percent=80, key="key")
    kept = found.where(F.col("key").eqNullSafe(F.col("component_id"))).select(f"key.{PLACE}.*")
    return docs.join(kept, _same_place(docs, kept), "left_semi").drop(PLACE)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of 400 bytes that occur elsewhere as well.

    A character that loses some of its bytes goes as a whole; a document of
    which nothing is left goes, too.  The text travels once, beside the other
    columns.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = docs.select(F.struct(others.alias("others"), F.col("text").isNull().alias("missing")).alias("_row"), "text")
    cut = suffix_dedup.remove_repeats(rows, length=400)
    untouched = F.size("removed") == 0
    kept = F.col("kept").cast("string")
    whole = F.coalesce(F.try_validate_utf8(kept), F.regexp_replace(F.make_valid_utf8(kept), "\ufffd", ""))
    left = F.when(untouched, F.when(~F.col("_row.missing"), kept)).otherwise(whole)
    done = cut.select("_row.others", untouched.alias("_untouched"), left.alias("_left")).where("_untouched or length(trim(_left)) > 0")
    named = {"text": F.col("_left")}
    if "n_chars" in docs.columns:
        named["n_chars"] = F.when(F.col("_untouched"), F.col("others.n_chars")).otherwise(F.char_length("_left").cast("long"))
    return done.select(*[(named[c] if c in named else F.col("others").getField(c)).alias(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    docs = with_place(spark, docs)
    index = decontaminate.index_postings(docs, key=PLACE)
    found = decontaminate.find_passages(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10)
    path = fresh_path(spark, "contaminated")
    found.where("n_hit > 0").select("doc_key.*").write.parquet(path)
    hit = spark.read.schema("file string, row long").parquet(path)
    return docs.join(hit, _same_place(docs, hit), "left_anti").drop(PLACE)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, checked by decoding them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.bpe_encode(docs, path, keep=["doc_id", "lang", "source", "text"], decoded=True)
    same = F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_copies),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("bpe_codec", encoded),
]

#: The stages train a classifier, follow links and run a tokenizer: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
