"""The registered queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html_extract, lm_score, ngram_join, packing, prefix_trie, suffix_dedup, token_files, topk, toxicity, vector_codes, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


@register
def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.bpe_encode(table(spark, sf_dir, "documents"), path, keep=["doc_id"], decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join("ids", ",")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


@register
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.index_postings(table(spark, sf_dir, "documents"))
    found = decontaminate.find_passages(index, table(spark, sf_dir, "benchmark"), width=10)
    return found.select(
        F.col("doc_key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        digest(F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>")))).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)
    read = token_files.read_token_files(catalogue, lists=False)
    return token_files.with_starts(read).select(F.col("doc_key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@register
def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").withColumn("low_quality", 1 - F.col("quality"))
    chain = toxicity.train_chain(docs, labels, ["low_quality", "toxic"])
    return toxicity.score_chain(docs, chain, keep=["doc_id"])


@register
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), width=4, percent=85)


@register
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400, keep=["doc_id"])
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), digest(F.col("kept")).alias("kept_sha256"))


@register
def op5_lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return lm_score.score_difference(table(spark, sf_dir, "documents"), target)


@register
def op6_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select(F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


@register
def op8_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "id % 50 = 0", k=5, scale=256.0)


@register
def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_extract.extract_text(pages, html_extract.train_extractor(pages), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


SQL["op11_conversation_trie"] = """
    WITH turns AS (
        SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
        SELECT c, c - ((c % 100) + 100) % 100 AS base,
               xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
                               lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)),
                               4294967295), 4294967295) % 6 AS h
        FROM (SELECT DISTINCT c FROM turns)),
    said AS (
        SELECT ids.c, 0 AS kind, k, role, text FROM ids JOIN turns ON turns.c = base AND k <= h
        UNION ALL SELECT ids.c, 1, k, role, text FROM ids JOIN turns ON turns.c = ids.c AND k > h),
    rebuilt AS (
        SELECT c, row_number() OVER w AS d, text, list({'role': role, 'text': text}) OVER w AS path
        FROM said WINDOW w AS (PARTITION BY c ORDER BY kind, k)),
    members AS (
        SELECT c, 0 AS d, '' AS text, [] AS path FROM ids UNION ALL SELECT c, d, text, path FROM rebuilt),
    placed AS (SELECT c, d, text, min(c) OVER (PARTITION BY d, path) AS top, max(d) OVER (PARTITION BY c) AS size FROM members),
    nodes AS (
        SELECT top AS conv_id, d AS depth, count(*) AS n_convs, min(text) AS text,
               sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = size), '')) AS ends_sha256
        FROM placed GROUP BY ALL),
    upward AS (SELECT n.*, p.top AS parent_conv_id FROM nodes n LEFT JOIN placed p ON p.c = n.conv_id AND p.d = n.depth - 1),
    counted AS (
        SELECT u.*, (SELECT count(*) FROM upward v WHERE v.parent_conv_id = u.conv_id AND v.depth = u.depth + 1) AS n_children FROM upward u),
    sums AS (
        SELECT p.top AS conv_id, p.d AS depth, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * length(n.text)) AS saved_tokens
        FROM counted n JOIN placed p ON p.c = n.conv_id AND p.d <= n.depth GROUP BY ALL)
    SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
    FROM counted JOIN sums USING (conv_id, depth)
"""


@register
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@register
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.encode_vectors(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256.0, keep=["label"])
    return vector_codes.with_group_total(coded.codes, "label", "error", "label_error").select(
        F.col("key").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256")
    )


@register
def op13_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), length=1024, end=0)
    return pieces.select(
        F.col("doc_key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
