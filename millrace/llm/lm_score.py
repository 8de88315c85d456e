"""Cross-entropy difference of documents under two n-gram models.

A target model and a background model are bigram models of the same form:
one shared vocabulary (the ``vocabulary`` most frequent words of all
documents; every other word is one unknown word), the same smoothing
(``smooth`` added to every count).  The target model counts the documents
whose key is in ``target``, the background model counts all documents.  Each
document gets its loss per token, in bits, under both, and their difference;
the lower, the more a document is like the target.

Documents are dealt into blocks by a hash of their key.  A block counts its
bigrams and sends each distinct one once, packed, to the bucket that adds up
its counts over all blocks and sends both losses back to the blocks that asked.
Counts are over all documents; the most frequent bigram reaches its bucket
once a block.  The only thing of the corpus that comes together is the
vocabulary with its counts, whose size is a parameter.

Words are runs of ASCII letters and digits and of non-ASCII bytes, A-Z
lower-cased; a start and an end symbol surround the words of a document.  A
null or wordless text has one token, the end.  Repeated rows count as often as
they occur.  Without target documents the target model knows nothing: every
word is as likely as any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path
from .arrays import ALNUM, byte_view, lowered, releasing_group, slices, word_bounds, word_hashes
from .buckets import bucket_count, packed, split, unpacked

VOCABULARY = 1 << 15
SMOOTH = 0.05
UNKNOWN, START, END, WORDS = 0, 1, 2, 3  # ids; those of words begin at 3


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = byte_view(part.column("_text"))
    data = lowered(data)
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    return word_hashes(data, starts, ends), first


def _parts(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in table.to_batches():
        yield from slices(batch, "_text")


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of their counts."""
    names, inverse = np.unique(keys, return_inverse=True)
    return names, *(np.bincount(inverse, c, len(names)).astype(np.int64) for c in counts)


def _is_target(part: pa.RecordBatch, target: pa.Table) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.is_in(part.column("_key"), target.column("_key").combine_chunks(), skip_nulls=True).to_numpy(zero_copy_only=False)


@dataclass
class Vocabulary:
    words: np.ndarray  # hashes, ascending; the place of a word plus WORDS is its id
    counts: np.ndarray  # times each id comes before another token: a row for the target and one for the background

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), UNKNOWN)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + WORDS, UNKNOWN)

    @property
    def size(self) -> int:
        return len(self.words) + WORDS

    def bigrams(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the bigrams of all texts, and where each text's begin."""
        count = len(first) - 1
        left = np.insert(self.ids(hashes), first[:-1], START)
        right = np.insert(self.ids(hashes), first[1:], END)
        return left * self.size + right, first + np.arange(count + 1)


def _blocked(docs: DataFrame, target: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame, int]:
    blocks = bucket_count(docs, text)
    place = F.pmod(F.xxhash64("_key"), F.lit(blocks)).cast("int").alias("block")
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).select(place, "_key", "_text")
    wanted = target.select(F.col(key).cast(source.schema["_key"].dataType).alias("_key")).dropna().distinct().select(place, "_key")
    return source, wanted, blocks


def learn_vocabulary(source: DataFrame, wanted: DataFrame, blocks: int, size: int = VOCABULARY) -> Vocabulary:
    """The most frequent words of all documents, with their counts in both models."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, background, target, texts = [], [], [], np.zeros(2, np.int64)
        for part in _parts(left):
            hashes, first = _words(part)
            chosen = _is_target(part, right)
            texts += (int(chosen.sum()), len(chosen))
            names, b, t = _summed(hashes, np.ones(len(hashes)), np.repeat(chosen, np.diff(first)))
            keys.append(names)
            background.append(b)
            target.append(t)
        if not keys:
            return pa.table({c: pa.nulls(0, k) for c, k in (("bucket", pa.int32()), ("words", pa.binary()), ("t", pa.binary()), ("b", pa.binary()), ("texts_t", pa.int64()), ("texts_b", pa.int64()))})
        names, b, t = _summed(np.concatenate(keys), np.concatenate(background), np.concatenate(target))
        order, present, begins = split(names, blocks)
        if not len(present):  # texts without words count as texts
            present, begins = np.zeros(1, np.int64), np.zeros(2, np.int64)
        first_row = np.arange(len(present)) == 0
        return pa.table({"bucket": pa.array(present, pa.int32()), "words": packed(names[order], begins), "t": packed(t[order], begins), "b": packed(b[order], begins), "texts_t": texts[0] * first_row, "texts_b": texts[1] * first_row})

    def add(table: pa.Table) -> pa.Table:
        names, t, b = _summed(*(unpacked(table.column(c), k) for c, k in (("words", np.uint64), ("t", np.int64), ("b", np.int64))))
        top = np.lexsort((names, -b))[:size]  # no other word of this bucket can be among the most frequent
        texts = [sum(table.column(c).to_pylist()) for c in ("texts_t", "texts_b")]
        rest = [int(x.sum() - x[top].sum()) for x in (t, b)]
        return pa.table(
            {
                "word": np.append(names[top].astype(np.int64), 0),
                "t": np.append(t[top], rest[0]),
                "b": np.append(b[top], rest[1]),
                "texts_t": np.append(np.zeros(len(top), np.int64), texts[0]),
                "texts_b": np.append(np.zeros(len(top), np.int64), texts[1]),
                "rest": np.append(np.zeros(len(top), bool), True),
            }
        )

    sent = source.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(releasing_group(count), "bucket int, words binary, t binary, b binary, texts_t long, texts_b long")
    added = sent.groupBy("bucket").applyInArrow(releasing_group(add), "word long, t long, b long, texts_t long, texts_b long, rest boolean")
    path = fresh_path(source.sparkSession, "words")
    added.write.parquet(path)
    added = source.sparkSession.read.parquet(path)
    total = added.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("t", "b", "texts_t", "texts_b")]).first()
    rows = added.where("NOT rest").orderBy(F.desc("b"), "word").limit(size).select("word", "t", "b").collect()
    words = np.array([r[0] for r in rows], np.int64).astype(np.uint64)
    order = np.argsort(words)
    counts = np.array([[r[1], r[2]] for r in rows], np.int64).reshape(-1, 2)[order].T
    unknown = np.array(total[:2]) - counts.sum(axis=1)
    special = np.stack([unknown, np.array(total[2:]), np.zeros(2, np.int64)], 1)
    return Vocabulary(words[order], np.concatenate([special, counts], 1))


def score_difference(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY, smooth: float = SMOOTH) -> DataFrame:
    """A row per document: key, ``n_tokens`` (with the end), ``target_loss``, ``background_loss``, ``difference``.

    ``target``: rows with the keys of the target documents.
    """
    source, wanted, blocks = _blocked(docs, target, key, text)
    known = learn_vocabulary(source, wanted, blocks, vocabulary)
    held = docs.sparkSession.sparkContext.broadcast(known)

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        vocab = held.value
        names, counts_t, counts_b = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        for part in _parts(left):
            hashes, first = _words(part)
            keys, at = vocab.bigrams(hashes, first)
            chosen = np.repeat(_is_target(part, right), np.diff(at))
            new, t, b = _summed(keys, chosen, np.ones(len(keys)))
            names, counts_t, counts_b = _summed(np.concatenate([names, new]), np.concatenate([counts_t, t]), np.concatenate([counts_b, b]))
        order, present, begins = split(names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), blocks)
        block = left.column("block")[0].as_py() if left.num_rows else 0
        return pa.table(
            {
                "bucket": pa.array(present, pa.int32()),
                "block": pa.array([block] * len(present), pa.int32()),
                "keys": packed(names[order], begins),
                "t": packed(counts_t[order].astype(np.int32), begins),
                "b": packed(counts_b[order].astype(np.int32), begins),
            }
        )

    def answer(table: pa.Table) -> pa.Table:
        vocab = held.value
        keys = unpacked(table.column("keys"), np.int64)
        names, inverse = np.unique(keys, return_inverse=True)
        losses = []
        for row, c in enumerate("tb"):
            count = np.bincount(inverse, unpacked(table.column(c), np.int32), len(names))
            before = vocab.counts[row][names // vocab.size]
            losses.append((np.log2(before + smooth * vocab.size) - np.log2(count + smooth)).astype(np.float32)[inverse])
        sizes = np.array([len(x.as_py()) // 8 for x in table.column("keys")])
        begins = np.concatenate([[0], np.cumsum(sizes)])
        return pa.table({"block": table.column("block"), "keys": packed(keys, begins), "t": packed(losses[0], begins), "b": packed(losses[1], begins)})

    asked = source.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(releasing_group(ask), "bucket int, block int, keys binary, t binary, b binary")
    answered = asked.groupBy("bucket").applyInArrow(releasing_group(answer), "block int, keys binary, t binary, b binary")

    key_type = source.schema["_key"].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField("n_tokens", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("target_loss", "background_loss", "difference"))])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        vocab = held.value
        keys = unpacked(right.column("keys"), np.int64)
        order = np.argsort(keys)
        keys = keys[order]
        losses = [unpacked(right.column(c), np.float32)[order].astype(float) for c in "tb"]
        out = []
        for part in _parts(left):
            hashes, first = _words(part)
            found, at = vocab.bigrams(hashes, first)
            place = np.searchsorted(keys, found)
            mean = [np.add.reduceat(x[place], at[:-1]) / np.diff(at) for x in losses]
            out.append(pa.RecordBatch.from_arrays([part.column("_key"), pa.array(np.diff(at)), *map(pa.array, mean), pa.array(mean[0] - mean[1])], names=schema.names))
        from pyspark.sql.pandas.types import to_arrow_schema

        return pa.Table.from_batches(out, out[0].schema if out else to_arrow_schema(schema))

    return source.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(releasing_group(score), schema)
