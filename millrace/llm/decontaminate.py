"""Benchmark passages in training texts, by a positional inverted index.

``index_postings`` turns documents into shards: a shard holds, for the words of
some megabytes of text, each distinct word (as a 64-bit hash) with the sorted
list of its positions.  The shards are written as Parquet, so one index serves
any number of searches.

``find_passages`` looks for windows of the test items.  In each shard a window
is looked up from its rarest word on: the positions of that word, less its
offset in the window, are the candidate starts, and each further word, in the
order of rarity, leaves those that its own list, less its offset, has too.  A
window with a word that the shard lacks ends at once.  With ``slop`` the words
of a window may also stand further apart, in their order, with at most so many
other words between them.

Test items are processed in blocks of bounded size, each broadcast on its own
to all shards; the blocks' matches are put together per document.

Null and texts without words have no windows and no matches; an item or a
document with such a text is never contaminated.  An item of fewer words than
a window is one window.  Repeated rows are separate documents; items that
share an id are one item.  Empty tables give an index without shards, or no
matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path
from .arrays import ALNUM, byte_view, lowered, mix, releasing, slices, word_bounds, word_hashes

BLOCK_BYTES = 2 << 20  # of test items that are broadcast at once


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the first word of each text."""
    data, offsets = byte_view(column)
    data = lowered(data)
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    return word_hashes(data, starts, ends), first


def index_postings(docs: DataFrame, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the index and return it, a row per shard."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "postings")
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"doc_keys array<{source.schema['_key'].dataType.simpleString()}>, first_words binary, terms binary, begins binary, positions binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                hashes, first = words_of(part.column("_text"))
                order = np.argsort(hashes, kind="stable").astype(np.int32)
                terms, begins = np.unique(hashes[order], return_index=True)
                blobs = [first.astype(np.int32), terms, np.append(begins, len(hashes)).astype(np.int32), order]
                keys = part.column("_key")
                listed = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
                yield pa.RecordBatch.from_arrays([listed, *(pa.array([b.tobytes()], pa.binary()) for b in blobs)], names=["doc_keys", "first_words", "terms", "begins", "positions"])

    source.mapInArrow(releasing(run), schema).write.parquet(folder)
    return spark.read.parquet(folder)


class Shard:
    """One shard of the index in a task."""

    def __init__(self, first: bytes, terms: bytes, begins: bytes, positions: bytes):
        self.first = np.frombuffer(first, np.int32)
        self.terms = np.frombuffer(terms, np.uint64)
        self.begins = np.frombuffer(begins, np.int32)
        self.positions = np.frombuffer(positions, np.int32)

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word in the shard's terms, and how often it occurs (0 if absent)."""
        if not len(self.terms):
            return np.zeros(words.shape, np.int64), np.zeros(words.shape, np.int64)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return at, np.where(self.terms[at] == words, self.begins[at + 1] - self.begins[at], 0)

    def list_of(self, term: int) -> np.ndarray:
        return self.positions[self.begins[term] : self.begins[term + 1]]

    def phrase(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Starts of the exact phrase."""
        order = np.argsort(counts, kind="stable")
        starts = self.list_of(terms[order[0]]) - order[0]
        for k in order[1:]:
            held = self.list_of(terms[k])
            wanted = starts + k
            at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
            starts = starts[held[at] == wanted]
            if not len(starts):
                break
        return starts[starts >= 0]

    def within_documents(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The spans that end in the document they begin in."""
        good = ends <= self.first[np.searchsorted(self.first, starts, "right")] if len(starts) else np.zeros(0, bool)
        return starts[good], ends[good]

    def near(self, terms: np.ndarray, counts: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the phrase with at most ``slop`` other words in between."""
        reach = len(terms) + slop
        rarest = int(np.argmin(counts))
        starts = self.list_of(terms[0])
        held = self.list_of(terms[rarest])
        at = np.minimum(np.searchsorted(held, starts), len(held) - 1)
        starts = starts[(held[at] >= starts) & (held[at] < starts + reach)]
        last = starts
        for term in terms[1:]:
            held = self.list_of(term)
            at = np.searchsorted(held, last, "right")
            good = at < len(held)
            starts, last = starts[good], held[at[good]]
        good = last < starts + reach
        return starts[good], last[good] + 1


def test_windows(hashes: np.ndarray, first: np.ndarray, width: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: the different windows (rows of hashes), the items all together, and where those of each window begin."""
    found: dict[int, list] = {}
    for item, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if b > a:
            n = min(width, int(b - a))
            windows = np.lib.stride_tricks.sliding_window_view(hashes[a:b], n)
            found.setdefault(n, []).append((windows, np.full(len(windows), item)))
    return {n: different_windows(np.concatenate([w for w, _ in x]), np.concatenate([i for _, i in x])) for n, x in found.items()}


def different_windows(windows: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal windows made one.  Their order is by a hash, their equality by all words."""
    order = np.lexsort((items, window_keys(windows)))
    windows, items = windows[order], items[order]
    new = np.append(True, (windows[1:] != windows[:-1]).any(axis=1))
    other = new | np.append(True, items[1:] != items[:-1])  # an item is listed once for each window
    return windows[new], items[other], np.append(np.flatnonzero(new[other]), other.sum())


def window_keys(windows: np.ndarray) -> np.ndarray:
    keys = np.zeros(len(windows), np.uint64)
    for column in windows.T:
        keys = mix(keys * np.uint64(31) + column)
    return keys


def runs_of(starts: np.ndarray, ends: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping spans of the same ``of`` made one."""
    if not len(starts):
        return starts, ends, of
    order = np.lexsort((starts, of))
    starts, ends, of = starts[order].astype(np.int64), ends[order].astype(np.int64), of[order]
    base = of * (int(ends.max()) + 1)  # brings each group beyond the one before
    reach = np.maximum.accumulate(ends + base)
    begins = np.flatnonzero(np.append(True, starts[1:] + base[1:] >= reach[:-1]))
    return starts[begins], (reach - base)[np.append(begins[1:], len(starts)) - 1], of[begins]


def _collect_block(items: DataFrame) -> tuple[list, np.ndarray, np.ndarray]:
    """Ids, words and first words of a bounded block of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                hashes, first = words_of(part.column("_text"))
                blobs = [hashes[a:b].tobytes() for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays([part.column("_item"), pa.array(blobs, pa.binary())], names=["_item", "words"])

    kind = items.schema["_item"].dataType.simpleString()
    rows = items.mapInArrow(releasing(run), f"_item {kind}, words binary").collect()
    words = [np.frombuffer(r[1], np.uint64) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)]) if rows else np.zeros(1, np.int64)
    return [r[0] for r in rows], np.concatenate(words) if rows else np.zeros(0, np.uint64), first


def find_passages(index: DataFrame, items: DataFrame, width: int = 10, slop: int = 0, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per indexed document: ``doc_key``, ``n_words``, ``n_hit``, ``items`` and ``matches``.

    ``matches`` has a struct (item, first word, end) per run of overlapping occurrences of
    an item's windows, so a text that repeats itself has few; ``n_hit`` counts the words inside any of them.
    """
    spark = index.sparkSession
    source = items.select(F.col(item).alias("_item"), F.col(text).alias("_text"))
    size = source.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    key_type = index.schema["doc_keys"].dataType.elementType
    item_type = source.schema["_item"].dataType
    match = T.StructType([T.StructField("item", item_type), T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([T.StructField("doc_key", key_type), T.StructField("n_words", T.LongType()), T.StructField("matches", T.ArrayType(match))])
    if blocks > 1:  # rows are put together by their place in the index
        index = index.withColumn("_shard", F.expr("uuid()")) if "_shard" not in index.columns else index
        named = fresh_path(spark, "postings-named")
        index.write.parquet(named)
        index = spark.read.parquet(named)

    def search(block: DataFrame) -> DataFrame:
        names, hashes, first = _collect_block(block)
        held = spark.sparkContext.broadcast((names, hashes, first))
        out = T.StructType([T.StructField("_place", T.StringType()), *schema.fields])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, hashes, first = held.value
            names = pa.array(names, arrow_item)
            windows = test_windows(hashes, first, width)
            for batch in batches:
                for row in range(batch.num_rows):
                    one = batch.slice(row, 1)
                    shard = Shard(*(one.column(c)[0].as_py() for c in ("first_words", "terms", "begins", "positions")))
                    starts, ends, of = [], [], []
                    for n, (table, item_of, at) in windows.items():
                        terms, counts = shard.look_up(table)
                        for k in np.flatnonzero(counts.min(axis=1) > 0):
                            a, b = (shard.phrase(terms[k], counts[k]), None) if not slop else shard.near(terms[k], counts[k], slop)
                            a, b = shard.within_documents(a, a + n if b is None else b)
                            a, b, _ = runs_of(a, b, np.zeros(len(a), np.int64))
                            named = item_of[at[k] : at[k + 1]] if len(a) else item_of[:0]
                            starts.append(np.tile(a, len(named)))
                            ends.append(np.tile(b, len(named)))
                            of.append(np.repeat(named, len(a)))
                    yield _rows(one, shard, starts, ends, of, names)

        def _rows(one, shard, starts, ends, of, names) -> pa.RecordBatch:
            keys = one.column("doc_keys").flatten()
            begin = shard.first[:-1].astype(np.int64)
            none = np.zeros(0, np.int64)
            s, e, i = runs_of(*(np.concatenate([none, *x]) for x in (starts, ends, of)))
            order = np.lexsort((i, e, s))
            s, e, i = s[order], e[order], i[order]
            doc = np.searchsorted(shard.first, s, "right") - 1
            spans = [names.take(pa.array(i)), pa.array((s - begin[doc]).astype(np.int32)), pa.array((e - begin[doc]).astype(np.int32))]
            at = np.searchsorted(doc, np.arange(len(keys) + 1))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(spans, ["item", "first", "end"]))
            place = one.column("_shard")[0].as_py() if blocks > 1 else ""
            places = pa.array([f"{place}/{k}" if blocks > 1 else None for k in range(len(keys))], pa.string())
            return pa.RecordBatch.from_arrays([places, keys, pa.array(np.diff(shard.first).astype(np.int64)), lists], names=["_place", "doc_key", "n_words", "matches"])

        from pyspark.sql.pandas.types import to_arrow_type

        arrow_item = to_arrow_type(item_type)
        return index.mapInArrow(releasing(run), out)

    parts = [search(source.filter(F.pmod(F.xxhash64("_item", "_text"), F.lit(blocks)) == b) if blocks > 1 else source) for b in range(blocks)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    if blocks > 1:
        found = found.groupBy("_place").agg(F.first("doc_key").alias("doc_key"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("matches")).alias("matches"))
    return _covered(found.drop("_place"))


def _covered(found: DataFrame) -> DataFrame:
    """Count the words inside any match and list the items, with column functions.

    Matches sorted by their first word are folded: each adds what lies beyond
    the furthest end so far.
    """
    spans = F.expr("array_sort(transform(matches, m -> struct(m.first AS a, m.end AS b)))")
    hit = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reached")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["reached"]))).alias("n"),
            F.greatest(s["b"], acc["reached"]).alias("reached"),
        ),
    )
    return found.select(
        "doc_key",
        "n_words",
        hit["n"].cast("long").alias("n_hit"),
        F.expr("array_distinct(transform(matches, m -> m.item))").alias("items"),
        "matches",
    )
