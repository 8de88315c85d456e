"""Removal of long byte strings that occur more than once, by merged suffix arrays.

**Phrases.**  A gram of 32 bytes is an anchor if its hash is the smallest of
some stretch of grams; the bytes from an anchor to the next one, with that
one's gram, are a phrase.  Anchors depend on nearby bytes alone, and every
string of ``length`` bytes holds a whole phrase that begins at the anchor of
its first stretch.  So a text becomes a short sequence of symbols, the hashes
of its phrases, and a string that occurs twice gives the same symbol twice.

**Burrows-Wheeler merge.**  A shard (some megabytes of texts) sorts the
suffixes of its symbol sequences once: the shard's Burrows-Wheeler order.  It
is dealt out by first symbol.  Where the orders of all shards meet, they are
merged by refining an interleave: it begins as one shard after the other, and
each round distributes the entries of every block stably by their next symbol,
until the depth is reached.  The round in which two neighbours part is their
longest common prefix, and a stretch of common prefixes of at least one phrase
is a repeated interval.  Each round sorts the next symbols of all entries
within their blocks; blocks are phrases, and one common phrase makes a
repeated interval, so the first round finds the intervals.

**Bytes.**  Interval boundaries lie at phrases, the result at bytes.  So the
windows of ``length`` bytes whose first anchor is in a repeated interval are
compared by 64-bit hash, which decides; equal windows have the same symbol and the
same distance to its anchor, and meet by these two.  A window found at two
places of one shard is settled there, and only its first place is sent on, so
a passage in a third of all texts does not fill one task.

Texts are UTF-8 bytes; null is the empty text.  Equal texts are processed once
and count as occurrences of each other.  A text shorter than ``length`` keeps
all its bytes.  Rows are told apart by their text only: repeated rows, null
keys and repeated keys each get their own result row.  Kept bytes may split a
character only if the removed strings do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import _BASE, _BASE_INVERSE, _BYTE_VALUES, byte_view, mix, powers, releasing, releasing_group, slices
from .buckets import bucket_count, packed, split, unpacked

GRAM = 32
DEPTH = 2
PIECE = 16  # distances to the anchor that travel together
SLICE = 2 << 20
POSITION_BITS = 21


STRETCH = 1 << 18  # bytes and starts hashed at once
HASHED_TOGETHER = 256  # a polynomial over more bytes modulo 2^64 has collisions in regular texts


def range_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of the bytes of every range, chained over short pieces; starts ascend."""
    out = np.empty(len(starts), np.uint64)
    sizes = np.broadcast_to(sizes, len(starts))
    first = 0
    while first < len(starts):
        base = int(starts[first])
        stop = min(base + STRETCH, np.iinfo(starts.dtype).max)
        last = max(first + 1, int(np.searchsorted(starts, starts.dtype.type(stop))))
        s = starts[first:last].astype(np.int64) - base
        e = s + sizes[first:last]
        size = int(e.max())
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[base : base + size]] * powers(_BASE, size)[:size], out=sums[1:])
        back = powers(_BASE_INVERSE, size)
        made = (e - s).astype(np.uint64)
        open_ = slice(None)
        while len(s):
            to = np.minimum(s + HASHED_TOGETHER, e)
            made[open_] = mix(made[open_] * np.uint64(_BASE) + (sums[to] - sums[s]) * back[np.minimum(s, size - 1)])
            more = to < e
            if not more.any():
                break
            if not more.all():
                open_ = np.arange(len(made))[open_][more]
            s, e = to[more], e[more]
        out[first:last] = made
        first = last
    return out


def stretch_anchors(data: np.ndarray, stretch: int) -> np.ndarray:
    """For every position the anchor of the stretch of grams from there; rubbish for the last ones."""
    count = len(data) - GRAM + 1
    out = np.zeros(max(count, 0), np.int32)
    for base in range(0, max(count, 0), STRETCH):
        stop = min(base + STRETCH + stretch - 1, count)
        part = data[base : stop + GRAM - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[part] * powers(_BASE, len(part))[: len(part)], out=sums[1:])
        value = mix((sums[GRAM:] - sums[:-GRAM]) * powers(_BASE_INVERSE, len(part))[: stop - base])
        low = np.uint64((1 << POSITION_BITS) - 1)
        value = (value & ~low) | np.arange(len(value), dtype=np.uint64)
        padded = np.full(-(-len(value) // stretch) * stretch + stretch, ~np.uint64(0))
        padded[: len(value)] = value
        table = padded.reshape(-1, stretch)
        before = np.minimum.accumulate(table, axis=1).reshape(-1)
        after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        n = min(STRETCH, count - base)
        least = np.minimum(after[:n], before[stretch - 1 : stretch - 1 + n])
        out[base : base + n] = (least & low).astype(np.int32) + np.int32(base)
    return out


class Parsed:
    """Anchors and phrases of the texts of a slice.

    What there is for every byte has 32 bits: a slice is no longer than a text can be.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.data, self.offsets, self.length = data, offsets, length
        self.stretch = (length - GRAM + 1) // 2
        self.anchor_of = stretch_anchors(data, self.stretch)
        self.left = np.repeat(offsets[1:].astype(np.int32), np.diff(offsets))[: len(self.anchor_of)]
        self.left -= np.arange(len(self.left), dtype=np.int32)  # bytes up to the end of the text
        anchors = np.unique(self.anchor_of[self.left >= self.stretch - 1 + GRAM]).astype(np.int64)
        of = self.owner(anchors)
        follows = of[1:] == of[:-1]
        self.phrase = anchors[:-1][follows]  # where phrases begin
        self.text = of[:-1][follows]
        self.symbols = range_hashes(data, self.phrase, (anchors[1:] - anchors[:-1])[follows] + GRAM)

    def owner(self, places: np.ndarray) -> np.ndarray:
        """The texts in which bytes lie."""
        return np.searchsorted(self.offsets, places, "right") - 1

    def shard_order(self) -> tuple[np.ndarray, np.ndarray]:
        """The order of the suffixes by their first symbols, and those symbols; 0 ends a text."""
        columns = [self.symbols]
        for d in range(1, DEPTH):
            later = np.zeros_like(self.symbols)
            if len(later) > d:
                later[:-d] = np.where(self.text[d:] == self.text[:-d], self.symbols[d:], 0)
            columns.append(later)
        order = np.lexsort(columns[::-1])
        return order, np.stack([c[order] for c in columns], 1)

    def windows(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows whose first anchor is ``repeated``."""
        flag = np.zeros(len(self.data) + 1, bool)
        flag[repeated] = True
        inside = self.left >= self.length
        for base in range(0, len(inside), STRETCH):  # an index takes 64 bits
            inside[base : base + STRETCH] &= flag[self.anchor_of[base : base + STRETCH]]
        return np.flatnonzero(inside).astype(np.int32)


def interleave(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge runs of sorted suffixes, one after the other in ``symbols`` (a row of next symbols each).

    Returns the merged order and the common prefix (in phrases) of each entry with the one before.
    """
    order = np.arange(len(symbols))
    block = np.zeros(len(symbols), np.int64)
    prefix = np.full(len(symbols), symbols.shape[1])
    prefix[:1] = 0
    for depth in range(symbols.shape[1]):
        step = np.lexsort((symbols[order, depth], block))  # stable within each block
        order, block = order[step], block[step]
        now = symbols[order, depth]
        new = np.zeros(len(order), bool)
        new[1:] = (block[1:] != block[:-1]) | (now[1:] != now[:-1])
        ended = np.zeros(len(order), bool)
        ended[1:] = now[1:] == 0  # the end of a text equals nothing
        parted = (new | ended) & (prefix > depth)
        prefix[parted] = depth
        block = np.cumsum(new)
    return order, prefix


def texts_of(docs: DataFrame, text: str) -> DataFrame:
    """Every distinct text once: its two hashes ``h1``, ``h2``, ``_text`` and the number of ``copies``."""
    whole = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return hashed(whole).groupBy("h1", "h2").agg(F.first("_text").alias("_text"), F.count("*").alias("copies"))


def hashed(df: DataFrame, text: str = "_text") -> DataFrame:
    return df.withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)})


def repeated_phrases(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """h1, h2 and ``found``: positions of phrases in repeated intervals (packed, one row per bucket and text)."""

    def orders(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parsed = Parsed(*byte_view(part.column("_text")), length)
        order, columns = parsed.shard_order()
        first = columns[:, 0]
        # Of suffixes with the same first symbol only two go on to the merge; the others are repeated for sure.
        rank = np.arange(len(first)) - np.searchsorted(first, first)
        sure = rank >= 2
        owner = parsed.text[order]
        h1, h2 = (part.column(c).to_numpy()[owner] for c in ("h1", "h2"))
        at = (parsed.phrase[order] - parsed.offsets[owner]).astype(np.int32)
        for kind, chosen in ((0, ~sure), (1, sure)):
            if not chosen.any():
                continue
            key = first[chosen] if kind == 0 else mix(h1[chosen].astype(np.uint64))
            by, present, begins = split(key, buckets)
            arrays = [columns[chosen][by], h1[chosen][by], h2[chosen][by], at[chosen][by]]
            packs = [packed(arrays[0].reshape(-1), begins * DEPTH), *(packed(x, begins) for x in arrays[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), pa.array([kind] * len(present), pa.int32()), *packs], names=["bucket", "kind", "symbols", "h1", "h2", "at"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                yield from orders(part)

    def meet(table: pa.Table) -> pa.Table:
        kind = np.repeat(table.column("kind").to_numpy(), [len(x.as_py()) // 4 for x in table.column("at")])
        symbols = unpacked(table.column("symbols"), np.uint64).reshape(-1, DEPTH)
        h1, h2, at = (unpacked(table.column(c), t) for c, t in (("h1", np.int64), ("h2", np.int64), ("at", np.int32)))
        merged = np.flatnonzero(kind == 0)
        order, prefix = interleave(symbols[merged])
        inside = prefix >= 1
        inside[:-1] |= prefix[1:] >= 1
        found = np.concatenate([merged[order[inside]], np.flatnonzero(kind == 1)])
        found = found[np.lexsort((at[found], h2[found], h1[found]))]
        h1, h2, at = h1[found], h2[found], at[found]
        begins = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])) if len(at) else np.zeros(0, int)
        return pa.table({"h1": h1[begins], "h2": h2[begins], "found": packed(at, np.append(begins, len(at)))})

    sent = texts.mapInArrow(releasing(send), "bucket int, kind int, symbols binary, h1 binary, h2 binary, at binary")
    return sent.groupBy("bucket").applyInArrow(releasing_group(meet), "h1 long, h2 long, found binary")


def occurrences(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are there more than once, and which are the first of their kind."""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    new = np.ones(len(hashes) + 1, bool)
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:-1])
    again, first = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    again[order] = ~(new[1:] & new[:-1])
    first[order] = new[:-1]
    return again, first


def _runs(starts: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin (as an index) and size of stretches of consecutive starts, also cut where asked."""
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | cut[1:]
    begins = np.flatnonzero(new)
    return begins, np.diff(np.append(begins, len(starts)))


def repeated_windows(marked: DataFrame, length: int, buckets: int) -> DataFrame:
    """h1, h2, ``begin``, ``end``: runs of starts of windows that occur again.  ``marked``: the texts that have ``marks``, and these."""

    def settle(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "kind", "h1", "h2", "start", "count", "hashes"]
        parsed = Parsed(*byte_view(part.column("_text")), length)
        marks = [unpacked(m.values, np.int32) + parsed.offsets[k] for k, m in enumerate(part.column("marks"))]
        starts = parsed.windows(np.concatenate(marks))
        if not len(starts):
            return
        hashes = range_hashes(parsed.data, starts, length)
        sure, is_first = occurrences(hashes)
        h1, h2 = (part.column(c).to_numpy() for c in ("h1", "h2"))
        open_ = ~sure | is_first
        hashes = hashes[open_]
        for kind, chosen in ((0, open_), (1, sure)):
            s = starts[chosen]
            if not len(s):
                continue
            other = np.zeros(len(s), bool)  # starts of two texts are never next to each other
            if kind == 0:
                anchor = parsed.anchor_of[s]
                away = (anchor - s) // PIECE
                other[1:] = (anchor[1:] != anchor[:-1]) | (away[1:] != away[:-1])
            begins, sizes = _runs(s, other)
            of = parsed.owner(s[begins])
            if kind == 0:
                symbol = parsed.symbols[np.searchsorted(parsed.phrase, anchor[begins])]
                key = mix(symbol + away[begins].astype(np.uint64))
                del anchor, away
            else:
                key = mix(h1[of].astype(np.uint64))
            by, present, at = split(key, buckets)
            begins, sizes, of = begins[by], sizes[by], of[by]
            if kind == 0:
                total = np.concatenate([[0], np.cumsum(sizes)])
                dealt = np.empty_like(hashes)
                for base in range(0, len(dealt), STRETCH):
                    place = np.arange(base, min(base + STRETCH, len(dealt)))
                    run = np.searchsorted(total, place, "right") - 1
                    dealt[place] = hashes[begins[run] + place - total[run]]
                sent = packed(dealt, total[at])
                del dealt
            else:
                sent = pa.nulls(len(present), pa.binary())
            head = [pa.array(present, pa.int32()), pa.array([kind] * len(present), pa.int32())]
            body = [h1[of], h2[of], (s[begins] - parsed.offsets[of]).astype(np.int32), sizes.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*head, *(packed(x, at) for x in body), sent], names=names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                yield from settle(part)

    def meet(table: pa.Table) -> pa.Table:
        kind = np.repeat(table.column("kind").to_numpy(), [len(x.as_py()) // 4 for x in table.column("start")])
        h1, h2, start, size = (unpacked(table.column(c), t) for c, t in (("h1", np.int64), ("h2", np.int64), ("start", np.int32), ("count", np.int32)))
        hashes = unpacked(table.column("hashes"), np.uint64)
        open_ = np.flatnonzero(kind == 0)
        again = np.flatnonzero(occurrences(hashes)[0])
        del hashes
        total = np.cumsum(size[open_], dtype=np.int64)
        piece = np.searchsorted(total, again, "right")
        cut = np.zeros(len(piece), bool)
        cut[1:] = piece[1:] != piece[:-1]
        begins, sizes = _runs(again, cut)
        piece, place = open_[piece[begins]], again[begins] - (total - size[open_])[piece[begins]] + start[open_][piece[begins]]
        done = np.flatnonzero(kind == 1)
        of = np.concatenate([piece, done])
        begin = np.concatenate([place, start[done]])
        return pa.table({"h1": h1[of], "h2": h2[of], "begin": begin, "end": begin + np.concatenate([sizes, size[done]])})

    sent = marked.mapInArrow(releasing(send), "bucket int, kind int, h1 binary, h2 binary, start binary, count binary, hashes binary")
    return sent.groupBy("bucket").applyInArrow(releasing_group(meet), "h1 long, h2 long, begin long, end long")


def merged_spans(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Overlapping or touching spans made one."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], begins[1:] > ends[:-1]])
    at = np.flatnonzero(new)
    return np.stack([begins[at], np.append(ends[at[1:] - 1], ends[-1:])], 1)


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of every row (all but the text by default) with ``n_bytes``,
    ``removed`` (spans of bytes: begin, end) and ``kept`` (the remaining bytes)."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} at least")
    buckets = bucket_count(docs, text, 8 << 20)
    texts = texts_of(docs, text)
    marks = repeated_phrases(texts, length, buckets).groupBy("h1", "h2").agg(F.collect_list("found").alias("marks"))
    runs = repeated_windows(texts.join(marks, ["h1", "h2"]), length, buckets)
    found = runs.groupBy("h1", "h2").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))

    own = {"n_bytes", "removed", "kept"}
    kept = [c for c in ([x for x in docs.columns if x != text] if keep is None else keep) if c.lower() not in own]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[f"`{c}`" for c in kept]).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # Rows meet their text where it already lies; a text that goes as a whole need not be there.
    size = F.octet_length("_text").cast("long")
    whole = (F.col("copies") > 1) & (size >= length)
    lean = texts.select("h1", "h2", size.alias("n_bytes"), whole.alias("_whole"), F.when(whole, F.lit("")).otherwise(F.col("_text")).alias("_text"))
    placed = hashed(rows).drop("_text").join(lean, ["h1", "h2"]).join(found, ["h1", "h2"], "left").select("_row", "n_bytes", "_whole", "runs", "_text")
    span = T.StructType().add("begin", T.LongType()).add("end", T.LongType())
    schema = T.StructType([placed.schema["_row"]]).add("n_bytes", T.LongType()).add("removed", T.ArrayType(span)).add("kept", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                data, offsets = byte_view(part.column("_text"))
                spans, kept = [], []
                for k, (gone, total, runs) in enumerate(zip(part.column("_whole").to_pylist(), part.column("n_bytes").to_pylist(), part.column("runs"))):
                    one = data[offsets[k] : offsets[k + 1]]
                    if gone:
                        spans.append([{"begin": 0, "end": total}])
                        kept.append(b"")
                        continue
                    cut = np.zeros((0, 2), np.int64)
                    if runs.is_valid:
                        cut = merged_spans(*(runs.values.field(c).to_numpy() + extra for c, extra in (("begin", 0), ("end", length - 1))))
                    edges = [0, *cut.reshape(-1).tolist(), len(one)]
                    kept.append(b"".join(one[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2])))
                    spans.append([{"begin": a, "end": b} for a, b in cut.tolist()])
                yield pa.RecordBatch.from_arrays([part.column("_row"), part.column("n_bytes"), pa.array(spans, kind), pa.array(kept, pa.binary())], names=schema.names)

    done = placed.mapInArrow(releasing(run), schema)
    return done.select(*[F.col("_row").getField(c).alias(c) for c in kept], "n_bytes", "removed", "kept")
