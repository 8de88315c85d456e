"""Packing of token ids of whole documents into training sequences, by the sum of squares.

A task encodes its documents and packs them one after the other.  Full
sequences are cut off the front of a document; what is left goes to the level
(the number of ids in an open window) where the sum of the squared numbers of
open windows of all levels becomes smallest; level 0 opens a window.  The
array of levels is all the state there is to a decision.

Whenever ``OPEN`` windows are open, and at the end of a task, the emptiest are
cut into pieces that fill the fullest.  Of the one window left at the end,
each power of two in its size becomes a sequence of its own, which needs no
padding.  Nothing is shuffled, and memory depends on neither the number of
documents nor their sizes, but for the ids of one document.

A document's ids end with ``end``; null is the empty text.  Rows are
independent: repeated rows and rows without a key are packed each, an empty
table gives no piece, other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import slices
from .bpe import token_bytes

SLICE = 1 << 20  # bytes of text encoded at once
LONG = 1 << 16  # characters from which a run without a space is encoded by the library that defines the ids
OPEN = 2048  # windows
TASK_SHIFT = 40  # bits of a sequence's number within its task

#: A document's place in the output, where its piece begins, the ids of the piece.
Piece = tuple[int, int, np.ndarray]

NO_SPACE = re.compile(r"\S{%d}|\s{%d}" % (LONG, LONG))


class ByteCoder:
    """Ids of texts by a byte-level vocabulary.

    The merges of such a vocabulary are numbered in their order, so the faster
    encoder by ranks gives the same ids; that order is checked here.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        table, special = token_bytes(path)
        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        known = Tokenizer.from_file(path)
        numbers = [known.token_to_id(a + b) for a, b in pairs]
        if any(x is None for x in numbers) or any(a >= b for a, b in zip(numbers, numbers[1:])):
            raise ValueError("the merges are not numbered in their order")
        known.no_truncation()
        known.no_padding()
        self.known = known
        ranks = {token: number for number, token in enumerate(table) if token and token not in special}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={k.decode(): v for k, v in special.items()})

    def encode(self, text: str) -> np.ndarray:
        if len(text) >= LONG and NO_SPACE.search(text):
            return np.array(self.known.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


@lru_cache(maxsize=2)
def byte_coder(path: str, pattern: str) -> ByteCoder:
    """The same for all tasks of a worker process."""
    return ByteCoder(path, pattern)


class Packer:
    """Places pieces into windows; ``closed`` holds finished sequences until they are taken."""

    def __init__(self, size: int, most_open: int = OPEN):
        self.size, self.most_open = size, most_open
        self.level = np.zeros(size + 1, np.int64)
        self.windows: list[deque[list[Piece]]] = [deque() for _ in range(size + 1)]
        self.closed: list[list[Piece]] = []
        self.open = 0

    def add(self, doc: int, ids: np.ndarray) -> None:
        full = len(ids) - len(ids) % self.size
        for at in range(0, full, self.size):
            self.closed.append([(doc, at, ids[at : at + self.size])])
        if full < len(ids):
            self.place((doc, full, ids[full:].copy()))

    def place(self, piece: Piece) -> None:
        need = len(piece[2])
        before, after = self.level[: self.size - need + 1], self.level[need:]
        change = 2 * after + 1
        change[-1] = 0  # a full window is closed
        change[1:] += 1 - 2 * before[1:]
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max
        # Of equal ones, the fullest.
        self._put(len(change) - 1 - int(np.argmin(change[::-1])), piece)
        if self.open >= self.most_open:
            self.settle()

    def _put(self, fill: int, piece: Piece) -> None:
        if fill:
            window = self.windows[fill].popleft()
            self.level[fill] -= 1
            self.open -= 1
        else:
            window = []
        window.append(piece)
        self._keep(window, fill + len(piece[2]))

    def _keep(self, window: list[Piece], fill: int) -> None:
        if fill == self.size:
            self.closed.append(window)
        elif fill:
            self.windows[fill].append(window)
            self.level[fill] += 1
            self.open += 1

    def settle(self) -> None:
        """Fill the fullest windows with the content of the emptiest, until one is open at most."""
        left = deque((fill, w) for fill in range(1, self.size) for w in self.windows[fill])
        for waiting in self.windows:
            waiting.clear()
        self.level[:] = 0
        self.open = 0
        while len(left) > 1:
            fill, window = left.pop()
            while fill < self.size and left:
                small, source = left.popleft()
                doc, start, ids = source.pop()
                taken = ids[: self.size - fill]
                window.append((doc, start, taken))
                fill += len(taken)
                if len(taken) < len(ids):
                    source.append((doc, start + len(taken), ids[len(taken) :]))
                if small > len(taken):
                    left.appendleft((small - len(taken), source))
            left.append((fill, window)) if fill < self.size else self.closed.append(window)
        for fill, window in left:
            self._keep(window, fill)

    def finish(self) -> None:
        """Close everything without padding."""
        self.settle()
        for waiting in self.windows:
            while waiting:
                pieces = deque(waiting.popleft())
                rest = sum(len(p[2]) for p in pieces)
                while rest:
                    room = 1 << (rest.bit_length() - 1)
                    rest -= room
                    window = []
                    while room:
                        doc, start, ids = pieces.popleft()
                        window.append((doc, start, ids[:room]))
                        if len(ids) > room:
                            pieces.appendleft((doc, start + room, ids[room:]))
                        room -= len(window[-1][2])
                    self.closed.append(window)
        self.level[:] = 0
        self.open = 0

    def take(self) -> list[list[Piece]]:
        taken, self.closed = self.closed, []
        return taken


PIECES = "doc_key {key}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    docs: DataFrame, path: str, length: int = 1024, end: int = 0, key: str = "doc_id", text: str = "text", pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """A row per piece: ``ids`` (little-endian, 32 bits each) from ``start`` of its document, at ``offset`` of its sequence.

    Numbers of sequences are unique and rise within a task, and a task that
    runs again gives the same ones.
    """
    source = docs.select(F.col(key).alias("doc_key"), F.col(text).alias("_text"))
    schema = PIECES.format(key=dict(source.dtypes)["doc_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = byte_coder(path, pattern), Packer(length)
        documents: dict[int, list] = {}  # key, number of ids, ids not yet in a closed sequence
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << TASK_SHIFT
        count, kind = 0, pa.null()

        def ready() -> Iterator[pa.RecordBatch]:
            nonlocal number
            sequences = packer.take()
            for k in range(0, len(sequences), 512):
                rows = []
                for sequence in sequences[k : k + 512]:
                    offset = 0
                    for doc, start, ids in sequence:
                        known = documents[doc]
                        rows.append((known[0], start, len(ids), ids.tobytes(), known[1], number, offset))
                        offset += len(ids)
                        known[2] -= len(ids)
                        if not known[2]:
                            del documents[doc]
                    number += 1
                kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            kind = batch.column("doc_key").type
            for part in slices(batch, "_text", SLICE):
                for name, whole in zip(part.column("doc_key").to_pylist(), part.column("_text").to_pylist()):
                    ids = np.append(coder.encode(whole or ""), np.uint32(end)).astype("<u4", copy=False)
                    documents[count] = [name, len(ids), len(ids)]
                    packer.add(count, ids)
                    count += 1
                yield from ready()
        packer.finish()
        yield from ready()

    return source.mapInArrow(run, schema)
