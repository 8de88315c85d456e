"""Ids of text pieces that repeat a lot, each encoded once a task."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import batched

import numpy as np

from .arrays import word_hashes

PIECES_KEPT = 1 << 17


def open_tokenizer(path: str):
    """A tokenizer without limits.  It stays on one thread: there is a task for every core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class PieceIds:
    """Ids of pieces by a tokenizer.  At most ``kept`` pieces stay known between two batches."""

    def __init__(self, path: str, kept: int = PIECES_KEPT):
        self.tokenizer = open_tokenizer(path)
        self.kept = kept
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)
        self.begins = np.zeros(0, np.int64)

    def encoded(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece."""
        out: list[list[int]] = []
        for k in range(0, len(pieces), 2048):
            part = [p.decode() for p in pieces[k : k + 2048]]
            out += [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return out

    def numbers(self, pieces: list[bytes]) -> np.ndarray:
        """The number of each piece, for ``gather``; valid until the next call."""
        if len(self.known) > self.kept:
            self._forget()
        known = self.known
        missing = list({p for p in pieces if p not in known})
        fresh, sizes = [], []
        for piece, ids in zip(missing, self.encoded(missing)):
            known[piece] = len(known)
            fresh += ids
            sizes.append(len(ids))
        if missing:
            self.flat = np.concatenate([self.flat, np.array(fresh, np.uint32)])
            self.sizes = np.concatenate([self.sizes, np.array(sizes, np.int64)])
            self.begins = np.cumsum(self.sizes) - self.sizes
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def gather(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the numbered pieces one after the other, and where each piece begins, with the end."""
        sizes = self.sizes[number]
        ends = np.zeros(len(number) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        return self.flat[np.repeat(self.begins[number] - ends[:-1], sizes) + np.arange(ends[-1])], ends


class WordIds:
    """Ids of words, for tokenizers that mark the last token of a word with an ending.

    The words of a slice are found in a table of learnt ones by hash and then
    compared byte by byte; a word whose hash belongs to another one is encoded
    on its own.  Plain words, letters with or without marks after them, are
    encoded many at once; the endings tell where each of them ends.
    """

    TOGETHER = 512

    def __init__(self, path: str, kept: int = PIECES_KEPT, ending: str = "</w>"):
        self.tokenizer = open_tokenizer(path)
        self.kept = kept
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[n for token, n in vocabulary.items() if token.endswith(ending)]] = True
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # ascending
        self.number = np.zeros(0, np.int64)  # which word has that hash
        self.bytes = np.zeros(0, np.uint8)  # of all words, in the order in which they were learnt
        self.byte_at = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.id_at = np.zeros(1, np.int64)

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words one after the other, and where each word begins, with the end."""
        if len(self.hashes) > self.kept:
            self._forget()
        distinct, first, inverse = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        new = np.append(self.hashes, np.uint64(0))[place] != distinct
        new |= place == len(self.hashes)
        if new.any():
            begin, size = starts[first[new]], (ends - starts)[first[new]]
            self._learn(distinct[new], place[new], data[spans(begin, size)], edges_of(size))
            place = np.searchsorted(self.hashes, distinct)
        number = self.number[place][inverse]
        sizes = np.diff(self.id_at)[number]
        other = self._other_bytes(number, data, starts, ends)
        if not len(other):
            return self.flat[spans(self.id_at[number], sizes)], edges_of(sizes)
        own, own_sizes = self.encoded(data, starts[other], ends[other])
        begins = self.id_at[number]
        begins[other] = len(self.flat) + edges_of(own_sizes)[:-1]
        sizes[other] = own_sizes
        return np.concatenate([self.flat, own])[spans(begins, sizes)], edges_of(sizes)

    def _learn(self, hashes: np.ndarray, place: np.ndarray, data: np.ndarray, edges: np.ndarray) -> None:
        ids, sizes = self.encoded(data, edges[:-1], edges[1:])
        self.hashes = np.insert(self.hashes, place, hashes)
        self.number = np.insert(self.number, place, np.arange(len(hashes)) + len(self.byte_at) - 1)
        self.bytes = np.concatenate([self.bytes, data])
        self.byte_at = np.concatenate([self.byte_at, self.byte_at[-1] + edges[1:]])
        self.flat = np.concatenate([self.flat, ids])
        self.id_at = np.concatenate([self.id_at, self.id_at[-1] + edges_of(sizes)[1:]])

    def _other_bytes(self, number: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words that are not the learnt ones of these numbers."""
        sizes = ends - starts
        other = sizes != np.diff(self.byte_at)[number]
        alike = np.flatnonzero(~other)
        size = sizes[alike]
        wrong = np.flatnonzero(data[spans(starts[alike], size)] != self.bytes[spans(self.byte_at[number[alike]], size)])
        other[alike[np.searchsorted(np.cumsum(size), wrong, "right")]] = True
        return np.flatnonzero(other)

    def encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and how many each has."""
        plain, marked = plain_words(data, starts, ends)
        begins, sizes = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        found, total, left = [], 0, [np.flatnonzero(~plain)]
        chosen = np.flatnonzero(plain)
        groups = [chosen[k : k + self.TOGETHER] for k in range(0, len(chosen), self.TOGETHER)]
        for group, made in zip(groups, self._batch(joined(data, starts[g], ends[g]) for g in groups)):
            ids = np.array(made, np.uint32)
            last = np.flatnonzero(self.closing[ids]) + 1
            words = np.cumsum(1 + marked[group])
            if len(last) != words[-1] or last[-1] != len(ids):
                left.append(group)  # for the plainer way
                continue
            stops = last[words - 1]
            sizes[group] = np.diff(stops, prepend=0)
            begins[group] = total + stops - sizes[group]
            found.append(ids)
            total += len(ids)
        rest = np.concatenate(left)
        for k, ids in zip(rest, self._batch(data[a:b].tobytes().decode() for a, b in zip(starts[rest], ends[rest]))):
            sizes[k], begins[k] = len(ids), total
            found.append(np.array(ids, np.uint32))
            total += len(ids)
        flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
        return flat[spans(begins, sizes)], sizes

    def _batch(self, texts: Iterable[str]) -> Iterator[list[int]]:
        for part in batched(texts, 1024):
            for made in self.tokenizer.encode_batch_fast(list(part), add_special_tokens=False):
                yield made.ids


def edges_of(sizes: np.ndarray) -> np.ndarray:
    """Where stretches of these sizes begin, one after the other, with the end."""
    edges = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=edges[1:])
    return edges


def spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all spans, one span after the other."""
    edges = edges_of(sizes)
    return np.repeat(begins - edges[:-1], sizes) + np.arange(edges[-1])


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """Words with a space after each."""
    sizes = ends - starts + 1
    out = np.full(int(sizes.sum()), ord(" "), np.uint8)
    gaps = np.ones(len(out), bool)
    gaps[np.cumsum(sizes) - 1] = False
    out[gaps] = data[spans(starts, ends - starts)]
    return out.tobytes().decode()


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True


def plain_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are Latin letters (U+0041 to U+024F, whose lower case is one letter) and then marks, and which of them have marks.

    To the tokenizer, letters are one word and the marks after them another.
    """
    pair = np.zeros(len(data), bool)  # first byte of a letter of two
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC9))
    point = ((data[lead].astype(np.int64) & 0x1F) << 6) | (data[lead + 1] & 0x3F)
    pair[lead] = (point < 0x250) & ~np.isin(point, [0xD7, 0xF7, 0x130])
    letter = _ASCII_LETTER[data] | pair
    letter[1:] |= pair[:-1]
    letters, marks = edges_of(letter), edges_of(_MARK[data])
    n_letters, n_marks = letters[ends] - letters[starts], marks[ends] - marks[starts]
    front = letters[starts + n_letters] - letters[starts] == n_letters
    return front & (n_letters > 0) & (n_letters + n_marks == ends - starts), n_marks > 0


@lru_cache(maxsize=4)
def piece_ids(path: str, kept: int = PIECES_KEPT, kind: type[PieceIds] | type[WordIds] = PieceIds) -> PieceIds | WordIds:
    """The same for all tasks of a worker process, which keeps what it has learnt."""
    return kind(path, kept)
