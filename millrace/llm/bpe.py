"""Byte-pair encoding of whole texts by forced boundaries, and decoding.

Two neighbouring bytes that no token of the vocabulary holds side by side can
never be merged, so a cut between them is certain.  A text is cut at all such
places, and the fragments are encoded on their own; their ids, one after the
other, are the ids of the text.  Fragments repeat a lot and are encoded once a
task (the memory of fragments is bounded).

The word pattern that the encoder applies before merging must find the same
pieces on both sides of a cut.  It looks ahead only from white space, and it
has contractions that begin with an apostrophe; so no cut follows white space
or precedes an apostrophe, and none falls inside a character or a special
token.

Null is encoded as the empty text: no ids, decoded as "".  Rows are
independent: repeated rows give repeated results, an empty table an empty one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrays import append_columns, byte_view
from .pieces import piece_ids

SLICE = 1 << 20  # bytes of text encoded at once
NO_IDS = np.zeros(0, np.int32)
#: Last bytes of white space beyond ASCII in UTF-8, and the bytes before them.
WIDE_SPACE_ENDS = np.zeros(256, bool)
WIDE_SPACE_ENDS[[0x85, 0xA0, 0xA8, 0xA9, 0xAF, 0x9F, *range(0x80, 0x8B)]] = True
WIDE_SPACE_MIDDLES = np.zeros(256, bool)
WIDE_SPACE_MIDDLES[[0xC2, 0x9A, 0x80, 0x81]] = True


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def token_bytes(path: str) -> tuple[list[bytes], dict[bytes, int]]:
    """The bytes of every id, and the special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
    table = [b""] * (max([*spec["model"]["vocab"].values(), *special.values()]) + 1)
    for token, number in spec["model"]["vocab"].items():
        table[number] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    for token, number in special.items():
        table[number] = token
    return table, special


def certain_cuts(table: list[bytes]) -> np.ndarray:
    """For each pair of bytes (256 * left + right): is a cut between them certain?"""
    never = np.ones(1 << 16, bool)
    for token in table:
        for left, right in zip(token, token[1:]):
            never[left << 8 | right] = False
    never = never.reshape(256, 256)
    never[[*range(0x09, 0x0E), *range(0x1C, 0x21)], :] = False  # after white space
    never[:, ord("'")] = False
    never[:, 0x80:0xC0] = False  # inside a character
    return never.reshape(-1)


class FragmentCoder:
    """Encodes texts through their fragments, with one vocabulary."""

    def __init__(self, path: str):
        self.pieces = piece_ids(path)
        self.table, special = token_bytes(path)
        self.cuts = certain_cuts(self.table)
        self.special = re.compile(b"|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def boundaries(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where fragments begin, and the end."""
        found = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            at = np.flatnonzero(self.cuts[(data[:-1].astype(np.uint16) << 8) | data[1:]]) + 1
            before = data[np.maximum(at - 2, 0)]
            found[at] = ~(WIDE_SPACE_ENDS[data[at - 1]] & WIDE_SPACE_MIDDLES[before])
        raw = data.tobytes()
        if self.special:
            for m in self.special.finditer(raw):
                if np.searchsorted(offsets, m.start(), "right") == np.searchsorted(offsets, m.end() - 1, "right"):
                    found[m.start() + 1 : m.end()] = False
                    found[[m.start(), m.end()]] = True
        found[offsets] = True
        return np.flatnonzero(found)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text begins."""
        data, offsets = byte_view(column)
        if len(data) == 0:
            return NO_IDS, np.zeros(len(offsets), np.int64)
        cuts = self.boundaries(data, offsets)
        raw, at = data.tobytes(), cuts.tolist()
        number = self.pieces.numbers([raw[a:b] for a, b in zip(at, at[1:])])
        ids, ends = self.pieces.gather(number)
        return ids, ends[np.searchsorted(cuts, offsets)]


def decode_ids(table: list[bytes], ids: np.ndarray) -> str:
    """Ids to bytes to text; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")


def bpe_encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """The kept columns of every row, and its token ids ``ids`` (array of int).

    With ``decoded`` the ids are decoded again in the same task, to a column
    of that name.
    """
    own = T.StructType().add("ids", T.ArrayType(T.IntegerType()))
    own = own.add("decoded", T.StringType()) if decoded else own

    def make():
        coder = FragmentCoder(path)

        def run(column: pa.Array) -> list[pa.Array]:
            ids, at = coder.encode(column)
            out = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))]
            if decoded:
                out.append(pa.array([decode_ids(coder.table, ids[a:b]) for a, b in zip(at, at[1:])], pa.string()))
            return out

        return run

    return append_columns(docs, text, make, own, keep, SLICE)


def bpe_decode(coded: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default), and ``decoded``: the text of ``ids``, "" for null."""
    kept = [c for c in (coded.columns if keep is None else keep) if c.lower() != "decoded"]
    source = coded.select(*[f"`{c}`" for c in kept], coded["ids"].alias("_ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)[0]
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                lists = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else NO_IDS for x in part.column("_ids")]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([decode_ids(table, x) for x in lists], pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)
