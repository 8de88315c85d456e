"""Token ids in binary files that are read document by document.

A file is a row of independent zstandard frames, each with its checksum, and
ends with a seek table in a skippable frame: the compressed and decompressed
size and the low 32 bits of the XXH64 of each frame.  A reader takes the table
from the end of the file and decompresses only the frames with the documents
it wants.  The catalogue, a Parquet table, has a row per document: file, first
id within the file and number of ids.

Documents are written in ascending order of their key: a range partition of
the table becomes one file, so that the numbers of ids of the files before it,
one row per file, give the place of each document in the whole.

Rows with the same key follow each other ordered by text; a null key comes
first.  Null is the empty text: only the end id is written.  An empty table
gives no file and no row.  A retried task writes to a new name; only files
that a finished task has named in the catalogue are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path
from .arrays import NOT_SPACE, byte_view, releasing, slices, word_bounds
from .pieces import WordIds, piece_ids
from .shared_files import attempt_name, file_system

SLICE = 1 << 20  # bytes of text encoded at once
WORDS_KEPT = 1 << 20
FRAME_IDS = 1 << 16  # ids in a frame, unless one document has more
#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x8F92EAB1, 0x80

CATALOGUE = "doc_key {key}, file string, first long, n_tokens long"


class WordCoder:
    """Ids of texts by way of their words; words between ASCII white space are encoded on their own.

    That is exact for tokenizers that drop white space and treat each word
    alike wherever it stands.
    """

    def __init__(self, path: str):
        self.pieces = piece_ids(path, WORDS_KEPT, WordIds)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, each text followed by ``end``; where each text begins."""
        data, offsets = byte_view(texts)
        starts, ends, first = word_bounds(data, offsets, NOT_SPACE)
        ids, begins = self.pieces.ids(data, starts, ends)
        at = begins[first]
        return np.insert(ids, at[1:], np.uint32(end)), at + np.arange(len(at))


class FrameWriter:
    """Writes frames of ids to an open file and closes it with the seek table."""

    def __init__(self, sink, level: int = 3):
        import zstandard

        self.sink, self.compressor = sink, zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.table: list[tuple[int, int, int]] = []

    def frame(self, ids: np.ndarray) -> None:
        import xxhash

        raw = ids.astype("<u4").tobytes()
        packed = self.compressor.compress(raw)
        self.sink.write(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body) + len(footer)) + body + footer)


class FrameReader:
    """Reads runs of ids from a file; decompresses only the frames that hold them."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table")
        table = np.frombuffer(source.read_at(12 * count, size - 9 - 12 * count), "<u4").reshape(count, 3)
        self.packed = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        self.plain = np.concatenate([[0], np.cumsum(table[:, 1], dtype=np.int64)])
        self.checksums = table[:, 2]
        self.last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        import xxhash
        import zstandard

        if self.last[0] != k:
            raw = zstandard.ZstdDecompressor().decompress(self.source.read_at(int(self.packed[k + 1] - self.packed[k]), int(self.packed[k])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checksums[k]:
                raise ValueError(f"frame {k} is damaged")
            self.last = (k, raw)
        return self.last[1]

    def ids(self, first: int, count: int) -> np.ndarray:
        begin, end = 4 * first, 4 * (first + count)
        parts = []
        k = int(np.searchsorted(self.plain, begin, "right")) - 1
        while begin < end:
            stop = min(end, int(self.plain[k + 1]))
            parts.append(self.frame(k)[begin - int(self.plain[k]) : stop - int(self.plain[k])])
            begin, k = stop, k + 1
        return np.frombuffer(b"".join(parts), "<u4")


def write_token_files(docs: DataFrame, path: str, end: int, folder: str | None = None, key: str = "doc_id", text: str = "text", files: int | None = None) -> DataFrame:
    """Encode every text, write the files, and return the catalogue, which lies in the same folder."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-files")
    source = docs.select(F.col(key).alias("doc_key"), F.col(text).alias("_text"))
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = source.repartitionByRange(files, "doc_key", F.xxhash64("_text")).sortWithinPartitions("doc_key", F.xxhash64("_text"), "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder(path)
        system, root = file_system(folder)
        name, sink, written = attempt_name("ids", "zst"), None, 0
        waiting: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                if sink is None:
                    system.create_dir(root, recursive=True)
                    sink = system.open_output_stream(f"{root}/{name}", compression=None)
                    writer = FrameWriter(sink)
                ids, at = coder.encode(part.column("_text"), end)
                for a, b in zip(at.tolist(), at[1:].tolist()):
                    waiting.append(ids[a:b])
                    held += b - a
                    if held >= FRAME_IDS:
                        writer.frame(np.concatenate(waiting))
                        waiting, held = [], 0
                names = pa.array([name] * part.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_key"), names, pa.array(at[:-1] + written), pa.array(np.diff(at))], names=["doc_key", "file", "first", "n_tokens"])
                written += int(at[-1])
        if sink is not None:
            if waiting:
                writer.frame(np.concatenate(waiting))
            writer.close()
            sink.close()

    catalogue = ranged.mapInArrow(releasing(run), CATALOGUE.format(key=dict(source.dtypes)["doc_key"]))
    catalogue.write.parquet(f"{folder}/catalogue")
    return spark.read.parquet(f"{folder}/catalogue").withColumn("folder", F.lit(folder))


def read_token_files(catalogue: DataFrame, lists: bool = True) -> DataFrame:
    """A row per document of the catalogue with its ids, read from the files through their seek tables.

    ``ids_crc32`` is the checksum of the ids as little-endian 32-bit numbers;
    without ``lists`` it comes alone.
    """
    kept = [f for f in catalogue.schema.fields if f.name not in ("ids", "ids_crc32")]
    schema = T.StructType([*kept, T.StructField("ids_crc32", T.LongType())])
    schema = schema.add("ids", T.ArrayType(T.LongType())) if lists else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, FrameReader | None] = ("", None)
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                found, at = [], [0]
                for folder, file, first, count in zip(*(part.column(c).to_pylist() for c in ("folder", "file", "first", "n_tokens"))):
                    place = f"{folder}/{file}"
                    if opened[0] != place:
                        system, p = file_system(place)
                        opened = (place, FrameReader(system.open_input_file(p)))
                    found.append(opened[1].ids(first, count))
                    at.append(at[-1] + count)
                columns = [*(part.column(f.name) for f in kept), pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64())]
                if lists:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(found).astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return catalogue.select(*[f.name for f in kept]).mapInArrow(run, schema)


def with_starts(catalogue: DataFrame) -> DataFrame:
    """``start``: number of ids of all documents before each one, over all files.

    The names of the files are in the order of their ranges; the running sum
    is over one row per file.
    """
    sizes = catalogue.groupBy("file").agg(F.sum("n_tokens").alias("_size"))
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("file", F.coalesce(F.sum("_size").over(order), F.lit(0)).alias("_before"))
    return catalogue.join(before, "file").withColumn("start", F.col("_before") + F.col("first")).drop("_before")
