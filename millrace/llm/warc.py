"""Web archives: written, normalised to one gzip member per record, and read back.

Pages become WARC records.  Of pages with the same payload of at least
``least`` bytes the one with the smallest id is a response; the others revisit
it and carry no payload.  Each task writes its records as one gzip stream, the
way many tools do; such a file cannot be read from the middle.

The normaliser inflates such a stream once, from front to back, and writes
every record as a gzip member of its own, together with a sidecar, one line per
record: offset and length of its member.  A reader takes offsets from the
sidecar and inflates single records.

Null html is an empty payload.  Rows with the same id and payload are all
responses if theirs is the smallest id; a null id is larger than any other.
Tasks write to names no other attempt uses, and the next step reads only the
files that finished tasks have named in a written list.  An empty table gives
no archive and no row.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path
from .arrays import slices
from .shared_files import attempt_name, file_system

LEAST = 100
MOST_FREQUENT = 1000  # payloads looked up by broadcast, at most
CHUNK = 1 << 20
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31


def record(kind: str, page: str, url: str, digest: str, size: int, refers: str | None, payload: bytes, date: str) -> bytes:
    """One record; a revisit has the response's headers, with the size of its payload, and no body."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block += payload if kind == "response" else b""
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{page}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers}>")]
    head.append(("Content-Length", str(len(block))))
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Header lines, by lower-case name."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def inflated(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """The plain bytes of a gzip file of one or more members, in pieces."""
    unpack = zlib.decompressobj(GZIP)
    begun = False
    while chunk := read(CHUNK):
        while chunk:
            begun = True
            yield unpack.decompress(chunk)
            chunk = b""
            if unpack.eof:
                chunk, unpack, begun = unpack.unused_data, zlib.decompressobj(GZIP), False
    if begun:
        raise ValueError("the stream ends within a member")


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records out of a stream."""
    held = bytearray()
    need = 0  # bytes of the record at the front, 0 if its header is not complete
    for piece in pieces:
        held += piece
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(fields(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("the stream ends within a record")


def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Pages with payload, digest, size and the response that a revisit refers to.

    Only payloads that occur again are looked up.  Those with a thousandth of
    all rows or more, so at most a thousand of them, are broadcast; the rows of
    the others meet by digest.  All remaining rows, short payloads included,
    are spread evenly.
    """
    rows = pages.select(F.col(key).alias("_key"), F.coalesce(F.col(url), F.lit("")).alias("_url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("_payload"))
    rows = rows.withColumns({"digest": F.sha2("_payload", 256), "size": F.octet_length("_payload").cast("long")})
    copies = rows.where(F.col("size") >= least).groupBy("digest").agg(F.min("_key").alias("_first"), F.count("*").alias("_copies")).where("_copies > 1")
    frequent = F.col("_copies") * MOST_FREQUENT >= pages.count()
    hot = copies.where(frequent).select("digest", F.col("_first").alias("_hot"))
    rare = copies.where(~frequent).select(F.col("digest").alias("_place"), F.col("_first").alias("_rare"))

    def revisits(first: str) -> Column:
        return F.col(first).isNotNull() & ~F.col("_key").eqNullSafe(F.col(first))

    rows = rows.join(F.broadcast(hot), "digest", "left")
    rows = rows.withColumn("_payload", F.when(revisits("_hot"), F.lit(b"")).otherwise(F.col("_payload")))
    spread = F.concat(F.lit("-"), F.xxhash64("_key", "_url", F.spark_partition_id()).cast("string"))
    place = F.when(F.col("_hot").isNull() & (F.col("size") >= least), F.col("digest")).otherwise(spread)
    rows = rows.withColumn("_place", place).join(rare, "_place", "left").withColumn("_first", F.coalesce("_hot", "_rare"))
    return rows.select("_key", "_url", "_payload", "digest", "size", F.when(revisits("_first"), F.col("_first").cast("string")).alias("refers"))


def write_streams(rows: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the records of each task as one gzip stream; return the list of files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        name, sink, pack, count = attempt_name("stream", "warc.gz"), None, zlib.compressobj(1, zlib.DEFLATED, GZIP), 0
        for batch in batches:
            for part in slices(batch, "_payload"):
                if sink is None:
                    system.create_dir(root, recursive=True)
                    sink = system.open_output_stream(f"{root}/{name}", compression=None)
                for key, url, payload, digest, size, refers in zip(*(c.to_pylist() for c in part.columns)):
                    kind = "response" if refers is None else "revisit"
                    sink.write(pack.compress(record(kind, "" if key is None else str(key), url, digest, size, refers, payload, date)))
                    count += 1
        if sink is not None:
            sink.write(pack.flush())
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [count]})

    listed = rows.mapInArrow(run, "file string, n_records long")
    listed.write.parquet(f"{folder}/streams")
    return rows.sparkSession.read.parquet(f"{folder}/streams")


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite streams member by member, with sidecars; return the list of archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        for batch in batches:
            for k, name in enumerate(batch.column("file").to_pylist()):
                target = attempt_name(f"archive-{k}", "warc.gz")
                offset, lines = 0, []
                with system.open_input_stream(f"{root}/{name}", compression=None) as source, system.open_output_stream(f"{root}/{target}", compression=None) as sink:
                    for one in records(inflated(source.read)):
                        pack = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                        member = pack.compress(one) + pack.flush()
                        sink.write(member)
                        lines.append(f"{offset} {len(member)}\n")
                        offset += len(member)
                with system.open_output_stream(f"{root}/{target}.idx", compression=None) as sidecar:
                    sidecar.write("".join(lines).encode())
                yield pa.RecordBatch.from_pydict({"file": [target], "n_records": [len(lines)]})

    files.select("file").repartition(max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "file").mapInArrow(run, "file string, n_records long").write.parquet(f"{folder}/archives")
    return files.sparkSession.read.parquet(f"{folder}/archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """A row per record, by way of the sidecars: page, url, kind, refers_to, digest, size and the payload (null for revisits)."""
    schema = "page string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"
    names = [x.split()[0] for x in schema.split(", ")]

    def page(text: str) -> str | None:
        return text.removeprefix("<urn:page:").removesuffix(">") or None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with system.open_input_stream(f"{root}/{name}.idx", compression=None) as f:
                    index = [tuple(map(int, line.split())) for line in f.read().decode().splitlines()]
                with system.open_input_file(f"{root}/{name}") as source:
                    rows = []
                    for offset, length in index:
                        one = zlib.decompress(source.read_at(length, offset), GZIP)
                        head, _, block = one.partition(b"\r\n\r\n")
                        got = fields(head)
                        http, _, body = block[: int(got["content-length"])].partition(b"\r\n\r\n")
                        whole = got["warc-type"] == "response"
                        digest = hashlib.sha256(body).hexdigest() if whole else got["warc-payload-digest"].removeprefix("sha256:")
                        size = len(body) if whole else int(fields(http)["content-length"])
                        refers = page(got["warc-refers-to"]) if "warc-refers-to" in got else None
                        rows.append((page(got["warc-record-id"]), got["warc-target-uri"], got["warc-type"], refers, digest, size, body if whole else None))
                        if len(rows) == 500 or sum(len(r[6] or b"") for r in rows[-1:]) > CHUNK:
                            yield pa.RecordBatch.from_arrays(_columns(rows), names=names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays(_columns(rows), names=names)

    def _columns(rows: list[tuple]) -> list[pa.Array]:
        kinds = [*[pa.string()] * 5, pa.int64(), pa.binary()]
        return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]

    return archives.select("file").mapInArrow(run, schema)


def archive_round_trip(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Write pages as archives, normalise them and read them back."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    streams = write_streams(with_revisits(pages, least=least), folder)
    return read_archives(normalise(streams, folder), folder)
