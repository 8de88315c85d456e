"""Similarity join of texts on the Jaccard index of their word n-grams.

A text is its set of distinct word n-grams (64-bit hashes).  Texts with the
same set are one node; only different sets are compared.

**Prefixes.**  All n-grams are ranked by the number of slices that hold them,
rare ones first.  Two linked sets share one at least of the rarest n-grams of
each, the share of a set that may differ and one more; these are the keys of a
set.  A passage that many texts hold is frequent, so it is a key only of texts
that hold little else.  An n-gram that only one set has is no key.  Sets that
share a key, directly or through others, form a block.  Where sets of one
slice share a key, they are linked under a key of that slice, and only the
smallest goes on under the common one: however frequent an n-gram is, a slice
adds one row to its key.  Ranks need not be exact, only the same everywhere,
so the counting knows an n-gram by 32 bits within its bucket.

**Bands.**  Sizes fall into bands so wide that two linked sets lie in the same
or in neighbouring bands; a tile holds one band and the next.

**Tiles.**  Within a block, sets are compared band by band in tiles, bounded by
sets and by n-grams; a large block becomes many pairs of tiles, whose sets lie
in files that are written once and read by each pair.  Each set has a hashed bitmap
of its n-grams.  The number of bits in which two bitmaps differ is at most the
number of n-grams in which the sets differ, so it bounds the overlap from
above; what is left goes through the exact intersection of the sorted arrays.
Sets already connected within a tile need no comparison, for a component needs
only a spanning forest; so a tile sends on fewer links than it has sets.

Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A text
with fewer words than the width is one n-gram; null and texts without words
have no n-gram and are linked with nothing.  Repeated rows have equal sets and
share a component; a null id never names one unless all its members are null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path
from .arrays import NOT_SPACE, append_columns, byte_view, lowered, mix, releasing, slices, window_hashes, word_bounds, word_hashes
from .buckets import bucket_count, grouped, packed, split, unpacked
from .components import connected_components
from .shared_files import attempt_name, file_system

TILE_SETS = 2048
TILE_GRAMS = 1 << 21  # 16 MB of hashes


def ngram_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of every text in ascending order, and where each text begins."""
    data, offsets = byte_view(column)
    data = lowered(data)
    starts, ends, first = word_bounds(data, offsets, NOT_SPACE)
    words = word_hashes(data, starts, ends)
    grams = window_hashes(words, width)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(grams[a : b - width + 1]))
        else:
            sets.append(window_hashes(words[a:b], b - a) if b > a else grams[:0])
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])
    return (np.concatenate(sets) if sets else grams[:0]), at


def sliced_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``ngram_sets``, a few megabytes of text at a time."""
    found = [ngram_sets(part.column("_text"), width) for part in slices(pa.RecordBatch.from_arrays([column], names=["_text"]), "_text")]
    sizes = np.concatenate([np.zeros(1, np.int64), *(np.diff(at) for _, at in found)])
    return np.concatenate([np.zeros(0, np.uint64), *(grams for grams, _ in found)]), np.cumsum(sizes)


def nodes_of(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for every set, the same for equal sets; 0 for the empty one."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams), out=sums[1:])
    size = np.diff(at).astype(np.uint64)
    return np.where(size > 0, mix(sums[at[1:]] - sums[at[:-1]] + size) >> np.uint64(1), np.uint64(0))


def band_of(size: Column, percent: int) -> Column:
    """The band of a size: the number of factors 100 / percent in it, rounded down.

    Linked sizes differ by one such factor at most, so they are in the same
    or in neighbouring bands, however the logarithm is rounded: a hair is added
    where two sizes may differ by exactly the factor.  For 100 percent a size is a band of its own.
    """
    if percent == 100:
        return (2 * size).cast("long")  # no neighbours
    return F.floor(F.log(size.cast("double")) / F.lit(math.log(100 / percent) * (1 + 1e-9))).cast("long")


def rank_of(count: np.ndarray) -> np.ndarray:
    """A byte that grows with the count; 1 for those counted once only."""
    return np.minimum(8 * np.log2(count) + 1, 255).astype(np.uint8)


def prefix_grams(grams: np.ndarray, at: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams among the first of their set by rank and value, one of which each linked set has as well; the set of each."""
    size = np.diff(at)
    owner = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((grams, rank, owner))
    first = size - (percent * size + 99) // 100 + 1
    taken = np.arange(len(grams)) - at[:-1][owner] < first[owner]
    return order[taken], owner[taken]


def met_within(keys: np.ndarray, nodes: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """The same links with one row for each key, and under a salted key all nodes of a key that has several."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    begins = np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]])
    several = ~begins | np.append(~begins[1:], np.zeros(min(len(keys), 1), bool))
    salted = mix(keys[several] ^ mix(np.array([salt], np.uint64)))
    return np.concatenate([keys[begins], salted]), np.concatenate([nodes[begins], nodes[several]])


def with_nodes(docs: DataFrame, width: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, ``n_shingles`` and ``node`` (null for the empty set)."""

    def make():
        def run(column: pa.Array) -> list[pa.Array]:
            grams, at = ngram_sets(column, width)
            node = nodes_of(grams, at)
            return [pa.array(np.diff(at)), pa.array(node.astype(np.int64), mask=node == 0)]

        return run

    own = T.StructType().add("n_shingles", T.LongType()).add("node", T.LongType())
    return append_columns(docs, text, make, own, keep)


def write_sets(docs: DataFrame, width: int, text: str) -> DataFrame:
    """The different sets, in files of the shared folder, a batch for each few megabytes of text; returns a row per batch.

    Only files that a finished task has named are read.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "sets")
    source = with_nodes(docs.select(F.col(text).alias("_text")), width, "_text", ["_text"]).where("node IS NOT NULL")
    sets = source.groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("_text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        name, out, part = attempt_name("sets", "arrow"), None, 0
        for batch in batches:
            for piece in slices(batch, "_text"):
                if out is None:
                    system.create_dir(root, recursive=True)
                    sink = system.open_output_stream(f"{root}/{name}", compression=None)
                    out = pa.ipc.new_file(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
                out.write_batch(piece)
                yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([part], pa.int32())], names=["file", "part"])
                part += 1
        if out is not None:
            out.close()
            sink.close()

    path = fresh_path(spark, "set-catalogue")
    sets.mapInArrow(releasing(run), "file string, part int").write.parquet(path)
    return spark.read.parquet(path)


def read_part(file: str, part: int) -> pa.RecordBatch:
    system, path = file_system(file)
    with system.open_input_file(path) as source:
        return pa.ipc.open_file(source).get_batch(part)


def spread_parts(catalogue: DataFrame) -> DataFrame:
    return catalogue.repartition(int(catalogue.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "part")


def read_sets(catalogue: DataFrame) -> DataFrame:
    """node, n_shingles and _text of all sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, part in zip(batch.column("file").to_pylist(), batch.column("part").to_pylist()):
                yield read_part(file, part).select(["node", "n_shingles", "_text"])

    return spread_parts(catalogue).mapInArrow(releasing(run), "node long, n_shingles long, _text string")


def gram_ranks(catalogue: DataFrame, width: int, buckets: int) -> DataFrame:
    """``file``, ``part``, ``bucket``, and the ranks of the n-grams of the part that fall into the bucket, in ascending order of the n-grams."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, part in zip(batch.column("file").to_pylist(), batch.column("part").to_pylist()):
                grams = np.unique(ngram_sets(read_part(file, part).column("_text"), width)[0])
                order, present, begins = split(grams, buckets)
                columns = [pa.array([file] * len(present), pa.string()), pa.array([part] * len(present), pa.int32())]
                cells = packed(grams[order].astype(np.uint32), begins)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(present, pa.int32()), cells], names=["file", "part", "bucket", "cells"])

    def count(table: pa.Table) -> pa.Table:
        sizes = pa.compute.binary_length(table.column("cells")).to_numpy() // 4
        cells = unpacked(table.column("cells"), np.uint32)
        _, number, counts = np.unique(cells, return_inverse=True, return_counts=True)
        ranks = packed(rank_of(counts)[number], np.concatenate([[0], np.cumsum(sizes)]))
        return table.select(["file", "part", "bucket"]).append_column("ranks", ranks)

    sent = spread_parts(catalogue).mapInArrow(releasing(send), "file string, part int, bucket int, cells binary")
    return sent.groupBy("bucket").applyInArrow(count, "file string, part int, bucket int, ranks binary")


def shared_keys(catalogue: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """Pairs of nodes that have a key in common: the smallest node of the key with each other one."""
    ranks = gram_ranks(catalogue, width, buckets).withColumn("place", F.concat_ws("/", "file", "part"))
    tasks = int(catalogue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranks = ranks.repartition(tasks, "place").sortWithinPartitions("place", "bucket")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "place"):
            file, part = table.column("file")[0].as_py(), table.column("part")[0].as_py()
            held = read_part(file, part)
            node = held.column("node").to_numpy().astype(np.uint64)
            grams, at = ngram_sets(held.column("_text"), width)
            known, number, holders = np.unique(grams, return_inverse=True, return_counts=True)
            rank = np.empty(len(known), np.uint8)
            rank[split(known, buckets)[0]] = unpacked(table.column("ranks"), np.uint8)
            chosen, owners = prefix_grams(grams, at, rank[number], percent)
            shared = (rank > 1) | (holders > 1)
            kept = shared[number[chosen]]
            # The salt is the same when the task is run again.
            salt = int.from_bytes(hashlib.blake2b(f"{file}/{part}".encode(), digest_size=8).digest())
            keys, nodes = met_within(mix(grams[chosen[kept]]), node[owners[kept]], salt)
            order, present, begins = split(keys, buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(present, pa.int32()), packed(keys[order], begins), packed(nodes[order], begins)],
                names=["bucket", "keys", "nodes"],
            )

    def meet(table: pa.Table) -> pa.Table:
        keys, nodes = unpacked(table.column("keys"), np.uint64), unpacked(table.column("nodes"), np.uint64)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        begins = np.concatenate([[True], keys[1:] != keys[:-1]])
        least = nodes[np.maximum.accumulate(np.where(begins, np.arange(len(keys)), 0))]
        other = nodes != least
        pairs = np.unique(np.stack([least[other], nodes[other]], 1), axis=0).astype(np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    sent = ranks.select("place", "file", "part", "ranks").mapInArrow(releasing(send), "bucket int, keys binary, nodes binary")
    return sent.groupBy("bucket").applyInArrow(meet, "a long, b long")


class Tile:
    """Sets that are compared with each other, or two groups of them across."""

    def __init__(self, nodes: np.ndarray, side: np.ndarray, grams: np.ndarray, at: np.ndarray, percent: int):
        order = np.argsort(np.diff(at), kind="stable")
        self.nodes, self.side, self.percent = nodes[order], side[order], percent
        self.sets = [grams[at[k] : at[k + 1]] for k in order.tolist()]
        self.size = np.diff(at)[order]
        self.last = np.searchsorted(self.size, self.size * 100 // percent, "right")

    def bitmaps(self) -> Iterator[tuple[range, np.ndarray]]:
        """Stretches of sets of similar size, with the bitmaps of them and of the larger sets they may be linked to.

        The width follows the sizes of the stretch, so all bitmaps take a few bits per n-gram.
        """
        widths = 64 << np.ceil(np.log2(np.maximum(self.size, 16) / 16)).astype(np.int64)
        begins = np.unique(widths, return_index=True)[1].tolist()
        for first, stop in zip(begins, [*begins[1:], len(widths)]):
            width = int(widths[first])
            bits = np.zeros((int(self.last[stop - 1]) - first, width // 64), np.uint64)
            for row, values in zip(bits, self.sets[first:]):
                bit = values & np.uint64(width - 1)
                np.bitwise_or.at(row, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
            yield range(first, stop), bits

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """A spanning forest of the links."""
        label = np.arange(len(self.nodes))
        both = bool(self.side.any())
        found_a, found_b = [], []
        for k, base, bits in ((k, stretch[0], bits) for stretch, bits in self.bitmaps() for k in stretch):
            mine = int(self.size[k])
            others = slice(k + 1, int(self.last[k]))
            open_ = label[others] != label[k]
            if both:
                open_ &= self.side[others] != self.side[k]
            near = np.flatnonzero(open_) + k + 1
            if not len(near):
                continue
            total = self.size[near] + mine
            differing = np.bitwise_count(bits[near - base] ^ bits[k - base]).sum(axis=1, dtype=np.int64)
            # overlap <= (total - differing) / 2, and union = total - overlap
            overlap = (total - differing) // 2
            for j in near[100 * overlap >= self.percent * (total - overlap)].tolist():
                if label[j] == label[k]:
                    continue
                common = len(np.intersect1d(self.sets[k], self.sets[j], assume_unique=True))
                if 100 * common >= self.percent * (mine + int(self.size[j]) - common):
                    label[label == label[j]] = label[k]
                    found_a.append(self.nodes[k])
                    found_b.append(self.nodes[j])
        return np.array(found_a, np.int64), np.array(found_b, np.int64)


def compared(
    blocks: DataFrame, sets: DataFrame, width: int, percent: int, tile_sets: int = TILE_SETS, tile_grams: int = TILE_GRAMS
) -> DataFrame:
    """Links between different sets of a block.  ``sets``: node, n_shingles, _text."""
    # Spark takes the sets for as small as their catalogue, so the join is named.
    members = sets.hint("merge").join(blocks, "node").select("node", "n_shingles", "_text", F.col("root").alias("block"))
    members = members.withColumn("band", band_of(F.col("n_shingles"), percent))
    path = fresh_path(sets.sparkSession, "block-members")
    members.write.parquet(path)
    members = sets.sparkSession.read.parquet(path)

    counts = members.groupBy("block", "band").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("grams"))
    whole = counts.groupBy("block").agg(F.sum("n").alias("n_block"), F.sum("grams").alias("grams_block"))
    tiles = counts.join(whole, "block").select(
        "block",
        "band",
        ((F.col("n_block") <= tile_sets) & (F.col("grams_block") <= tile_grams)).alias("small"),
        F.ceil(F.greatest(F.col("n") / (tile_sets // 2), F.col("grams") / (tile_grams // 2))).cast("int").alias("tiles"),
    )
    above = tiles.select("block", (F.col("band") - 1).alias("band"), F.col("tiles").alias("tiles_above"))
    tiles = tiles.join(above, ["block", "band"], "left").na.fill(0, ["tiles_above"])
    placed = members.join(tiles, ["block", "band"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    small = placed.where("small").select(F.col("block").alias("tile"), "node", "_text")
    large = placed.where("NOT small").select(F.concat_ws("/", "block", "band", "own").alias("tile"), "node", "_text", "block", "band", "own", "tiles", "tiles_above")
    within = small.repartition("tile").sortWithinPartitions("tile").mapInArrow(releasing(lambda batches: compare_whole(batches, width, percent)), "a long, b long")
    return within.unionByName(compared_across(large, width, percent))


def compare_whole(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links within each tile, from rows sorted by tile."""
    for table in grouped(batches, "tile"):
        grams, at = sliced_sets(table.column("_text").combine_chunks(), width)
        a, b = Tile(table.column("node").to_numpy(), np.zeros(table.num_rows, np.int64), grams, at, percent).links()
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def compared_across(members: DataFrame, width: int, percent: int) -> DataFrame:
    """Links within the tiles of large blocks and across them.

    Each tile is written once to the shared folder, and each pair of tiles
    reads its two files, so what is shuffled does not grow with their number.
    Only files that a finished task has named are read.
    """
    spark = members.sparkSession
    folder = fresh_path(spark, "tiles")
    about = ["block", "band", "own", "tiles", "tiles_above"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        for table in grouped(batches, "tile"):
            system.create_dir(root, recursive=True)
            name = attempt_name("tile", "arrow")
            with system.open_output_stream(f"{root}/{name}", compression=None) as sink:
                held = table.select(["node", "_text"])
                with pa.ipc.new_stream(sink, held.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(held)
            first = [table.column(c).slice(0, 1).combine_chunks() for c in about]
            yield pa.RecordBatch.from_arrays([*first, pa.array([name])], names=[*about, "file"])

    path = fresh_path(spark, "tile-catalogue")
    schema = T.StructType([*members.select(*about).schema.fields, T.StructField("file", T.StringType())])
    members.repartition("tile").sortWithinPartitions("tile").mapInArrow(releasing(write), schema).write.parquet(path)
    tiles = spark.read.parquet(path)

    # Every tile with the later ones of its band and with all of the next band.
    others = F.expr(
        """concat(transform(sequence(own, tiles - 1), t -> named_struct('band', band, 'own', t)),
                  IF(tiles_above > 0, transform(sequence(0, tiles_above - 1), t -> named_struct('band', band + 1, 'own', t)), array()))"""
    )
    pairs = tiles.select("block", F.col("file").alias("lower"), F.explode(others).alias("o")).select("block", F.col("o.band").alias("band"), F.col("o.own").alias("own"), "lower")
    pairs = pairs.join(tiles.select("block", "band", "own", F.col("file").alias("upper")), ["block", "band", "own"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)

        def read(name: str) -> pa.Table:
            with system.open_input_stream(f"{root}/{name}", compression=None) as source:
                return pa.ipc.open_stream(source).read_all()

        for batch in batches:
            for lower, upper in zip(batch.column("lower").to_pylist(), batch.column("upper").to_pylist()):
                found = [read(name) for name in dict.fromkeys((lower, upper))]
                side = np.repeat(np.arange(len(found)), [len(t) for t in found])
                table = pa.concat_tables(found)
                grams, at = sliced_sets(table.column("_text").combine_chunks(), width)
                a, b = Tile(table.column("node").to_numpy(), side, grams, at, percent).links()
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return pairs.select("lower", "upper").repartition(tasks, "lower", "upper").mapInArrow(releasing(run), "a long, b long")


def ngram_components(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", tile_sets: int = TILE_SETS, tile_grams: int = TILE_GRAMS) -> DataFrame:
    """A row per document: the key, ``n_shingles``, and ``component_id``, the smallest key it is linked to, directly or through others."""
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = with_nodes(source, width, "_text", ["_key"])
    path = fresh_path(docs.sparkSession, "nodes")
    rows.write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)

    catalogue = write_sets(source, width, "_text")
    blocks = connected_components(shared_keys(catalogue, width, percent, bucket_count(source, "_text")))
    roots = connected_components(compared(blocks, read_sets(catalogue), width, percent, tile_sets, tile_grams))

    first = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("_key").alias("_first"))
    named = first.join(roots, "node", "left").select("node", "_first", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("_first").alias("component_id"))
    component = named.join(least, "root").select("node", "component_id")
    return rows.join(component, "node", "left").select(F.col("_key").alias(key), "n_shingles", F.when(F.col("node").isNull(), F.col("_key")).otherwise(F.col("component_id")).alias("component_id"))
