"""The trie of the shared beginnings of conversations.

A turn becomes an id of 16 bytes, the first half of the SHA-256 of its role and
text, so the key of a conversation is a row of ids of fixed width in big-endian
order.  Distinct keys are dealt out by ranges; each task puts its range into an
adaptive radix tree (``radix_tree``) and reads the nodes of the trie from it: a
radix node may end in the middle of an id, but only the depths at which a turn
ends become nodes.

Keys are cut into layers of a fixed number of turns, so that a long conversation is
many short rows; the root of a layer's tree is the deepest node of the layer
above.  A node on the path to the first or the last key of a task may go on in
the next range.  Such nodes, and the deepest of a layer, wait: their rows are
merged by id, and what they add to their ancestors is added from the deepest
layer upwards.  All other nodes are complete in their task.

Null ids of conversations take no part; null roles and texts are empty.  Turns
with equal numbers are ordered by their ids, equal rows count each.  An empty
table has no node.  Conversations without turns end at the root.  Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .arrays import byte_view
from .radix_tree import RadixTree

WIDTH = 16  # bytes of the id of a turn
LAYER = 128  # turns of a layer
TREE_BYTES = 8 << 20  # of keys in a task
LIST_BYTES = 1 << 20  # of a list of ids of conversations
WAITING_SALTS = 32
ROOT = bytes(WIDTH)


def node_id(top: bytes, path: bytes) -> bytes:
    """Id of the node that ``path`` leads to from the node ``top``."""
    return hashlib.sha256(top + path).digest()[:WIDTH] if path else top


def _node_id_column(top: Column, path: Column) -> Column:
    below = F.substring(F.unhex(F.sha2(F.concat(top, path), 256)), 1, WIDTH)
    return F.when(F.octet_length(path) == 0, top).otherwise(below)


def _written(frame: DataFrame, label: str) -> DataFrame:
    path = fresh_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _parts(frame: DataFrame, size: Column, limit: int) -> int:
    total = frame.agg(F.sum(size)).first()[0] or 0
    return max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // limit))


def turn_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, the ``id`` of the turn and the code points ``chars`` of its text."""
    said, words = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    whole = F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, words)
    return conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, WIDTH).alias("id"),
        F.char_length(words).alias("chars"),
    )


def with_shared_heads(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Rebuild every conversation c: the first h turns of conversation c - c % group, then its own after its first h.

    h is crc32(c) % most.  The result has the rows of ``turn_rows`` with
    ``kind`` (0: from the other conversation, in its order; 1: its own) and
    ``skip``, the number of own turns to leave out from the front.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "id")
    firsts = turns.where(F.pmod("conv_id", F.lit(group)) == 0).select("*", F.row_number().over(order).alias("n")).where(F.col("n") < most)
    heads = firsts.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("n", "id", "chars"))).alias("head"))
    each = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.pmod("conv_id", F.lit(group))).alias("base"), h.cast("int").alias("skip"))
    taken = each.join(heads, "base").where("skip > 0").select("conv_id", "skip", F.inline(F.slice("head", F.lit(1), F.col("skip"))))
    before = taken.select("conv_id", F.lit(0).alias("kind"), F.col("n").cast("long").alias("turn"), "id", "chars", "skip")
    own = turns.select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "id", "chars", h.cast("int").alias("skip"))
    return before.unionByName(own)


LAYERS = "layer int, top binary, path binary, chars binary, conv_id long, ends boolean"


def layer_rows(turns: DataFrame, span: int = LAYER) -> DataFrame:
    """Each conversation as rows of at most ``span`` turns.

    ``top`` is the node at which the layer begins, ``path`` the ids of its
    turns.  A task streams through the turns of its conversations.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, layer, top, path, chars, own = None, 0, ROOT, bytearray(), bytearray(), 0

        def ready() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out)]
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["layer", "top", "path", "chars", "conv_id", "ends"])

        for batch in batches:
            if not batch.num_rows:
                continue
            convs, kinds, skips = (batch.column(c).to_numpy() for c in ("conv_id", "kind", "skip"))
            ids = byte_view(batch.column("id"))[0].tobytes()
            sizes = batch.column("chars").to_numpy().astype("<i4").tobytes()
            edges = [0, *(np.flatnonzero(convs[1:] != convs[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if convs[a] != conv:
                    if conv is not None:
                        out.append((layer, top, bytes(path), bytes(chars), conv, True))
                    conv, layer, top, path, chars, own = int(convs[a]), 0, ROOT, bytearray(), bytearray(), 0
                middle = a + int(np.searchsorted(kinds[a:b], 1))
                later = min(b, middle + max(0, int(skips[a]) - own))
                own += b - middle
                path += ids[WIDTH * a : WIDTH * middle] + ids[WIDTH * later : WIDTH * b]
                chars += sizes[4 * a : 4 * middle] + sizes[4 * later : 4 * b]
                while len(path) > span * WIDTH:
                    key = bytes(path[: span * WIDTH])
                    out.append((layer, top, key, bytes(chars[: 4 * span]), conv, False))
                    layer, top = layer + 1, node_id(top, key)
                    del path[: span * WIDTH], chars[: 4 * span]
                if len(out) >= 2000:
                    yield ready()
        if conv is not None:
            out.append((layer, top, bytes(path), bytes(chars), conv, True))
        if out:
            yield ready()

    sorted_turns = turns.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "id")
    return sorted_turns.mapInArrow(run, LAYERS)


NODES = (
    "id binary, parent binary, layer int, depth long, conv_id long, parent_conv_id long, n_convs long, chars long, n_children long, "
    "n_leaves long, saved long, leaves_below long, saved_below long, waits boolean, ancestors array<binary>"
)
_NODE_TYPES = [pa.binary(), pa.binary(), pa.int32(), *[pa.int64()] * 10, pa.bool_(), pa.list_(pa.binary())]
_NODE_NAMES = [part.split()[0] for part in NODES.split(", ")]


def _tree_nodes(span: int, layer: int, top: bytes, rows: list[tuple], opens: bool, closes: bool) -> list[list]:
    """Rows of ``NODES`` of one layer's tree; ``rows`` has (path, chars, n, conv_id, goes_on) in the order of the paths.

    ``opens`` and ``closes`` say that the first or the last row is also that
    of the task.
    """
    tree = RadixTree()
    for k, row in enumerate(rows):
        tree.put(row[0], k)
    out: list[list] = []
    # Of each subtree not yet taken up by its parent: rows first and last, members, smallest
    # member, leaves, saved, and the places in ``out`` of its topmost nodes.
    done: list[tuple] = []
    for node, begin, end in tree.upwards():
        parts = [done.pop() for _ in node.items()][::-1]
        if node.value is not None:
            n, conv = rows[node.value][2:4]
            parts.insert(0, (node.value, node.value, n, conv, 0, 0, []))
        lo, hi = parts[0][0], parts[-1][1]
        n, conv = sum(p[2] for p in parts), min(p[3] for p in parts)
        leaves, saved = sum(p[4] for p in parts), sum(p[5] for p in parts)
        tops = [t for p in parts for t in p[6]]
        path, sizes = rows[lo][0], rows[lo][1]
        on_edge = (opens and lo == 0) or (closes and hi == len(rows) - 1)
        for depth in range(end // WIDTH, begin // WIDTH if begin >= 0 else -1, -1):
            me = node_id(top, path[: depth * WIDTH])
            for place in tops:
                out[place][1] = me
            waits = depth == 0 or on_edge or (depth == span and rows[lo][4])
            chars = int.from_bytes(sizes[4 * depth - 4 : 4 * depth], "little") if depth else 0
            if not waits:
                for place in tops:
                    out[place][5] = conv
                leaves += not tops
                saved += (n - 1) * chars
            above = [node_id(top, path[: k * WIDTH]) for k in range(depth)] if waits else None
            row = [me, None, layer, layer * span + depth, conv, None, n, chars, sum(not out[t][13] for t in tops), leaves, saved, 0, 0, waits, above]
            if depth == 0 and layer:  # the same node as the deepest of the layer above
                row[2:13] = [None, None, None, None, 0, None, row[8], 0, 0, leaves, saved]
                row[14] = None
            out.append(row)
            tops = [len(out) - 1]
        done.append((lo, hi, n, conv, leaves, saved, tops))
    return out


def _read_trees(keys: DataFrame, span: int) -> DataFrame:
    """The rows of ``NODES`` of all ranges of keys, those of nodes that wait once per task."""

    def ready(rows: list[list]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(rows), 10_000):
            columns = list(zip(*rows[k : k + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _NODE_TYPES)], names=_NODE_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group, first = None, True
        for batch in batches:
            for layer, top, *row in zip(*(batch.column(c).to_pylist() for c in ("layer", "top", "path", "chars", "n", "conv_id", "goes_on"))):
                if (layer, top) != group:
                    if held:
                        yield from ready(_tree_nodes(span, *group, held, first, False))
                        held, first = [], False
                    group = (layer, top)
                held.append(tuple(row))
        if held:
            yield from ready(_tree_nodes(span, *group, held, first, True))

    parts = _parts(keys, F.octet_length("path") + 64, TREE_BYTES)
    ranged = keys.repartitionByRange(parts, "layer", "top", "path").sortWithinPartitions("layer", "top", "path")
    return ranged.mapInArrow(run, NODES)


def _ends(layers: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, in ascending order, joined by commas.

    Ids are sorted by ranges of (node, id), so a node with very many of them
    is spread over tasks; each task passes on long lists of digits, and only
    the hash runs through them one after the other.
    """
    ended = layers.where("ends").select(_node_id_column(F.col("top"), F.col("path")).alias("id"), "conv_id")
    parts = _parts(ended, F.lit(32), TREE_BYTES)
    ranged = ended.repartitionByRange(parts, "id", "conv_id").sortWithinPartitions("id", "conv_id")
    schema = "id binary, first long, list string, ends_sha256 string"

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        node, held, size, whole = None, [], 0, False

        def close(last: bool) -> None:
            text = ",".join(map(str, held))
            out.append((node, held[0], None, hashlib.sha256(text.encode()).hexdigest()) if whole and not last else (node, held[0], text, None))

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string(), pa.string()))], names=["id", "first", "list", "ends_sha256"])

        for batch in batches:
            for key, conv in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist()):
                if key != node:
                    if held:
                        close(False)
                    whole = node is not None  # the first node of a task may have begun before
                    node, held, size = key, [], 0
                elif size > LIST_BYTES:
                    whole = False
                    close(False)
                    held, size = [], 0
                held.append(conv)
                size += 12
                if len(out) >= 10_000:
                    yield ready()
        if held:
            close(True)
            yield ready()

    found = _written(ranged.mapInArrow(lists, schema), "ends")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        node, state = None, None
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("list").to_pylist()):
                if key != node:
                    if state is not None:
                        out.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if state is not None:
            out.append((node, state.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], names=["id", "ends_sha256"])

    cut = found.where("list is not null").select("id", "first", "list")
    merged = cut.repartition(F.col("id")).sortWithinPartitions("id", "first").mapInArrow(joined, "id binary, ends_sha256 string")
    return found.where("list is null").select("id", "ends_sha256").unionByName(merged)


def _merged(waiting: DataFrame) -> DataFrame:
    """One row per waiting node, with the number of its children and what it adds to its ancestors itself."""
    sums = ["n_convs", "n_children", "n_leaves", "saved", "leaves_below", "saved_below"]
    one = ["parent", "parent_conv_id", "layer", "depth", "chars", "ancestors"]
    nodes = _written(
        waiting.groupBy("id").agg(*[F.max(c).alias(c) for c in one], F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in sums]), "waiting"
    )
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
    known = nodes.join(kids, "id", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids")
    leaf = (F.col("n_children") == 0).cast("long")
    return _written(known.withColumn("own_leaf", leaf).withColumn("own_saved", (F.col("n_convs") - 1) * F.col("chars")), "merged")


def _received(merged: DataFrame) -> DataFrame:
    """What waiting nodes add to their ancestors, layer by layer from the deepest."""
    deepest = merged.agg(F.max("layer")).first()[0]
    levels: list[DataFrame] = []
    for layer in range(deepest, -1, -1):
        here = merged.where(F.col("layer") == layer)
        leaves, saved = F.col("own_leaf") + F.col("leaves_below"), F.col("own_saved") + F.col("saved_below")
        if levels:
            here = here.join(levels[-1], "id", "left")
            leaves, saved = leaves + F.coalesce("more_leaves", F.lit(0)), saved + F.coalesce("more_saved", F.lit(0))
        each = here.select(F.explode("ancestors").alias("id"), leaves.alias("leaves"), saved.alias("saved_now"))
        levels.append(_written(each.groupBy("id").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved_now").alias("more_saved")), "received"))
    return reduce(DataFrame.unionByName, levels)


def prefix_trie(turns: DataFrame, span: int = LAYER) -> DataFrame:
    """The nodes of the trie of conversations given as rows of ``with_shared_heads``.

    Per node: ``id``, ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.  ``span`` is the number of turns of
    a layer.
    """
    layers = _written(layer_rows(turns, span), "layers")
    keys = layers.groupBy("layer", "top", "path").agg(
        F.min("chars").alias("chars"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.max(~F.col("ends")).alias("goes_on")
    )
    found = _written(_read_trees(_written(keys, "keys"), span), "nodes")
    ends = _ends(layers)
    result = ["id", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    if found.isEmpty():
        return found.select(*[c if c != "saved_tokens" else F.col("saved").alias(c) for c in result], F.lit("").alias("ends_sha256"))
    merged = _merged(found.where("waits"))
    received = _received(merged)
    whole = merged.select(
        "id", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + F.col("leaves_below") + F.col("own_leaf")).alias("n_leaves"), (F.col("saved") + F.col("saved_below") + F.col("own_saved")).alias("saved"),
    )
    kids = merged.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
    complete = found.where("not waits").select(*whole.columns).join(kids, "id", "left")
    complete = complete.withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids")
    nodes = complete.unionByName(whole).join(received, "id", "left").withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
            "saved_tokens": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
        }
    )
    # A waiting parent may have any number of children, so its row is there once per salt.
    open_nodes = nodes.where(F.col("parent").isNotNull() & F.col("parent_conv_id").isNull())
    salt = F.pmod(F.xxhash64("id"), F.lit(WAITING_SALTS)).cast("int")
    parents = merged.select(F.col("id").alias("parent"), F.col("conv_id").alias("found_conv"), F.explode(F.sequence(F.lit(0), F.lit(WAITING_SALTS - 1))).alias("salt"))
    closed = open_nodes.withColumn("salt", salt).join(parents, ["parent", "salt"]).withColumn("parent_conv_id", F.col("found_conv"))
    settled = nodes.where(F.col("parent").isNull() | F.col("parent_conv_id").isNotNull())
    nodes = settled.select(*result).unionByName(closed.select(*result))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(ends, "id", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))


def conversation_trie(conversations: DataFrame, span: int = LAYER, **columns: str) -> DataFrame:
    """The trie of the rebuilt conversations of a table; ``columns`` as for ``turn_rows``."""
    return prefix_trie(with_shared_heads(_written(turn_rows(conversations, **columns), "turns")), span)
