"""Conversation trie, vector codes and packing against brute force, on edge rows and as registered."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing, prefix_trie, queries, vector_codes
from millrace.llm.radix_tree import Direct, Indexed, RadixTree, Sorted

TURNS = "conv_id long, turn long, role string, text string, id string, path string, top string"
SMALL = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")


# --- radix tree ---------------------------------------------------------------


def test_layouts_grow():
    tree = RadixTree()
    kinds = []
    for k in range(256):
        tree.put(b"same" + bytes([k]) + b"tail", k)
        node = tree.root
        while node.children is not None and len(list(node.items())) == 1:
            node = next(iter(node.items()))[1]
        kinds.append(node.children)
    assert [type(kinds[k]) for k in (3, 15, 47, 48, 255)] == [Sorted, Sorted, Indexed, Direct, Direct]
    assert (kinds[3].room, kinds[15].room) == (4, 16)
    assert [tree.get(b"same" + bytes([k]) + b"tail") for k in range(256)] == list(range(256))
    assert tree.get(b"same") is None and tree.get(b"other") is None


def test_tree_is_a_dictionary():
    r = random.Random(3)
    known, tree = {}, RadixTree()
    for k in range(3000):
        key = bytes(r.choice(b"abc") for _ in range(r.randrange(12)))
        known[key] = k
        tree.put(key, k)
    assert all(tree.get(key) == value for key, value in known.items())
    assert tree.get(b"abcabcabcabcabc") is None
    ends = [node.value for node, _, _ in tree.upwards() if node.value is not None]
    assert sorted(ends) == sorted(known.values())


# --- conversation trie ----------------------------------------------------------


def trie_by_hand(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, tie, (role, text)))
    plain = {c: [x[3] for x in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(plain.get(c - c % 100, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, path in sorted(rebuilt.items()):
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = collections.defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        saved[path] = sum(saved[k] for k in children[path]) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
    return sorted(
        (
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in m if rebuilt[c] == p).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(frame):
    return sorted(tuple(r) for r in frame.select(*TRIE).collect())


@pytest.fixture(scope="module")
def talk():
    """Null ids, turns, roles and texts, repeated rows and turn numbers, hot beginnings, long and empty ones."""
    r = random.Random(11)
    rows = [(None, 0, "user", "lost"), (3, None, None, None), (3, 0, "", ""), (3, 0, "user", "b"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    for c in range(0, 700):
        if r.random() < 0.1 and c != 0:
            continue
        first = "hello" if r.random() < 0.7 else f"start {r.randrange(40)}"
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", first if t == 0 else f"é{r.randrange(3)}" * r.randrange(1, 4)) for t in range(r.randrange(1, 9))]
    rows += [(c, t, "user", f"long {t}") for c in (800, 801, 977) for t in range(300 + c % 7)]
    rows += [(1_000_000_007, 5, "user", "x" * 100_000), (1205, 1, "a:b", "c"), (1205, 2, "a", ":bc")]
    rows += [(c, t, "user", "the same") for c in range(5000, 5400) for t in range(7)]
    return rows


@pytest.mark.parametrize("span", [1, 3, 128])
def test_trie_is_that_of_brute_force(spark, talk, span):
    frame = spark.createDataFrame([(*row, "clash", "clash", "clash") for row in talk], TURNS).repartition(5)
    if span == 1:  # every turn is a layer of its own: a job each
        talk = [row for row in talk if row[0] is None or row[0] < 700]
        frame = frame.where("conv_id is null or conv_id < 700")
    assert trie_rows(prefix_trie.conversation_trie(frame, span=span)) == trie_by_hand(talk)


def test_trie_lists_in_pieces(spark, monkeypatch):
    """The members of a node come in many lists, in one task or in several."""
    monkeypatch.setattr(prefix_trie, "TREE_BYTES", 2000)
    rows = [(c, 0, "user", "same") for c in range(1, 2100)]
    frame = spark.createDataFrame([(*row, "", "", "") for row in rows], TURNS)
    assert trie_rows(prefix_trie.conversation_trie(frame)) == trie_by_hand(rows)


def test_empty_trie(spark):
    assert trie_rows(prefix_trie.conversation_trie(spark.createDataFrame([], TURNS))) == []
    only_null = spark.createDataFrame([(None, 1, "user", "x", "", "", "")], TURNS)
    assert trie_rows(prefix_trie.conversation_trie(only_null)) == []


def test_registered_trie(spark):
    frame = queries.op11_conversation_trie(spark, SMALL)
    assert frame.columns == TRIE
    assert [k for _, k in frame.dtypes] == ["bigint"] * 7 + ["string"]
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(frame) == trie_by_hand(rows)


# --- vector codes -----------------------------------------------------------------


def codes_by_hand(rows, parts=16, entries=64, rounds=2, scale=256.0):
    """Rows are (id, vector, label); also the codebooks."""
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    ints = np.zeros((len(kept), parts * width), np.int64)
    for k, (_, v, _) in enumerate(kept):
        ints[k, : len(v)] = np.floor(np.array(v, np.float32).astype(float) * scale)
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, list(kept[k][1])))
    cut = ints.reshape(-1, parts, width)
    book = cut[order[:entries]].transpose(1, 0, 2).copy()

    def nearest():
        square = np.square(cut[:, :, None, :] - book[None]).sum(3)
        return square.argmin(2), square.min(2).sum(1)

    for _ in range(rounds):
        code, _ = nearest()
        for p, e in itertools.product(range(parts), range(book.shape[1])):
            mine = cut[code[:, p] == e, p]
            if len(mine):
                book[p, e] = mine.sum(0) // len(mine)
    code, error = nearest()
    return [(i, bytes(c.tolist()).hex(), int(e), g) for (i, _, g), c, e in zip(kept, code, error)], book


VECTORS = "vec_id long, embedding array<float>, label int, code string, error string, lane string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, g, "x", "x", "x") for i, v, g in rows], VECTORS)


def many_vectors(n, size, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.3, (20, size))
    vectors = centres[r.integers(0, 20, n)] + r.normal(0, 0.05, (n, size))
    vectors[::3] = vectors[0]  # a third of all rows alike
    return [(int(i), [float(x) for x in v.astype(np.float32)], int(i % 5) or None) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("size,entries,rounds", [(64, 64, 2), (64, 64, 6), (40, 9, 3), (16, 1, 2), (64, 64, 0)])
def test_codes_are_those_of_brute_force(spark, size, entries, rounds):
    rows = many_vectors(900, size, size + entries)
    rows += [(None, rows[5][1], 3), (-4, rows[7][1], 3), (-4, rows[8][1], None), (-4, rows[8][1], None), (10_000, rows[9][1][:-3], 1), (10_001, [], 1)]
    rows += [(10_002, None, 1), (10_003, [None] + rows[0][1][1:], 1), (10_004, [float("nan")] * size, 1), (10_005, [float("inf")] * size, 1)]
    found = vector_codes.encode_vectors(vector_frame(spark, rows).repartition(4), entries=entries, rounds=rounds, keep=["label"])
    wanted, book = codes_by_hand(rows, entries=entries, rounds=rounds)
    got = [(r.key, bytes(r.code).hex(), r.error, r.label) for r in found.codes.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert found.codebooks.tolist() == book.tolist()


def test_large_components(spark):
    """Beyond the range in which doubles measure exactly, and held at the limit beyond 2^19."""
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in (r.normal(0, 3e5, 16)).clip(-500_000, 500_000).astype(np.float32)], 1) for i in range(100)]
    found = vector_codes.encode_vectors(vector_frame(spark, rows), entries=8)
    wanted, book = codes_by_hand(rows, entries=8)
    assert sorted((r.key, bytes(r.code).hex(), r.error) for r in found.codes.collect()) == sorted(w[:3] for w in wanted)
    huge = vector_codes.encode_vectors(vector_frame(spark, [(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [3e38] * 16, 1)]), entries=2)
    assert sorted((r.key, r.error) for r in huge.codes.collect()) == [(1, 0), (2, 0), (3, 0)]


def test_few_and_no_vectors(spark):
    rows = many_vectors(5, 64, 1)
    found = vector_codes.encode_vectors(vector_frame(spark, rows))
    assert found.codebooks.shape == (16, 5, 4)
    assert sorted((r.key, bytes(r.code).hex(), r.error) for r in found.codes.collect()) == sorted(w[:3] for w in codes_by_hand(rows)[0])
    none = vector_codes.encode_vectors(vector_frame(spark, [(1, None, 1)]))
    assert none.codes.collect() == []


def test_bounds_spare_distances():
    """Most parts keep their entry by the bounds alone once the entries hardly move; lists get shorter."""
    r = np.random.default_rng(5)
    entries = r.integers(-4000, 4000, (64, 4))
    points = entries[r.integers(0, 64, 5000)] + r.integers(-60, 60, (5000, 4))
    lists, _ = vector_codes.full_lists(points, entries, 16)
    moved = entries + r.integers(-3, 4, entries.shape)
    moves = np.nextafter(np.sqrt(np.square(moved - entries).sum(1)), np.inf)
    after, nearest, needed = vector_codes.moved_lists(points, moved, moves, lists)
    assert (needed == 1).mean() > 0.8
    assert vector_codes.adapted(needed, 16, 16)[0] < 16
    exact = vector_codes.squares(points, moved)
    assert (after.near[:, 0] == exact.argmin(1)).all() and (nearest == exact.min(1)).all()
    listed = np.sqrt(np.take_along_axis(exact, after.near.astype(int), 1))
    assert (after.low <= listed).all()
    beyond = exact.astype(float)
    np.put_along_axis(beyond, after.near.astype(int), np.inf, 1)
    assert (after.outer <= np.sqrt(beyond.min(1))).all()


def test_wild_moves_are_verified():
    r = np.random.default_rng(6)
    entries, points = r.integers(-50, 50, (64, 3)), r.integers(-50, 50, (3000, 3))
    lists, _ = vector_codes.full_lists(points, entries, 4)
    for _ in range(4):
        moved = entries + r.integers(-30, 30, entries.shape)
        moves = np.nextafter(np.sqrt(np.square(moved - entries).sum(1)), np.inf)
        lists, nearest, needed = vector_codes.moved_lists(points, moved, moves, lists)
        entries = moved
        exact = vector_codes.squares(points, entries)
        assert (lists.near[:, 0] == exact.argmin(1)).all() and (nearest == exact.min(1)).all()
    assert vector_codes.adapted(np.array([5] * 50 + [1] * 50), 4, 16) == (16, True)
    assert vector_codes.adapted(needed, 4, 4)[1] is False


def test_group_totals(spark):
    rows = [(k % 3 if k % 3 else None, k) for k in range(900)] + [(k, k) for k in range(1000, 1600)]
    found = vector_codes.with_group_total(spark.createDataFrame(rows, "g int, v long"), "g", "v", "s").collect()
    sums = collections.Counter()
    for g, v in rows:
        sums[g] += v
    assert sorted(map(tuple, found), key=repr) == sorted(((g, v, sums[g]) for g, v in rows), key=repr)


def test_registered_codes(spark):
    frame = queries.op12_vector_codes(spark, SMALL)
    assert frame.dtypes[:5] == [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")]
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    wanted, book = codes_by_hand(rows)
    sums = collections.Counter()
    for _, _, error, label in wanted:
        sums[label] += error
    digest = hashlib.sha256(",".join(str(x) for p in book.tolist() for e in p for x in e).encode()).hexdigest()
    assert sorted(tuple(r) for r in frame.collect()) == sorted((i, c, e, sums[g], digest) for i, c, e, g in wanted)


# --- packing ------------------------------------------------------------------------


def check_packing(pieces, documents, length=1024, end=0):
    """Every id once, sequences gapless, padding only where stated.  Returns sizes of sequences."""
    known = Tokenizer.from_file(BYTES)
    known.no_truncation()
    known.no_padding()
    wanted = collections.Counter()
    for doc, text in documents:
        wanted[doc, tuple(known.encode(text or "", add_special_tokens=False).ids + [end])] += 1
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        assert p["length"] * 4 == len(p["ids"]) and p["length"] > 0
        by_doc[p["doc_key"], p["doc_tokens"]].append((p["start"], tuple(np.frombuffer(p["ids"], "<u4").tolist())))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    sizes = []
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        sizes.append(at)
    if len({doc for doc, _ in documents}) == len(documents):
        got = {(doc, sum((ids for _, ids in sorted(parts)), ())): 1 for (doc, _), parts in by_doc.items()}
        assert got == dict(wanted)
        for (doc, n), parts in by_doc.items():
            at = 0
            for start, ids in sorted(parts):
                assert start == at
                at += len(ids)
            assert at == n
    assert sum(sizes) == sum(len(ids) * n for (_, ids), n in wanted.items())
    return sizes


def padding(sizes, length=1024):
    return sum(0 if n & (n - 1) == 0 else length - n for n in sizes)


HOSTILE = [
    None, "", " ", "a", "x<|endoftext|>" * 30, "<|endoftext|>", "  y  z 　 'll 's!'s ÅÉ 日本語 🎉🎉 é" * 40, "\u0001\u001c\r\n\t tail  ",
    "a" * 70_000, " " * 70_000, "!" * 66_000, "ab " * 3000, "12345 " * 500, "don't I'LL 'S" * 30, "\n" * 65_536 + "x", "word " * 20_000,
]


def test_pieces_hold_every_id(spark):
    r = random.Random(4)
    documents = list(enumerate(HOSTILE))
    documents += [(100 + k, " ".join(f"w{r.randrange(999)}" for _ in range(r.randrange(0, 900)))) for k in range(300)]
    frame = spark.createDataFrame([(d, t, "x", "x") for d, t in documents], "doc_id long, text string, ids string, start string").repartition(3)
    sizes = check_packing(packing.pack_documents(frame, BYTES).collect(), documents)
    assert padding(sizes) == 0


def test_repeated_and_null_keys(spark):
    documents = [(None, "one two"), (None, "one two"), (7, "three"), (7, "three"), (7, None)]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    pieces = packing.pack_documents(frame, BYTES, length=4).collect()
    check_packing(pieces, documents, length=4)
    assert len({p["sequence_id"] for p in pieces}) >= 3


def test_nothing_to_pack(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id string, text string"), BYTES).collect() == []


def test_sum_of_squares_rule():
    """Each placement has the smallest sum of squares of all that are possible."""
    r = random.Random(8)
    packer = packing.Packer(64)
    for k in range(2000):
        need = r.choice([r.randrange(1, 64), 33, 20])
        level = packer.level.copy()
        best = []
        for fill in range(0, 64 - need + 1):
            if fill == 0 or level[fill]:
                after = level.copy()
                after[fill] -= bool(fill)
                after[fill + need] += 1
                best.append((int(np.square(after[1:64]).sum()), -fill))
        packer.place((k, 0, np.zeros(need, "<u4")))
        assert int(np.square(packer.level[1:64]).sum()) == min(best)[0]
        assert packer.level[1:64].sum() == packer.open == sum(len(w) for w in packer.windows)


def test_windows_stay_bounded():
    """Pieces that never fit together: open windows are settled, nothing is lost, little is cut."""
    packer = packing.Packer(100, most_open=50)
    for k in range(1000):
        packer.add(k, np.full(60, k, "<u4"))
        assert packer.open < 50
    packer.finish()
    windows = packer.take()
    sizes = [sum(len(p[2]) for p in w) for w in windows]
    assert sum(sizes) == 60_000 and padding(sizes, 100) == 0
    whole = collections.defaultdict(int)
    for w in windows:
        for doc, start, ids in w:
            assert (ids == doc).all()
            whole[doc] += len(ids)
    assert set(whole.values()) == {60}


def test_encoder_gives_the_ids_of_the_library():
    coder, known = packing.byte_coder(BYTES, public_tokenizers.PATTERN), Tokenizer.from_file(BYTES)
    texts = [t or "" for t in HOSTILE] + [known.decode([k]) for k in range(0, 50257, 7)]
    texts += ["".join(random.Random(k).choices("ab' \n\t éß日🎉1!.'s't<|endoftext|>", k=200)) for k in range(300)]
    for text in texts:
        assert coder.encode(text).tolist() == known.encode(text, add_special_tokens=False).ids


def test_registered_packing(spark):
    frame = queries.op13_sum_of_squares(spark, SMALL)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert frame.dtypes == [(n, "bigint") for n in names]
    known = Tokenizer.from_file(BYTES)
    ids = {r.doc_id: np.array(known.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = frame.collect()
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
