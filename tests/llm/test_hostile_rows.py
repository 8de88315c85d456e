"""Regular texts, broken pages and null ids, for which a plain method gives wrong results or takes for ever."""

import collections
import time

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import decontaminate, html_extract, ngram_join, suffix_dedup, topk
from millrace.llm.arrays import word_hashes


def thue_morse(size: int) -> tuple[str, str]:
    """A string over a and b and its complement; polynomials modulo 2^64 give both one hash."""
    word = "".join("ab"[k.bit_count() & 1] for k in range(size))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [64, 1024, 4096])
def test_regular_words_keep_apart(size):
    a, b = thue_morse(size)
    data = np.frombuffer(f"{a} {b} {a}".encode(), np.uint8)
    starts = np.array([0, size + 1, 2 * size + 2])
    first, other, again = word_hashes(data, starts, starts + size)
    assert first == again != other
    first, other, again = suffix_dedup.range_hashes(data, starts, size)
    assert first == again != other
    one, at = ngram_join.ngram_sets(pa.array([f"{a} x y z", f"{b} x y z"]), 4)
    assert len(one) == 2 and one[0] != one[1] and at.tolist() == [0, 1, 2]


def test_a_word_beyond_what_is_hashed_at_once():
    long = "ab" * (1 << 20)
    data = np.frombuffer(f"{long} {long} {long[:-1]}c".encode(), np.uint8)
    starts = np.arange(3) * (len(long) + 1)
    first, again, other = word_hashes(data, starts, starts + len(long))
    assert first == again != other


def test_regular_texts_are_not_one_passage(spark):
    a, b = thue_morse(1024)
    docs = spark.createDataFrame([(1, f"{a} one two three"), (2, f"{b} one two three"), (3, f"{a} one two three")], "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(docs, 4, 85).collect()}
    assert out == {1: 1, 2: 2, 3: 1}
    items = spark.createDataFrame([("i", f"{a} one")], "item_id string, text string")
    found = decontaminate.find_passages(decontaminate.index_postings(docs), items).collect()
    assert {r["doc_key"]: r["n_hit"] for r in found} == {1: 2, 2: 0, 3: 2}


def test_long_regular_repeats(spark):
    a, b = thue_morse(2048)
    texts = [f"first {a} end", f"other {b} tail", f"{a}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    length = 1100
    raw = [t.encode() for t in texts]
    seen = collections.Counter(x[k : k + length] for x in raw for k in range(len(x) - length + 1))
    for r in suffix_dedup.remove_repeats(docs, length).collect():
        x = raw[r["doc_id"]]
        mask = bytearray(len(x))
        for k in range(len(x) - length + 1):
            if seen[x[k : k + length]] > 1:
                mask[k : k + length] = b"\1" * length
        assert bytes(r["kept"]) == bytes(c for c, m in zip(x, mask) if not m), r["doc_id"]


@pytest.mark.parametrize("percent", [50, 80, 85, 99, 100])
def test_linked_sizes_are_in_neighbouring_bands(spark, percent):
    sizes = sorted({*range(1, 400), *(10**k + d for k in range(3, 12) for d in (-1, 0, 1))})
    largest = [s * 100 // percent for s in sizes]
    table = spark.createDataFrame(list(zip(sizes, largest)), "a long, b long")
    rows = table.select("a", "b", ngram_join.band_of(table["a"], percent).alias("low"), ngram_join.band_of(table["b"], percent).alias("high")).collect()
    assert all(0 <= r["high"] - r["low"] <= 1 for r in rows)
    if percent == 100:
        assert all(r["low"] == r["high"] for r in rows) and len({r["low"] for r in rows}) == len(rows)


def test_equal_sets_only(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "A b c d e"), (3, "a b c d f"), (4, None), (5, "b c d e a b c d e a")], "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(docs, 4, 100).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_bitmaps_follow_the_sizes_of_their_sets():
    r = np.random.default_rng(3)
    sizes = [4] * 2000 + [40] * 10 + [10**6]
    sets = [np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64)) for n in sizes]
    sets[7] = sets[5]
    sets[2003] = np.sort(np.append(sets[2001][:39], np.uint64(5)))
    at = np.cumsum([0, *map(len, sets)])
    tile = ngram_join.Tile(np.arange(len(sets)), np.zeros(len(sets), np.int64), np.concatenate(sets), at, 85)
    assert sum(bits.nbytes for _, bits in tile.bitmaps()) < 16 << 20
    assert {frozenset(x) for x in zip(*(y.tolist() for y in tile.links()))} == {frozenset({5, 7}), frozenset({2001, 2003})}


def test_regular_text_of_a_million_words(spark):
    docs = spark.createDataFrame([(1, "a " * 10**6), (2, "a b " * 40), (3, "a " * 9)], "doc_id long, text string")
    items = spark.createDataFrame([("i", "a " * 30), ("j", "a " * 12), ("k", "b a " * 20), (None, "a " * 10)], "item_id string, text string")
    index = decontaminate.index_postings(docs)
    began = time.monotonic()
    out = {r["doc_key"]: r for r in decontaminate.find_passages(index, items).collect()}
    assert time.monotonic() - began < 60
    assert {k: r["n_hit"] for k, r in out.items()} == {1: 10**6, 2: 80, 3: 0}
    assert {(m["item"], m["first"], m["end"]) for m in out[1]["matches"]} == {("i", 0, 10**6), ("j", 0, 10**6), (None, 0, 10**6)}
    assert out[2]["items"] == ["k"] and len(out[2]["matches"]) == 1


def test_runs_end_with_their_document():
    shard = decontaminate.Shard(*(np.array(x, t).tobytes() for x, t in (([0, 3, 3, 6], np.int32), ([9], np.uint64), ([0, 6], np.int32), (range(6), np.int32))))
    starts, ends = shard.within_documents(np.arange(6), np.arange(6) + 2)
    assert starts.tolist() == [0, 1, 3, 4]
    starts, ends, of = decontaminate.runs_of(starts, ends, np.zeros(4, np.int64))
    assert list(zip(starts.tolist(), ends.tolist())) == [(0, 3), (3, 6)]


def texts_in(page: str) -> list[str]:
    return [t for _, t in html_extract.parse(page)[1]]


@pytest.mark.parametrize(
    "page,texts",
    [
        ("<article><p>one</p><button>Like<p>two</p></article><p>three", ["one", "two", "three"]),
        ("<p>one<button>Like<div>now</div></button></p><p>two", ["one", "two"]),
        ("<div><p>one<svg><path d=x></p><p>two</p></div><svg/>three", ["one", "two", "three"]),
        ("<p>a <svg><svg><g>x</g></svg>y</svg> b", ["a b"]),
        ("<p>pick <select><option>x<option>y</select> one<p>end", ["pick one", "end"]),
        ("<select><option>x<p>kept</p>", ["kept"]),
        ('<html><head><script>var s="<body x"</script><title>t</title></head><body><p>text', ["text"]),
        ("<head><meta a=b><p>no body tag", ["no body tag"]),
        ("<p>x <math><mi>y</mi></math> z", ["x y z"]),
        ("<p>a < b and c<d & e <b>bold</b> x<y", ["a < b and c<d & e bold x<y"]),
        ("<p title='a<b>c'>t</p><a href=x <b>u</b>", ["t", "u"]),
        ("<p>one<script>if (a<b) '</p>'</script> two</p>", ["one two"]),
        ("<noscript><div>no</div></noscript><template><p>no</template><p>yes", ["yes"]),
    ],
)
def test_broken_pages(page, texts):
    assert texts_in(page) == texts


@pytest.mark.parametrize("unit", ["if a <b and ", "<b", '<b "', "<! ", "</script ", "<button>", "<svg>x", "<b '\" ", "<!-"])
def test_pages_of_stray_tags_take_linear_time(unit):
    began = time.monotonic()
    html_extract.parse("<p>" + unit * ((1 << 20) // len(unit)))
    assert time.monotonic() - began < 20


def test_null_ids_in_ties(spark):
    rows = [(50, [1.0, 0.0]), (None, [0.5, 0.0]), (None, [0.5, 0.0]), (3, [0.5, 0.0]), (4, None), (5, [float("nan"), 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = sorted((r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(vectors, "id % 50 = 0", 2).collect() if r["query_id"] == 50)
    assert out == [(1, None, 256 * 128), (2, None, 256 * 128)]
