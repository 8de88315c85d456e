"""Operators against brute force on small tables, with nulls, empty and repeated texts."""

import collections
import hashlib
import os
import random
import re
import struct
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from millrace.llm import bpe, components, decontaminate, html_extract, lm_score, ngram_join, queries, suffix_dedup, token_files, topk, toxicity, warc  # noqa: E402

DOCS = "doc_id long, text string, ids string"
SMALL = "/root/testdata/sf0.001"


def words(n, seed, size=2000):
    r = random.Random(seed)
    return [f"w{r.randrange(size)}é" if r.random() < 0.1 else f"w{r.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(7)
    base = words(300, 1)
    out = [None, "", " \t\n", "one", "One two", " ".join(base), " ".join(base)]
    for k in range(25):
        near = list(base)
        for _ in range(r.randrange(1, 9)):
            near[r.randrange(len(near))] = f"x{r.randrange(99)}"
        out.append(" ".join(near))
    passage = " ".join(words(90, 2))
    out += [" ".join(words(60, 10 + k)) + " " + passage + " " + " ".join(words(60, 50 + k)) for k in range(6)]
    out += ["a" * 1500, "abc" * 700, "x<|endoftext|> y  z　' 's!'s ÅÉ 日本語 " * 30, "\u0001\u001c tail  "]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], DOCS).repartition(3)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("decoded", [True, False])
def test_bpe(docs, texts, decoded):
    path = public_tokenizers.path("byte_bpe_50k.json")
    known = Tokenizer.from_file(path)
    out = bpe.bpe_encode(docs, path, decoded=decoded)
    out = by_id(out if decoded else bpe.bpe_decode(out, path))
    for k, t in enumerate(texts):
        ids = known.encode(t or "", add_special_tokens=False).ids
        assert out[k]["ids"] == ids
        assert out[k]["decoded"] == known.decode(ids, skip_special_tokens=False)


def shingles(text, width):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1)))


@pytest.mark.parametrize("width,percent,tile,grams", [(4, 85, 2048, 1 << 21), (5, 80, 4, 1 << 21), (5, 80, 2048, 60), (1, 50, 2048, 1 << 21)])
def test_ngram_components(docs, texts, width, percent, tile, grams):
    sets = [shingles(t, width) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    out = by_id(ngram_join.ngram_components(docs, width, percent, tile_sets=tile, tile_grams=grams))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in out.items()} == {k: (len(s), find(k)) for k, s in enumerate(sets)}


def test_hot_keys_meet_within_slices():
    keys = np.array([5, 5, 9, 5, 7, 7], np.uint64)
    nodes = np.array([4, 2, 1, 3, 8, 6], np.uint64)
    k, n = ngram_join.met_within(keys, nodes, 77)
    common = np.isin(k, keys)
    assert sorted(zip(k[common].tolist(), n[common].tolist())) == [(5, 2), (7, 6), (9, 1)]
    groups: dict[int, list[int]] = {}
    for a, b in zip(k[~common].tolist(), n[~common].tolist()):
        groups.setdefault(a, []).append(b)
    assert sorted(sorted(g) for g in groups.values()) == [[2, 3, 4], [6, 8]]
    assert not len(ngram_join.met_within(keys[:0], nodes[:0], 77)[0])


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_linked_sets_share_a_prefix_gram(percent):
    r = np.random.default_rng(percent)
    sets = []
    for size in [1, 2, 5, 9, 40, 200]:
        base = r.choice(1 << 20, size, replace=False)
        for gone in range(size // 3 + 2):
            sets.append(np.unique(np.append(base[gone:], r.choice(1 << 20, gone // 2))).astype(np.uint64))
    at = np.cumsum([0, *map(len, sets)])
    grams = np.concatenate(sets)
    _, number, counts = np.unique(grams, return_inverse=True, return_counts=True)
    chosen, owners = ngram_join.prefix_grams(grams, at, ngram_join.rank_of(counts)[number], percent)
    keys = [set(grams[chosen[owners == k]].tolist()) for k in range(len(sets))]
    linked = 0
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                linked += 1
                assert keys[a] & keys[b]
    assert linked or percent == 100


def test_components_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    out = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    assert out == {k: 0 for k in range(41)} | {100: 100, 101: 100}


@pytest.mark.parametrize("slop", [0, 2])
def test_passages(spark, texts, slop):
    r = random.Random(3)
    items = [(k, " ".join(words(300, 1)[10 * k : 10 * k + 8 + k])) for k in range(6)] + [(8, None), (9, "..."), (10, "two"), (11, "ONE, two!")]
    shown = texts + ["w1 " + " zz ".join(words(300, 1)[10:14]) + " tail"]
    find = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    width = 4
    split = lambda t: find.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    del r
    docs = spark.createDataFrame(list(enumerate(shown)), "doc_id long, text string").repartition(3)
    table = spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.index_postings(docs)
    for block in (1 << 20, 200):
        out = by_id(decontaminate.find_passages(index, table, width, slop, block_bytes=block), "doc_key")
        for k, t in enumerate(shown):
            w, hit, found = split(t), set(), set()
            for i, x in items:
                x = split(x)
                n = min(width, len(x))
                for window in {tuple(x[j : j + n]) for j in range(len(x) - n + 1)} if n else ():
                    for a in range(len(w)):
                        if w[a] != window[0]:
                            continue
                        at = a
                        for term in window[1:]:
                            at = next((p for p in range(at + 1, len(w)) if w[p] == term), None)
                            if at is None:
                                break
                        if at is not None and at - a + 1 <= n + slop:
                            hit |= set(range(a, at + 1))
                            found.add(i)
            assert (out[k]["n_words"], out[k]["n_hit"], sorted(out[k]["items"])) == (len(w), len(hit), sorted(found)), k


PAGE = (
    "<html><head><title>T</title></head><body><nav><ul><li><a href=x>Home</a><li><a>More</a></ul></nav><div class='ad'>Buy now</div>"
    "<article><h1>Head &amp; line</h1><p>First <b>bold<br>text<p>Second&nbsp; one</p><script>no()</script><div class=comments><p>me too</div></article>"
    "<footer>&copy; site</footer></body></html>"
)


def test_extract(spark):
    rows = [(k, f"u{k}", PAGE.replace("First", f"First {k}")) for k in range(40)] + [(90, "n", None), (91, "e", ""), (92, "t", "plain < text"), (93, "o", "<article><p>open")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = by_id(html_extract.extract_text(pages, html_extract.train_extractor(pages)), "page_id")
    assert out[7]["text"] == "Head & line\nFirst 7 bold text\nSecond one"
    assert out[90]["text"] == out[91]["text"] == ""
    assert out[93]["text"] == "open"
    assert html_extract.train_extractor(pages.limit(0)) is None


def test_decoding_is_consistent():
    nodes, _ = html_extract.parse("<div><div><p>a</div><p>b</div>")
    for seed in range(20):
        kept = html_extract.decode(nodes, np.random.default_rng(seed).normal(size=len(nodes)) * 3)
        assert all(kept[x.parent] for k, x in enumerate(nodes) if kept[k] and x.parent >= 0)


def test_losses(spark):
    docs = [(1, "a b a"), (2, "a b c"), (3, None), (4, "c c d"), (None, "a")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = by_id(lm_score.score_difference(df, spark.createDataFrame([(1,), (2,), (99,)], "doc_id long"), vocabulary=2))
    chains = {k: ["<s>", *(w if w in "ac" else "?" for w in (t or "").split()), "</s>"] for k, t in docs}
    for column, ids in (("target_loss", [1, 2]), ("background_loss", list(chains))):
        pairs = collections.Counter(p for k in ids for p in zip(chains[k], chains[k][1:]))
        before = collections.Counter(w for k in ids for w in chains[k][:-1])
        for k, x in chains.items():
            loss = np.mean([np.log2(before[a] + 0.05 * 5) - np.log2(pairs[a, b] + 0.05) for a, b in zip(x, x[1:])])
            assert out[k][column] == pytest.approx(loss, abs=1e-5)


def test_warc(spark, tmp_path):
    rows = [(3, "http://a/é", "x" * 150), (1, "http://b", "x" * 150), (2, None, "short"), (4, "u", "short"), (5, "v", None), (1, "w", "x" * 150), (None, "n", "x" * 150), (6, "line\r\nbreak", "é\r\n\r\n" * 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    out = warc.archive_round_trip(pages, str(tmp_path)).collect()
    got = sorted((r["page"] or "", r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in out)
    want = []
    for k, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and k in (3, None)
        want.append(("" if k is None else str(k), "revisit" if again else "response", "1" if again else None, len(raw), hashlib.sha256(raw).hexdigest()))
    assert got == sorted(want)


def test_damaged_stream():
    whole = zlib.compressobj(6, zlib.DEFLATED, warc.GZIP)
    raw = whole.compress(warc.record("response", "1", "u", "d", 3, None, b"abc", "now")) + whole.flush()
    cut = iter([raw[: len(raw) // 2], b""])
    with pytest.raises(ValueError):
        list(warc.records(warc.inflated(lambda n: next(cut))))


@pytest.mark.parametrize("length", [400, 70])
def test_remove_repeats(docs, texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = by_id(suffix_dedup.remove_repeats(docs, length))
    for k, b in enumerate(raw):
        mask = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                mask[s : s + length] = b"\1" * length
        assert bytes(out[k]["kept"]) == bytes(c for c, m in zip(b, mask) if not m), k
        assert [(s["begin"], s["end"]) for s in out[k]["removed"]] == [m.span() for m in re.finditer(b"\1+", bytes(mask))]


def test_interleave_is_the_sorted_order():
    r = np.random.default_rng(5)
    runs = []
    for _ in range(4):
        x = r.integers(0, 4, (30, 3)).astype(np.uint64)
        runs.append(x[np.lexsort(x.T[::-1])])
    x = np.concatenate(runs)
    order, prefix = suffix_dedup.interleave(x)
    merged = x[order]
    assert (merged == x[np.lexsort(x.T[::-1])]).all()
    for k in range(1, len(x)):
        common = 0
        while common < 3 and merged[k, common] == merged[k - 1, common] != 0:
            common += 1
        assert prefix[k] == common


@pytest.mark.parametrize("pivots,cell", [(8, 16), (64, 2048)])
def test_top_k(spark, pivots, cell):
    x = np.random.default_rng(1).normal(size=(400, 6))
    x[50:120] = x[50]
    rows = [(k, [float(v) for v in line]) for k, line in enumerate(x)] + [(1000, None), (1001, [None, 1.0]), (1002, [float("nan")] * 6)]
    out = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "id % 10 = 0", pivots=pivots, cell=cell).collect()
    v = np.floor(256 * x)
    want = set()
    for q in range(0, 400, 10):
        s = v @ v[q]
        best = [j for j in np.lexsort((np.arange(400), -s)) if j != q][:5]
        want |= {(q, k + 1, int(j), int(s[j])) for k, j in enumerate(best)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out} == want


def test_token_files(docs, texts, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    known = Tokenizer.from_file(path)
    catalogue = token_files.write_token_files(docs, path, 2, str(tmp_path / "t"))
    out = by_id(token_files.with_starts(token_files.read_token_files(catalogue)), "doc_key")
    start = 0
    for k, t in enumerate(texts):
        ids = [*known.encode(t or "", add_special_tokens=False).ids, 2]
        r = out[k]
        assert (r["start"], r["n_tokens"], r["ids"], r["ids_crc32"]) == (start, len(ids), ids, zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_damaged_frame(tmp_path):
    from pyarrow.fs import LocalFileSystem

    with open(tmp_path / "f", "wb") as f:
        writer = token_files.FrameWriter(f)
        writer.frame(np.arange(100, dtype=np.uint32))
        writer.frame(np.arange(50, dtype=np.uint32))
        writer.close()
    reader = token_files.FrameReader(LocalFileSystem().open_input_file(str(tmp_path / "f")))
    assert reader.ids(98, 4).tolist() == [98, 99, 0, 1]
    reader.checksums = reader.checksums + 1
    reader.last = (-1, b"")
    with pytest.raises(ValueError):
        reader.ids(0, 1)


def test_toxicity(spark):
    r = random.Random(2)
    rows, labels = [], []
    for k in range(400):
        toxic = k % 5 == 0
        w = words(80, 1000 + k, 300)
        if toxic:
            w.insert(r.randrange(80), "Vilewordx")
        rows.append((k, " ".join(w)))
        if k < 300:
            labels.append((k, int(k % 7 == 0), int(toxic)))
    rows += [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chain = toxicity.train_chain(docs, spark.createDataFrame([*labels, (5, None, 1)], "doc_id long, bad int, toxic int"), ["bad", "toxic"])
    out = by_id(toxicity.score_chain(docs, chain, keep=["doc_id"]))
    assert all(out[k]["rejected"] == (k % 5 == 0) for k in range(300, 400))
    assert not out[900]["rejected"] and not out[901]["rejected"]
    none = toxicity.train_chain(docs, spark.createDataFrame([], "doc_id long, bad int, toxic int"), ["bad", "toxic"])
    assert not any(x["rejected"] for x in toxicity.score_chain(docs, none, keep=["doc_id"]).collect())


@pytest.mark.parametrize("call", [
    lambda d: bpe.bpe_encode(d, public_tokenizers.path("byte_bpe_50k.json")),
    lambda d: ngram_join.ngram_components(d),
    lambda d: suffix_dedup.remove_repeats(d),
    lambda d: lm_score.score_difference(d, d),
    lambda d: decontaminate.find_passages(decontaminate.index_postings(d), d.selectExpr("doc_id AS item_id", "text")),
    lambda d: token_files.with_starts(token_files.read_token_files(token_files.write_token_files(d, public_tokenizers.path("word_bpe_49k.json"), 2))),
])
def test_empty_tables(spark, call):
    assert call(spark.createDataFrame([], DOCS)).count() == 0


def test_empty_vectors_and_pages(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), "id % 2 = 0").count() == 0
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline_with_hostile_rows(spark, tmp_path):
    """Null and repeated ids, empty texts, extra columns with clashing names: no row goes but for a stage's reason."""
    clean = [" ".join(f"{chr(97 + k % 26)}{r}w{k}" for r in range(40)) for k in range(30)]
    rows = [(k, clean[k], "en", "s", None, k) for k in range(20)]
    rows += [(None, clean[20], "en", "s", 1, 1), (None, clean[21], None, None, 1, 1), (7, clean[22], "en", "s", 1, 1), (7, clean[23], "en", "s", 1, 1)]
    rows += [(100, clean[24], "en", "s", 1, 1), (99, clean[24] + " more", "en", "s", 1, 1), (None, clean[24], "en", "s", 1, 1), (101, None, "en", "s", 1, 1), (102, "", "en", "s", 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept long").withColumnRenamed("kept", "_row")
    near = corpus_pipeline.without_near_copies(spark, docs, SMALL)
    assert near.columns == docs.columns
    left = collections.Counter((r["doc_id"], r["text"]) for r in near.collect())
    gone = {(100, clean[24]), (None, clean[24])}
    assert left == collections.Counter((r[0], r[1]) for r in rows if (r[0], r[1]) not in gone)
    rest = corpus_pipeline.without_repeats(spark, near, SMALL)
    assert rest.columns == docs.columns
    assert sorted(map(tuple, rest.collect()), key=repr) == sorted(map(tuple, near.collect()), key=repr)
    path = str(tmp_path / "benchmark.parquet")
    spark.createDataFrame([("b1", " ".join(clean[3].split()[5:20])), ("b2", None)], "item_id string, text string").write.parquet(path)
    free = corpus_pipeline.without_benchmark(spark, rest, str(tmp_path))
    assert free.columns == docs.columns
    assert sorted(map(tuple, free.collect()), key=repr) == sorted((tuple(r) for r in near.collect() if r["doc_id"] != 3), key=repr)
    coded = corpus_pipeline.encoded(spark, free, SMALL)
    assert coded.count() == free.count() and coded.where("not round_trip").isEmpty()


def test_pipeline_stages_on_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.without_near_copies, corpus_pipeline.without_repeats, corpus_pipeline.without_benchmark, corpus_pipeline.encoded):
        assert stage(spark, docs, SMALL).collect() == []


def test_repeats_are_cut_from_documents(spark):
    passage = "é" + " ".join(f"word{k}" for k in range(80))
    rows = [(k, f"beginning {k} ☃" + passage + f" end {k}", "en", "s", 1) for k in range(3)] + [(9, "short", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in corpus_pipeline.without_repeats(spark, docs, SMALL).collect()}
    assert out[9].text == "short" and out[9].n_chars == 5
    for k in range(3):
        assert out[k].text == f"beginning {k}{k}" and out[k].n_chars == 12  # what surrounds the passage is repeated too


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert 0 < len(out) <= docs.count() and all(r["round_trip"] for r in out)
    assert {r["doc_id"] for r in out} <= {r[0] for r in docs.select("doc_id").collect()}


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


def test_groups_release_memory_at_their_end(monkeypatch):
    """After every group, not when the worker ends; one and two tables stay told apart."""
    import inspect

    import pyarrow as pa

    from millrace.llm import arrays

    done = []
    monkeypatch.setattr(arrays, "release_memory", lambda: done.append(True))
    table = pa.table({"x": [1, 2]})
    one, two = arrays.releasing_group(lambda a: a), arrays.releasing_group(lambda a, b: pa.concat_tables([a, b]))
    assert one(table).num_rows == 2 and two(table, table).num_rows == 4 and len(done) == 2
    assert [len(inspect.signature(f).parameters) for f in (one, two)] == [1, 2]

    def fails(_):
        raise ValueError("bad group")

    with pytest.raises(ValueError, match="bad group"):
        arrays.releasing_group(fails)(table)
    assert len(done) == 3


def test_loss_differences_release_each_group(spark, monkeypatch):
    from millrace.llm import lm_score

    wrapped = []
    monkeypatch.setattr(lm_score, "releasing_group", lambda run: wrapped.append(run.__name__) or run, raising=False)
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b"), (3, None)], "doc_id long, text string")
    lm_score.score_difference(docs, docs.where("doc_id = 1"))
    assert sorted(wrapped) == ["add", "answer", "ask", "count", "score"]


def test_repeated_windows_take_little_memory_for_a_slice():
    """A slice takes some 40 times its bytes, although all of its windows are repeated."""
    import tracemalloc

    import pyarrow as pa

    class Frame:
        def mapInArrow(self, send, schema):
            self.send = send
            return self

        def groupBy(self, key):
            return self

        def applyInArrow(self, meet, schema):
            return self

    half = np.random.default_rng(3).integers(97, 123, suffix_dedup.SLICE // 2 - 8, dtype=np.uint8).tobytes().decode()
    texts = pa.array([half, half[1:]])
    parsed = suffix_dedup.Parsed(*suffix_dedup.byte_view(texts), 400)
    marks = [[(parsed.phrase[parsed.text == k] - parsed.offsets[k]).astype(np.int32).tobytes()] for k in (0, 1)]
    ids = pa.array([1, 2], pa.int64())
    batch = pa.RecordBatch.from_arrays([texts, ids, ids, pa.array(marks, pa.list_(pa.binary()))], names=["_text", "h1", "h2", "marks"])
    frame = Frame()
    suffix_dedup.repeated_windows(frame, 400, 4)
    tracemalloc.start()
    try:
        windows = sum(sum(np.frombuffer(x.as_py(), np.int32).sum() for x in out.column("count")) for out in frame.send(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert windows > 2.5 * len(half)  # both places, and one of them to be sent on
    assert peak < 60 * suffix_dedup.SLICE
