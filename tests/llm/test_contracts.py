"""The registered queries against brute force: columns, types and every row, on tables with hostile rows."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import queries

BENCHMARK = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "only three words"),
    (30, "a " * 14),
    (4, None),
    (5, " ,; "),
    (6, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
]


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def make_texts():
    r = random.Random(11)
    base = [f"w{r.randrange(500)}" for _ in range(200)]
    passage = "".join(r.choice("abcdé ") for _ in range(420))
    out = [None, "", " \t\n ", "one", "ONE", "two words", "Two\x0bwords", " ".join(base), " ".join(base).upper(), "a " * 700, "a" * 900]
    for _ in range(12):
        near = list(base)
        for _ in range(r.randrange(1, 6)):
            near[r.randrange(len(near))] = "changed"
        out.append(" ".join(near))
    out += [f"{k} before {passage[: 395 + k]} after {k}" for k in range(12)]  # around 400 bytes
    out += ["x ALPHA, beta gamma-delta epsilon zeta eta theta iota kappa lambda x", "say only three words, only three", "tail\u0001 <|endoftext|> 日本語 \u00a0 don't"]
    # Two words that a polynomial modulo 2^64 takes for one.
    odd = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    out += [odd, odd.translate(str.maketrans("ab", "ba"))]
    return out


TEXTS = make_texts()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [(3 * k + 1, t, "en", "s", len(t or "")) for k, t in enumerate(TEXTS)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    pages = [(k, f"http://h/{k}", page) for k, page in enumerate(PAGES)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(f"{path}/pages.parquet")
    spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return path


PAGES = [None, "", "short", "short", "é" * 49, "é" * 49, "é" * 50, "é" * 50, "x" * 99, "x" * 99, "x" * 100, "x" * 100, *["error page " * 20] * 40, "only one " * 40]
_draw = np.random.default_rng(5).normal(size=(230, 8)).astype(np.float32)
VECTORS = [(k, _draw[k % 200].tolist(), k % 3) for k in range(230)]  # the last ones tie with the first
VECTORS += [(400, None, 1), (450, [float("nan")] + [0.0] * 7, 1), (500, [None] + [0.0] * 7, None), (550, [float("inf")] + [0.0] * 7, 2)]


def rows_of(spark, folder, name, schema):
    out = queries.QUERIES[name](spark, folder)
    types = dict(out.dtypes)
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    assert [types[c] for c in names] == [{"long": "bigint"}.get(k, k) for k in kinds]
    return sorted(tuple(r[c] for c in names) for r in out.collect())


def documents():
    return [(3 * k + 1, t or "") for k, t in enumerate(TEXTS)]


def test_op1(spark, folder):
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for n, t in documents():
        ids = known.encode(t, add_special_tokens=False).ids
        want.append((n, len(ids), sha(",".join(map(str, ids))), sha(known.decode(ids, skip_special_tokens=False))))
    assert rows_of(spark, folder, "op1_bpe_codec", "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string") == want


def test_op2(spark, folder):
    sets = {}
    for n, t in documents():
        words = re.findall("[^ \\x09-\\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t))
        sets[n] = {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))} if words else set()
    component = {n: n for n in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and component[a] < component[b]:
                    component[b], changed = component[a], True
    want = [(n, len(s), component[n]) for n, s in sorted(sets.items())]
    assert rows_of(spark, folder, "op2_ngram_jaccard", "doc_id long, n_shingles long, component_id long") == want


def test_op3(spark, folder):
    def words(t):
        return re.findall("[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))

    want = []
    for n, t in documents():
        mine, hit, items = words(t), set(), set()
        for item, text in BENCHMARK:
            other = words(text)
            width = min(10, len(other))
            windows = {tuple(other[k : k + width]) for k in range(len(other) - width + 1)} if other else set()
            for k in range(len(mine) - width + 1):
                if tuple(mine[k : k + width]) in windows:
                    hit |= set(range(k, k + width))
                    items.add(str(item))
        want.append((n, len(mine), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    got = rows_of(spark, folder, "op3_decontaminate", "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
    assert got == want and sum(x[2] > 0 for x in want) >= 3


def test_op6(spark, folder):
    first, want = {}, []
    for k, page in enumerate(PAGES):
        raw = (page or "").encode()
        found = first.setdefault(raw, k) if len(raw) >= 100 else k
        want.append((k, len(raw), sha(raw), "response" if found == k else "revisit", None if found == k else found))
    got = rows_of(spark, folder, "op6_warc_normalise", "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    assert got == want and sum(x[3] == "revisit" for x in want) == 41


def test_op6_without_frequent_payloads(spark, folder, monkeypatch):
    monkeypatch.setattr("millrace.llm.warc.MOST_FREQUENT", 1)  # all meet by digest
    test_op6(spark, folder)


def test_op7(spark, folder):
    texts = [(n, t.encode()) for n, t in documents()]
    places = {}
    for n, raw in texts:
        for k in range(len(raw) - 399):
            places.setdefault(raw[k : k + 400], []).append((n, k))
    gone = {n: np.zeros(len(raw), bool) for n, raw in texts}
    for found in places.values():
        if len(found) > 1:
            for n, k in found:
                gone[n][k : k + 400] = True
    want = []
    for n, raw in texts:
        spans = int(np.sum(np.diff(gone[n].astype(int), prepend=0) == 1))
        want.append((n, len(raw), int(gone[n].sum()), spans, sha(bytes(np.frombuffer(raw, np.uint8)[~gone[n]]))))
    got = rows_of(spark, folder, "op7_suffix_dedup", "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    assert got == want and sum(x[2] > 0 for x in want) >= 10


def test_op8(spark, folder):
    x = {n: np.floor(256 * np.array(v, np.float64)) for n, v, _ in VECTORS[:230]}
    want = []
    for q in sorted(n for n in x if n % 50 == 0):
        best = sorted((-int(x[q] @ v), n) for n, v in x.items() if n != q)[:5]
        want += [(q, k + 1, n, -s) for k, (s, n) in enumerate(best)]
    assert rows_of(spark, folder, "op8_pivot_topk", "query_id long, rank int, vec_id long, score long") == want


def test_op9(spark, folder):
    known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for n, t in documents():
        ids = [*known.encode(t, add_special_tokens=False).ids, 2]
        want.append((n, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert rows_of(spark, folder, "op9_token_files", "doc_id long, start long, n_tokens long, ids_crc32 long") == want
