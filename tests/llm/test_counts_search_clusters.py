"""Token counts, sketch search and centroid clusters: against the library or brute force, and on messy tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from isotherm.llm import centroid_clusters, licence_scan, queries, sketch_search, token_counts
from isotherm.llm.common import ALNUM, table
from tests.conftest import SF_SMALL
from tests.llm import messy

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(VOCABULARY)


def whole_count(text):
    return len(WHOLE.encode(text or "", add_special_tokens=False).ids)


# ---------------------------------------------------------------- token counts

ODD = "".join(chr(c) for c in (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1F, 0x85, 0xA0, 0x2003, 0x2028, 0x3000, 0x200B))
PIECES = ["<|endoftext|>", "<|endof", "text|>", "it's", "we'll", "'", " ", "  ", "\n\n", " \n ", "abc123", "中文",
          "été", "\U0001f600", "!?", "_", *ODD]


@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=5)), max_size=25).map("".join), st.integers(1, 12))
@settings(max_examples=400, deadline=None)
def test_counts_of_pieces_and_parts_add_up(text, size):
    encoder = token_counts._ENCODERS.setdefault("test", token_counts.LengthEncoder(VOCABULARY))
    assert encoder.counts([text]) == [whole_count(text)]
    parts = list(token_counts.safe_parts(text, size))
    assert "".join(parts) == text
    assert sum(map(whole_count, parts)) == whole_count(text)


def test_counts_in_small_batches(monkeypatch):
    texts = [messy.LONG[:5000], "", "word " * 300, "x" * 500, messy.PLAIN]
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 40)
    monkeypatch.setattr(token_counts, "LONG_BYTES", 100)
    monkeypatch.setattr(token_counts, "PIECES", 5)
    encoder = token_counts.LengthEncoder(VOCABULARY)
    for _ in range(2):
        assert encoder.counts(texts) == [whole_count(t) for t in texts]


@pytest.mark.parametrize("long_bytes", [token_counts.LONG_BYTES, 60])
def test_counts_on_messy_rows(spark, long_bytes):
    """With 60 bytes, most texts are cut into parts, equal ones once."""
    docs = messy.messy_documents(spark)
    got = token_counts.count_tokens(docs, VOCABULARY, long_bytes=long_bytes)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = [(r[0], len((r[1] or "").encode()), whole_count(r[1])) for r in messy.ROWS]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(messy.empty_documents(spark), VOCABULARY, long_bytes=long_bytes).count() == 0


def test_count_query_against_the_library(spark):
    rows = queries.op11_token_counts(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = whole_count(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 512)


# ---------------------------------------------------------------- sketch search

def plain_search(docs, items, k):
    """All documents scored for every item: (item, rank, doc_id, score)."""
    held = [(i, Counter((t or "").encode().translate(ALNUM).split())) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    words = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        terms = set((text or "").encode().translate(ALNUM).split())
        scored = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * len(held) // words
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, n + 1, None if null else i, -s) for n, (s, null, i) in enumerate(sorted(scored)[:k])]
    return out


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("block, lookups, share", [(4 << 20, 2_000_000, 32), (300, 40, 2), (1, 1, 10**9)])
def test_search_against_brute_force(spark, monkeypatch, block, lookups, share):
    """Skewed words, texts of one to 800 words, repeated texts and ids; blocks, slices and first shares of several sizes."""
    rng = random.Random(5)
    words = [f"w{n}" for n in range(400)]
    some = lambda n: " ".join(words[min(int(rng.paretovariate(0.6)), 400) - 1] for _ in range(n))
    docs = [(n, some(rng.choice([1, 5, 40, 800]))) for n in range(250)]
    docs += [(7, docs[7][1]), (900, docs[7][1]), (None, docs[8][1]), (None, docs[8][1]), (901, None), (902, " .,"), (903, "w1 " * 700)]
    items = [(n, some(rng.choice([1, 3, 30]))) for n in range(25)] + [(1, docs[7][1]), (1, ""), (None, "w3 W3 w900"), (77, None)]
    monkeypatch.setattr(sketch_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(sketch_search, "LOOKUPS", lookups)
    monkeypatch.setattr(sketch_search, "FIRST_SHARE", share)
    if block == 1:
        items = items[-6:]
    index = sketch_search.index_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    got = sketch_search.search(index, spark.createDataFrame(items, "item_id long, text string"), k=7)
    assert rows_of(got) == sorted(plain_search(docs, items, 7), key=str)


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=4).map(str.encode), st.integers(1, 400), min_size=1, max_size=40),
       st.lists(st.text("abcdefgh", min_size=1, max_size=4).map(str.encode), min_size=1, max_size=12, unique=True),
       st.integers(10, 5000))
@settings(max_examples=200, deadline=None)
def test_bounds_hold(counts, terms, m):
    block = sketch_search.Queries([(1, terms)])
    block.weights[:] = np.arange(1, len(terms) + 1) * 37
    sketch = sketch_search.sketch_of(list(counts), np.array(list(counts.values())))
    bound = sketch_search.upper_bounds(block, [sketch], np.array([m]))[0, 0]
    score = sum(int(block.weights[block.number[t]]) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m)) for t in terms if t in counts)
    assert bound >= score


def test_bounds_spare_rescoring(spark, monkeypatch):
    """Most documents are not rescored: the sketches tell them from the best."""
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    rows = spark.createDataFrame(docs, "doc_id long, text string").select(
        F.col("doc_id"), F.col("text")).coalesce(1).toArrow().to_batches()
    index = list(sketch_search._index_rows(iter(rows)))
    block = next(sketch_search.query_blocks(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text"))
    n = sum(x > 0 for b in index for x in b.column("n").to_pylist())
    words = sum(x for b in index for x in b.column("n").to_pylist())
    df = Counter()
    for part in sketch_search._frequencies(block)(iter(index)):
        df.update(dict(zip(part.column("term").to_pylist(), part.column("df").to_pylist())))
    block.weigh(n, df)
    added = []
    real = sketch_search._Best.add
    monkeypatch.setattr(sketch_search._Best, "add", lambda self, q, s, d: (added.append(q), real(self, q, s, d)))
    list(sketch_search._search(block, np.zeros(len(block.of), np.int64), 10, n, words)(iter(index)))
    assert len(added) < 0.6 * n * len(block.of)


def test_search_on_messy_rows(spark):
    docs = messy.messy_documents(spark)
    items = messy.benchmark(spark)
    got = rows_of(sketch_search.search(sketch_search.index_documents(docs), items, k=3))
    plain = plain_search([(r[0], r[1]) for r in messy.ROWS], [(r.item_id, r.text) for r in items.collect()], 3)
    assert got == sorted(plain, key=str)
    assert sketch_search.search(sketch_search.index_documents(messy.empty_documents(spark)), items).count() == 0
    assert sketch_search.search(sketch_search.index_documents(docs), items.limit(0)).count() == 0


# ---------------------------------------------------------------- centroid clusters

def plain_clusters(rows, k, rounds, dims):
    """Lloyd's rounds in Python integers: {row: (cluster, distance)}, centroids."""
    kept = [(i, [math.floor(1024 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    digest = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centroids = [list(x) for _, x in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    def nearest(x):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
        return far.index(min(far)), min(far)
    for _ in range(rounds):
        of = [nearest(x)[0] for _, x in kept]
        for c in range(len(centroids)):
            mine = [x for (_, x), o in zip(kept, of) if o == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return sorted(((i, *nearest(x)) for i, x in kept), key=str), centroids


@pytest.mark.parametrize("cells, scatter", [(256, 0.05), (256, 3.0), (4, 0.3)])
def test_clusters_against_brute_force(spark, monkeypatch, cells, scatter):
    """Tight groups, one cloud, and cells too coarse to tell anything."""
    monkeypatch.setattr(centroid_clusters, "CELLS", cells)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 9))
    data = [(i, [float(c) for c in centres[i % 6] + scatter * rng.normal(size=9)]) for i in range(180)]
    data += [(500, data[0][1]), (0, data[0][1]), (None, data[1][1]), (None, data[1][1]), (501, [90.0] * 9)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(4)
    got = centroid_clusters.cluster_vectors(df, k=5, rounds=6, dims=9).collect()
    want, centroids = plain_clusters(data, 5, 6, 9)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    for r in got:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(1)
    x = rng.integers(-3000, 3000, (500, 7))
    x[0] = 100_000
    borders = [sorted(rng.integers(-2500, 2500, 15).tolist()) for _ in range(7)]
    cells = centroid_clusters.Cells(x.min(0).tolist(), x.max(0).tolist(), borders)
    centroids = rng.integers(-3000, 3000, (5, 7))
    least, greatest = centroid_clusters.intervals(cells.numbers(x), (x * x).sum(1), cells.tables(centroids))
    exact = centroid_clusters.distances(x, centroids)
    assert (exact == ((x[:, None] - centroids[None]) ** 2).sum(2)).all()
    assert (least <= exact).all() and (exact <= greatest).all()
    sure = centroid_clusters.certain_clusters(least, greatest)
    assert (sure >= 0).any() and (sure[sure >= 0] == exact.argmin(1)[sure >= 0]).all()


def test_few_vectors_are_fetched(spark, monkeypatch):
    """In groups that stand apart, the cells settle all rows but those of a group that two centroids share."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 64))
    data = [(i, [float(c) for c in centres[i % 8] + 0.1 * rng.normal(size=64)]) for i in range(800)]
    fetched = []
    real = centroid_clusters.small_side
    monkeypatch.setattr(centroid_clusters, "small_side", lambda df, size: (fetched.append(df.count()), real(df, size))[1])
    centroid_clusters.cluster_vectors(spark.createDataFrame(data, "vec_id long, embedding array<float>"))
    assert fetched and max(fetched) < 400


def test_clusters_on_messy_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 5, "x"), (2, None, 5, "x"), (3, [1.0], 5, "x"), (4, [nan, 1.0], 5, "x"), (5, [inf, 1.0], 5, "x"),
            (6, [None, 1.0], 5, "x"), (7, [], 5, "x"), (8, [1.0, 2.0, 3.0], 5, "x"), (9, [-0.0001, 0.0], 5, "x"),
            (9, [-0.0001, 0.0], 5, "x"), (None, [4.0, 4.0], None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, row string")
    got = centroid_clusters.cluster_vectors(df, dims=2)
    want, _ = plain_clusters([(r[0], r[1]) for r in rows], 8, 10, 2)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got.collect()), key=str) == want
    empty = centroid_clusters.cluster_vectors(df.limit(0), dims=2)
    assert empty.count() == 0 and empty.columns == got.columns
    with pytest.raises(PySparkException, match="not below"):
        centroid_clusters.cluster_vectors(spark.createDataFrame([(1, [1e30, 0.0])], df.select("vec_id", "embedding").schema), dims=2)


# ---------------------------------------------------------------- licence runs

def dice(a, b):
    return 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b))


def bigrams(words):
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


@pytest.mark.parametrize("template, threshold", [("a b c a b d", 0.8), ("a a b a a c a", 0.7), ("a b", 0.8), ("d c b a d c b a", 0.6)])
def test_licence_runs_against_all_runs(spark, template, threshold):
    """The nearest of all runs of a text, unless the whole text (its one unit) matches."""
    rng = random.Random(template)
    texts = [" ".join(rng.choice("aabbccde") for _ in range(rng.randint(2, 22))) for _ in range(700)]
    want = []
    of = bigrams(template.split())
    for text in texts:
        grams = bigrams(text.split())
        whole = dice(grams, of)
        runs = [dice(grams[i:j], of) for i in range(len(grams)) for j in range(i + 1, len(grams) + 1)]
        best = whole if whole >= threshold else max(runs)
        want.append([best] if best >= threshold else [])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [m.dice for m in r.licences] for r in
           licence_scan.scan_licences(docs, [("X", template)], threshold).collect()}
    assert sum(map(len, want)) > 15
    assert all(got[k] == pytest.approx(w) for k, w in enumerate(want))


def test_whole_licence_after_part_of_it(spark):
    bsd = next(t for n, t in licence_scan.TEMPLATES if n == "BSD-2-Clause")
    words = bsd.split()
    texts = [f"notes {' '.join(words[:k])} see the full text here {bsd} end of file {'word ' * 200}" for k in range(0, 70, 10)]
    rows = licence_scan.scan_licences(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert [[(m.licence, m.dice) for m in r.licences] for r in rows] == [[("BSD-2-Clause", 1.0)]] * len(texts)


def test_long_text_with_the_words_of_licences(spark):
    """Every word that opens the search, thousands of times, and one notice at the end."""
    words = licence_scan.needed_words(
        tuple(tuple(licence_scan.template_bigrams(t)) for _, t in licence_scan.TEMPLATES), licence_scan.THRESHOLD)
    text = " ".join(f"{w} of the software" for w in words * (30_000 // len(words))) + " Released under the MIT License and more words"
    rows = licence_scan.scan_licences(spark.createDataFrame([(text,)] * 3, "text string")).collect()
    assert [[(m.licence, m.dice) for m in r.licences] for r in rows] == [[("MIT", 1.0)]] * 3
