"""The operators' parts and results against plain implementations."""

import math
import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isotherm.llm import (components, fm_index, maxent_lm, mixing, near_copies, quality, queries, sharding, token_files,
                          toxicity, vector_join)
from isotherm.llm.common import LOWER, bucket_of_id, table

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def connection(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rounded(rows):
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_oracle(spark, key):
    con = connection(SF)
    df = queries.QUERIES[key](spark, SF)
    cur = con.execute(queries.ORACLE_SQL[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rounded(cur.fetchall()) == rounded(tuple(r) for r in df.select(*names).collect())


def documents():
    return connection(SF).execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


# Sharding


@given(st.integers(1, 3000), st.integers(0, 10**9))
@settings(max_examples=40, deadline=None)
def test_feistel_is_a_permutation(n, seed):
    image = [sharding.permute(i, n, seed) for i in range(0, n, max(1, n // 50))]
    assert len(set(image)) == len(image) and all(0 <= p < n for p in image)
    assert [sharding.unpermute(p, n, seed) for p in image] == list(range(0, n, max(1, n // 50)))
    a, b = sharding.domain(n)
    assert n <= a * b < n + a


def test_feistel_column_equals_function(spark):
    for n in (1, 2, 7, 600, 1000):
        got = [r.p for r in spark.range(n).select(sharding.permuted("id", n, 5).alias("p")).collect()]
        assert got == [sharding.permute(i, n, 5) for i in range(n)]


def test_sharding_rows(spark):
    rows = sorted(queries.op2_sharding(spark, SF).collect())
    texts = dict(documents())
    n = len(rows)
    for i, r in enumerate(rows):
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.grown_shard) == (len(data) + 8, zlib.crc32(data), None)
        assert r.slot * 24 + r.shard == sharding.permute(i, n, 20240229)


# Mixing


def test_mix_meets_targets(spark):
    rows = queries.op6_mixing(spark, SF).collect()
    source = dict(connection(SF).execute("SELECT doc_id, source FROM documents").fetchall())
    by = {}
    for r in rows:
        by.setdefault(source[r.doc_id], []).append(r)
    for group in by.values():
        miss = abs(sum(r.taken for r in group) - group[0].target)
        assert miss <= max(r["size"] for r in group) / 2 + 1e-6
    assert math.isclose(sum(g[0].target for g in by.values()), 1.5 * sum(r["size"] for r in rows))


def test_targets_by_repeated_resharing(spark):
    sizes = [("a", 10), ("b", 500), ("c", 20), ("d", 300), (None, 5)]
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(sizes, "source string, size long")).collect()}
    weights = dict(zip([s for s, _ in sizes], [3, 1, 2, 3, 1]))
    left, target, open_ = 1.5 * sum(n for _, n in sizes), {}, dict(sizes)
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = [s for s in open_ if weights[s] * level > 2 * open_[s]]
        for s in full or list(open_):
            target[s] = 2.0 * open_.pop(s) if full else weights[s] * level
        if not full:
            break
        left = 1.5 * sum(n for _, n in sizes) - sum(target.values())
    assert {s: round(t, 6) for s, t in got.items()} == {s: round(t, 6) for s, t in target.items()}


# Token files


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = sorted(queries.op9_token_files(spark, SF).collect())
    start = 0
    for r, (doc_id, text) in zip(rows, documents(), strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert tuple(r) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pieces_encode_as_whole_texts():
    from tokenizers import Tokenizer

    whole, pieces = Tokenizer.from_file(VOCABULARY), token_files.PieceEncoder(VOCABULARY)
    rng = random.Random(3)
    letters = list("abzAZ09.,!?'’“éÉßẞİıσΣς́̀   \x1c\x85 \n\t<|>endoftext#½²中文अàöÿ÷ÀÖ×Þ")
    letters += ["<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'RE", "don't"]
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        assert pieces.encode(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids, text


# FM-index


@given(st.lists(st.integers(0, 3), max_size=120), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=5), max_size=12))
@settings(max_examples=150, deadline=None)
def test_fm_index_finds_every_occurrence(symbols, phrases):
    seq = np.array(symbols + [0], dtype=np.int64)
    index = fm_index.FMIndex(seq, 3)
    for phrase in phrases:
        row = np.array([phrase], dtype=np.int64)
        low, high = index.ranges(row, np.array([len(phrase)]))
        want = [i for i in range(len(symbols)) if symbols[i:i + len(phrase)] == phrase]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


@given(st.lists(st.integers(0, 6), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_wavelet_matrix(symbols):
    seq = np.array(symbols, dtype=np.int64)
    matrix = fm_index.WaveletMatrix(seq, 3)
    places = np.arange(len(seq) + 1)
    for c in range(7):
        got = matrix.rank(np.full(len(places), c), places)[0]
        assert got.tolist() == [symbols[:i].count(c) for i in places]
    read, before = matrix.access(np.arange(len(seq)))
    assert read.tolist() == symbols and before.tolist() == [symbols[:i].count(c) for i, c in enumerate(symbols)]


@given(st.lists(st.integers(0, 2), max_size=80))
@settings(max_examples=80, deadline=None)
def test_suffix_array(symbols):
    seq = symbols + [0]
    # Each separator differs from every other and sorts by position before all symbols.
    key = lambda i: [(0, j) if seq[j] == 0 else (1, seq[j]) for j in range(i, len(seq))]
    got = fm_index.suffix_array(np.array(seq, dtype=np.int64), 30)
    assert got.tolist() == sorted(range(len(seq)), key=key)


# Near copies


def plain_weights(texts):
    df = np.zeros(near_copies.WORD_BUCKETS)
    for t in texts:
        df[np.unique(near_copies.word_hashes(t) & np.uint64(near_copies.WORD_BUCKETS - 1)).astype(int)] += 1
    return near_copies.ShingleWeights(np.log1p(len(texts) / np.maximum(df, 1)).astype(np.float32))


def test_near_copies_against_all_pairs(spark):
    rows = [(i, t or "") for i, t in documents()]
    # Copies with a few words changed, and a chain of them.
    extra = []
    for k, (i, t) in enumerate(rows[:40]):
        words = t.split()
        for step in (1, 2):
            words = [w if j % 97 != step else w + "x" for j, w in enumerate(words)]
            extra.append((10_000 + 2 * k + step, " ".join(words)))
    rows += extra
    got = {r.doc_id: r.class_id for r in near_copies.near_copies(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = [t.encode() for _, t in rows]
    weights = plain_weights(texts)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shingled = [weights.shingles(t) for t in texts]
    close = 0
    for a in range(len(rows)):
        for b in range(a):
            if texts[a] == texts[b] or (len(np.intersect1d(shingled[a][0], shingled[b][0])) and
                                        weights.similarity(texts[a], texts[b]) >= near_copies.THRESHOLD):
                close += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert close > 40
    want = {}
    for k, (i, _) in enumerate(rows):
        want[i] = min(j for m, (j, _) in enumerate(rows) if root(m) == root(k))
    assert got == want


def test_samples_agree_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        hits = total = 0
        for _ in range(60):
            h = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
            w = rng.uniform(0.5, 9.0, 300).astype(np.float32)
            v = np.where(rng.random(300) < share, w, w * rng.uniform(0.1, 1.0, 300)).astype(np.float32)
            hits += (near_copies.weighted_samples(h, w) == near_copies.weighted_samples(h, v)).sum()
            total += near_copies.SAMPLES * (np.minimum(w, v).sum() / np.maximum(w, v).sum())
        assert abs(hits - total) / (60 * near_copies.SAMPLES) < 0.03


# Components and vectors


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    low = {n: n for e in edges for n in e}
    for _ in range(len(low)):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == {n: c for n, c in low.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "CHUNK", 16)  # several chunks a cell
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((12, 24))
    x = np.vstack([c + rng.standard_normal((20, 24)) * s for c, s in zip(centre, np.linspace(0.02, 0.6, 12))]).astype("f4")
    x = np.vstack([x, x[:15]])
    label = np.arange(len(x)) % 2
    rows = [(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(x, label))]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_join.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (label[:, None] == label[None])
    low = np.arange(len(x))
    for _ in range(len(x)):
        low = np.where(near, low[None], len(x)).min(1)
    assert got == {i: (int(near[i].sum()) - 1, int(low[i])) for i in range(len(x))}


# Language model


def test_language_model_counts_and_base(spark):
    rows = sorted(queries.op1_maxent_lm(spark, SF).collect())
    tokens = [(t or "").encode().translate(LOWER).split() + [None] for _, t in documents()]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in documents()]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    for r, t, h in zip(rows, tokens, held, strict=True):
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, len(t), sum(counts[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held_rows = [r for r in rows if r.held_out]
    assert sum(r.score for r in held_rows) > sum(r.base_score for r in held_rows)


def test_chances_sum_to_one(spark):
    docs = table(spark, SF, "documents").limit(60)
    chunks = maxent_lm.encode_chunks(docs, bucket_of_id("doc_id", 5) == 1)
    vocabulary, answers = maxent_lm.count_words(chunks)
    model = maxent_lm.train(chunks, vocabulary)
    row = chunks.first()
    hashes = np.frombuffer(row["hashes"], "<u8")
    counts = maxent_lm.unpacked(row["counts"], "<u4")
    context = np.repeat(hashes[5], 3)
    seen = hashes[counts > 0]
    unknown = np.arange(8, dtype=np.uint64) + np.uint64(1 << 40)  # an unknown word of each shape
    total = 0.0
    for group, c in ((seen, counts[counts > 0]), (unknown, np.zeros(8, dtype=np.int64))):
        for k in range(len(group)):
            h = np.concatenate([context, group[k:k + 1]])
            n = np.array([1, 1, 1, c[k]])
            total += math.exp(maxent_lm.log_chances(model, vocabulary, h, n, np.arange(4), np.array([4]))[-1])
    assert chunks.count() == 1 and math.isclose(total, 1.0, abs_tol=1e-3)


def test_spans_do_not_change_features(monkeypatch):
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 2**63, 50).astype(np.uint64)
    lengths = np.array([1, 7, 2, 30, 11, 1, 1, 40])
    tokens = rng.integers(0, 50, lengths.sum())
    whole = maxent_lm.context_hashes(hashes[tokens], lengths)
    for start in range(len(tokens) - 1):
        for end in (start + 1, start + 9, len(tokens)):
            part, before = maxent_lm._texts_within(lengths, start, min(end, len(tokens)))
            got = maxent_lm.context_hashes(hashes[tokens[start:end]], part, before)
            # From the fourth token of a span on, the context is whole.
            assert (got[3:] == whole[start:end][3:]).all()
            if start == 0 or start in np.cumsum(lengths):
                assert (got == whole[start:end]).all()


# Classifiers


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@given(st.lists(st.text("abc", min_size=1, max_size=11), min_size=1, max_size=6), st.lists(st.text("abcd", max_size=12), max_size=20))
@settings(max_examples=120, deadline=None)
def test_automaton_against_edit_distance(terms, words):
    automaton = toxicity.LexiconAutomaton(terms)
    for word in words:
        want = [edits(word, t) for t in terms if edits(word, t) <= toxicity.allowed_edits(t)]
        got = automaton.match(word)
        assert (got is None) == (not want)
        if got:
            assert got[1] == min(want) == edits(word, terms[got[0]])


def test_beginnings_match_without_edits():
    automaton = toxicity.LexiconAutomaton(["badst*", "wicked"])
    assert automaton.match("badstuff") == (0, 0) and automaton.match("badst") == (0, 0)
    assert automaton.match("bedstuff") is None and automaton.match("wicket") == (1, 1)


def test_quotation_counts_apart():
    lexicon = toxicity.Lexicon(["moron", "idiot"], [True, True])
    names = toxicity.FEATURES
    free = dict(zip(names, toxicity.context_features(b"you are a moron and an idoit", lexicon)))
    said = dict(zip(names, toxicity.context_features('He said "you moron" to them, and «idiot».'.encode(), lexicon)))
    assert free["unquoted"] > 0 and free["quoted"] == 0 and free["misspelled"] == 0
    assert said["quoted"] == math.log1p(2) and said["unquoted"] == 0
    assert dict(zip(names, toxicity.context_features(b"a mor0n", lexicon)))["misspelled"] > 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no sf0.1")
def test_held_out_accuracy(spark):
    con = connection("/root/testdata/sf0.1")
    for query, label, least in ((queries.op3_quality, "quality", 0.98), (queries.op10_toxicity, "toxic", 0.93)):
        truth = dict(con.execute(f"SELECT doc_id, {label} FROM labels").fetchall())
        rows = [r for r in query(spark, "/root/testdata/sf0.1").collect() if r.held_out and r.doc_id in truth]
        right = sum(r.predicted == truth[r.doc_id] for r in rows) / len(rows)
        assert right >= least, (label, right)


def test_pairs_rank_the_better_document():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 5))
    label = (x[:, 0] - 2 * x[:, 1] > 0).astype(int)
    w = quality.fit_pairs(x, np.flatnonzero(label == 1), np.flatnonzero(label == 0), 5000)
    assert ((x @ w > quality.quantile_threshold(x @ w, label)) == label).mean() > 0.97


def test_remote_names_are_not_opened(spark):
    """Tables are read by Spark only, whatever the store."""
    for name in os.listdir(os.path.dirname(queries.__file__)):
        if name.endswith(".py"):
            with open(os.path.join(os.path.dirname(queries.__file__), name)) as f:
                assert " open(" not in f.read(), name
