"""Every operator over nulls, empty and long texts, repeated rows, empty tables and clashing names."""

import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from isotherm.llm import fm_index, licence_scan, maxent_lm, mixing, near_copies, quality, sharding, token_files, toxicity, vector_join
from isotherm.llm.common import bucket_of_id, columns_of
from isotherm.session import scratch_path
from tests.llm import messy

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return messy.messy_documents(spark).cache()


def test_sharding(spark, docs):
    rows = sharding.shard_documents(docs, shards=5).collect()
    assert len(rows) == len(messy.ROWS)
    places = sorted(r.slot * 5 + r.shard for r in rows)
    assert places == list(range(len(rows)))
    nulls = [r for r in rows if r.doc_id == 5]
    assert (nulls[0]["size"], nulls[0].text_crc32) == (8, 0)
    assert sharding.shard_documents(messy.empty_documents(spark)).count() == 0


def test_licences(spark, docs):
    rows = licence_scan.scan_licences(docs).collect()
    assert len(rows) == len(messy.ROWS) and all(r.licences == [] for r in rows)
    assert licence_scan.scan_licences(messy.empty_documents(spark)).count() == 0
    mit = next(t for n, t in licence_scan.TEMPLATES if n == "MIT" and t.startswith("Permission"))
    texts = [
        "Some words.\n  RELEASED under the (MIT) license!!\nReleased under the MIT License.\nmore",  # equal units
        "before\n\n" + mit.replace("Software", "program") + "\n\nafter",  # a paragraph of several lines, changed
        "This work is licensed under the GNU General Public License, version 2.",  # nearer to 2 than to 3
        mit.replace(" ", "\n"),  # the whole text
    ]
    rows = licence_scan.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    found = {r.doc_id: [(m.licence, round(m.dice, 2)) for m in r.licences] for r in rows}
    assert found[0] == [("MIT", 1.0)] and found[2] == [("GPL-2.0", 1.0)] and found[3] == [("MIT", 1.0)]
    # The paragraph, and the whole text with two more words.
    assert [n for n, _ in found[1]] == ["MIT", "MIT"] and all(0.8 <= d < 1 for _, d in found[1])
    repeated = licence_scan.scan_licences(
        spark.createDataFrame([("a a a a b",), ("a a b",)], "text string"), [("X", "a a a a b")], 0.6).collect()
    assert [[m.dice for m in r.licences] for r in repeated] == [[1.0], [2 * 2 / 6]]
    with pytest.raises(ValueError):
        licence_scan.licence_matches("text", [("X", "y" * (licence_scan.TEMPLATE_BYTES + 1))])


def test_mixing(spark, docs):
    rows = mixing.mix_report(docs).collect()
    assert len(rows) == len(messy.ROWS)
    size = {r.doc_id: r["size"] for r in rows if r.doc_id is not None}
    assert size[5] == size[4] == size[8] == 0 and size[9] == 6 and size[6] == 40_000
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    same = [r.taken for r in rows if r.doc_id == 9]
    assert same[0] == same[1]
    assert mixing.mix_report(messy.empty_documents(spark)).count() == 0
    mixed = mixing.mix_rows(docs)
    assert mixed.columns == docs.columns
    copies = sum(r.copies for r in rows)
    assert mixed.count() == copies


def test_mixing_without_words(spark):
    rows = mixing.mix_report(spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string"))
    assert [(r.target, r.taken) for r in rows.collect()] == [(0.0, 0), (0.0, 0)]


def test_token_files(spark, docs):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs, path, VOCABULARY)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert len(rows) == len(messy.ROWS)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in messy.ROWS), key=lambda i: -1 if i is None else i)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 1
        at += r.n_tokens
    assert all(r.ids == [1] for r in rows if r.doc_id in (4, 5, 8))
    empty = scratch_path(spark, "test-no-tokens")
    token_files.write_tokens(messy.empty_documents(spark), empty, VOCABULARY)
    assert token_files.token_digest(token_files.read_tokens(spark, empty)).count() == 0


def test_leaks(spark, docs):
    found = fm_index.find_leaks(docs, messy.benchmark(spark)).collect()
    assert len(found) == len(messy.ROWS)
    by_id = {r.doc_id: r.leaks for r in found if r.doc_id is not None}
    assert by_id[5].n_words == by_id[4].n_words == by_id[8].n_words == 0
    assert [(s.start, s.end) for s in by_id[1].spans] == [(2, 13)] and by_id[1]["items"] == ["1"]
    # An item of fewer words than the window is one phrase; ids in order of their text.
    assert by_id[7]["items"] == ["12", "4"]
    # An item without an id marks words and is not listed.
    assert by_id[6].spans and by_id[6]["items"] == []
    assert fm_index.find_leaks(messy.empty_documents(spark), messy.benchmark(spark)).count() == 0
    none = fm_index.find_leaks(docs, messy.benchmark(spark).limit(0))
    assert none.filter(F.size("leaks.spans") > 0).count() == 0
    clean = fm_index.drop_contaminated(docs, messy.benchmark(spark))
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {4, 5, 8, 9, 10, None}


def test_leaks_in_blocks(spark, docs, monkeypatch):
    whole = fm_index.find_leaks(docs, messy.benchmark(spark)).select("doc_id", "leaks").collect()
    monkeypatch.setattr(fm_index, "BROADCAST_BYTES", 8)
    parts = fm_index.find_leaks(docs, messy.benchmark(spark)).select("doc_id", "leaks").collect()
    key = lambda rows: sorted((str(r.doc_id), str(r.leaks)) for r in rows)
    assert key(whole) == key(parts)


def test_near_copies(spark, docs):
    rows = near_copies.near_copies(docs).collect()
    assert len(rows) == sum(r[0] is not None for r in messy.ROWS)
    classes = {r.doc_id: r.class_id for r in rows}
    assert classes[1] == classes[2] == classes[3] == 1
    assert classes[4] == classes[5] == 4  # null and empty texts are equal
    assert classes[9] == 9 and classes[6] == 6 and classes[7] == 7
    assert near_copies.near_copies(messy.empty_documents(spark)).count() == 0
    kept = near_copies.one_of_each_class(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 6, 7, 8, 9, 10]
    assert ids.count(None) == 2


def test_language_model(spark, docs):
    rows = maxent_lm.score_documents(docs, bucket_of_id("doc_id", 5) == 1).collect()
    assert len(rows) == len(messy.ROWS)
    empties = [r for r in rows if r.doc_id in (4, 5, 8)]
    assert all(r.n_tokens == 1 for r in empties) and len({r.base_score for r in empties}) == 1
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 9}) == 1
    assert maxent_lm.score_documents(messy.empty_documents(spark), F.lit(False)).count() == 0
    untrained = maxent_lm.score_documents(docs, F.lit(True)).collect()
    assert all(r.base_score == 0 and r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in untrained)


@pytest.mark.parametrize("learn, score, label", [
    (quality.learn_quality, quality.quality_score, "quality"),
    (toxicity.learn_toxicity, toxicity.toxicity_score, "toxic"),
])
def test_classifiers(spark, docs, learn, score, label):
    for marks in (messy.labels(spark), messy.labels(spark).limit(0), messy.labels(spark).filter(f"{label} = 1")):
        model = learn(docs, marks)
        rows = docs.select(*columns_of(docs), score(model).alias("s")).collect()
        assert len(rows) == len(messy.ROWS)
        assert all(0.0 <= r.s <= 1.0 for r in rows)
        assert len({r.s for r in rows if r.doc_id in (1, 2, None) and r.text}) == 1
        assert len({r.s for r in rows if not r.text}) == 1
        assert messy.empty_documents(spark).select(score(model)).count() == 0
    assert 0.0 <= learn(messy.empty_documents(spark), messy.labels(spark)) .score(
        np.zeros((1, len(quality.FEATURES))) if label == "quality" else b"") <= 1.0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    e = [1.0] + [0.0] * 8
    rows = [
        (1, e, 1, "x"), (2, e, 1, "x"), (3, [2.0] + [0.0] * 8, 1, "x"), (4, e, 2, "x"), (5, e, None, None),
        (6, None, 1, "x"), (7, [0.0] * 9, 1, "x"), (8, [nan] + [0.0] * 8, 1, "x"), (9, [inf] + [1.0] * 8, 1, "x"),
        (10, [None] + [1.0] * 8, 1, "x"), (11, [], 1, "x"), (12, [1.0, 0.0], 1, "x"), (None, e, 1, "x"),
        (13, [1.0, 0.3] + [0.0] * 7, 1, "x"), (13, [1.0, 0.3] + [0.0] * 7, 1, "x"), (14, [-1.0] + [0.0] * 8, 1, "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_join.near_vectors(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 13: (3, 1), **{i: (0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 14)}}
    assert vector_join.near_vectors(df.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    messy.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    messy.benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (docs, messy.empty_documents(spark)):
        rows = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, str(tmp_path))
            assert sorted(rows.columns) == sorted(docs.columns), name
        last = corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path))
        assert last.count() == rows.count()


def test_held_out_bucket(spark):
    ids = [0, 1, 17, -5, None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", bucket_of_id("doc_id", 5).alias("k"))
    for r in got.collect():
        assert r.k == zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5
