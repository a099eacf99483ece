"""Cases in which an operator once did less than its whole job."""

import random

import numpy as np
from pyspark.sql import functions as F

from isotherm.llm import licence_scan, token_files, toxicity, vector_join
from isotherm.llm.queries import VOCABULARY

TERMS = ["stupid", "garbage", "pathetic", "worthless", "disgusting", "contemptible", "moron"]
PLAIN = [a + b for a in ("river", "stone", "cloud", "lantern", "meadow", "copper") for b in ("bed", "path", "light", "field")]


def labelled_texts(rng, n=1200):
    """Clean texts, and a quarter with one of TERMS, some of them inflected."""
    rows = []
    for k in range(n):
        words = rng.choices(PLAIN, k=25)
        if k % 4 == 0:
            words[rng.randrange(25)] = rng.choice(TERMS) + rng.choice(["", "", "ly", "ness"])
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    return rows


def learned(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return toxicity.learn_toxicity(docs, labels)


def test_learned_terms_match_misspelled(spark):
    model = learned(spark, labelled_texts(random.Random(1)))
    for term in TERMS:
        hits = model.lexicon.look_up({term.encode()})
        assert hits[term.encode()][1] == 0
        # One letter replaced, left out or doubled within the first five.
        for word in (term[:2] + "0" + term[3:], term[:1] + term[2:], term[:3] + term[2:]):
            hit = model.lexicon.look_up({word.encode()}).get(word.encode())
            assert hit is not None and hit[1] == 1 and model.lexicon.terms[hit[0]] == term, (term, word)
    assert model.lexicon.look_up({b"d1sgust1ng"})[b"d1sgust1ng"][1] == 2
    assert model.score(b"riverbed w0rthless stonepath") > model.score(b"riverbed stonepath") + 0.1


def test_one_clean_near_word_does_not_switch_misspellings_off(spark):
    rows = labelled_texts(random.Random(2))
    # A clean word near a term, often; misspellings in toxic texts, one of them mislabelled.
    near = [(10_000 + k, f"{' '.join(random.Random(k).choices(PLAIN, k=25))} boron", 0) for k in range(20)]
    spelt = [(20_000 + k, f"{' '.join(random.Random(-k - 1).choices(PLAIN, k=25))} gerbage", int(k > 0)) for k in range(6)]
    once = [(30_000, f"{' '.join(random.Random('x').choices(PLAIN, k=25))} st0pid", 0)]
    model = learned(spark, rows + near + spelt + once)
    assert model.lexicon.clean == {b"boron"}
    assert set(model.lexicon.look_up({b"boron", b"mor0n", b"morron", b"gerbage", b"st0pid"})) == {
        b"mor0n", b"morron", b"gerbage", b"st0pid"}


GPL_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
BSD_3 = """Copyright (c) 2020, The Authors
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED."""
APACHE = next(t for n, t in licence_scan.TEMPLATES if n == "Apache-2.0" and len(t) > 200)


def test_licences_within_other_text(spark):
    code = "\n".join(f"x{k} = call_{k}(x{k - 1}, {k})" for k in range(60))
    texts = [
        (0, f"# main.py\n\n{GPL_3}\n\n{code}", {"GPL-3.0"}), (1, f"{BSD_3}\n\n{code}", {"BSD-3-Clause"}),
        (2, f"# Copyright 2020\n# {APACHE}\n{code}".replace("License. You", "License.\n# You"), {"Apache-2.0"}),
        (3, "A small tool for maps. Released under the MIT License. See the manual for more about it, and the site.", {"MIT"}),
        (4, f"{GPL_3}\n\n{GPL_3}\n\n{code}", {"GPL-3.0"}), (5, f"{code}\nthe software license of the text", set()),
        (6, "software", set()), (7, "", set())]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    got = {r.doc_id: {m.licence for m in r.licences} for r in licence_scan.scan_licences(docs).collect()}
    assert got == {k: want for k, _, want in texts}


def test_rows_of_one_id_are_not_one_task(spark):
    rows = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"),
                                    F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = token_files.encode_documents(rows, VOCABULARY).groupBy("part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in parts) == 4000
    assert max(r["count"] for r in parts) < 2000


def test_a_lexicon_of_any_size_is_kept_whole(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + "x" for a in letters[:18] for b in letters[:18] for c in letters[:18]]
    rows = [(1, " ".join(random.Random(k).sample(words, len(words)))) for k in range(40)]
    rows += [(0, " ".join(f"{random.Random(1000 * k + i).random():.9f}" for i in range(30))) for k in range(40)]
    found = toxicity.learn_lexicon(spark.createDataFrame(rows, "label int, text string"))
    assert len(words) == 5832 and set(words) <= set(found)


def test_vectors_of_doubles_are_compared_as_doubles(spark):
    # Cosines within 4e-8 of the threshold, on both sides, and of huge and tiny vectors; labels of text.
    rng, rows, links = np.random.default_rng(5), [], {}
    for k in range(20):
        a, b = np.linalg.qr(rng.standard_normal((16, 2)))[0].T
        side = 1 if k % 2 else -1
        t = 0.93 + side * 4e-8
        other = t * a + np.sqrt(1 - t * t) * b
        scale = (1.0, 1e200, 1e-200)[k % 3]
        rows += [(2 * k, (a * scale).tolist(), f"pair {k}"), (2 * k + 1, (other * 3).tolist(), f"pair {k}")]
        links[2 * k] = links[2 * k + 1] = int(side > 0)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert {r.vec_id: r.n_links for r in vector_join.near_vectors(df).collect()} == links
