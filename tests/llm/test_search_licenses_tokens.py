"""Top-k search, license scans and token counts."""

import random
import re

import duckdb
import helpers as H
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratafile.llm import edit_counts, licenses, topk
from stratafile.llm.sql import ORACLES
from stratafile.llm.tokens import vocabulary

VECTORS = "vec_id long, embedding array<float>, label int"


def best(rows, k=5):
    good = [(i, [int(np.floor(256 * float(x))) for x in map(np.float64, v)]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out, seen = [], set()
    for i, q in good:
        if i % 50 or i in seen:
            continue
        seen.add(i)
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return H.counted(out)


@pytest.mark.parametrize("case", ["even", "one dominant", "ties", "lengths"])
def test_top_k_equals_brute_force(spark, monkeypatch, case):
    monkeypatch.setattr(topk, "SHARD_VECTORS", 64)
    rng = np.random.default_rng(len(case))
    x = rng.normal(0, 0.2, (300, 12)).astype(np.float32)
    if case == "one dominant":
        x[:, 3] *= 20
    if case == "ties":
        x = np.round(x * 4) / 4
    rows = [(k, v.tolist()[: 12 - 5 * (case == "lengths" and k % 3 == 0)], 0) for k, v in enumerate(x)]
    rows += [(None, x[0].tolist(), 0), (400, None, 0), (401, [None] * 12, 0), (402, [float("nan")] * 12, 0), (450, [float("inf")] * 12, 0), (500, [0.0] * 12, 1), (299, x[5].tolist(), 1)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert H.counted(topk.top_k_report(df).collect()) == best([(i, v) for i, v, _ in rows])


def test_each_row_of_a_repeated_id_is_a_query(spark):
    """Equal and other vectors under one query id, and vectors without components: what the SQL twin gives."""
    rng = np.random.default_rng(3)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(rng.normal(0, 0.2, (60, 4)).astype(np.float32))]
    rows += [(50, [0.5, -0.25, 0.0, 1.0], 0), (0, rows[0][1], 0), (0, rows[0][1], 0), (100, [], 0), (7, [], 0), (8, [], 0), (150, [], 0)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = []
    for query in {i for i, _, _ in rows if i % 50 == 0}:
        pairs = [(-sum(np.floor(256 * a) * np.floor(256 * b) for a, b in zip(map(float, q), map(float, v), strict=True)), j)
                 for i, q, _ in rows if i == query for j, v, _ in rows if j != query and len(v) == len(q)]
        want += [(query, r + 1, j, int(-s)) for r, (s, j) in enumerate(sorted(pairs)[:5])]
    assert H.counted(topk.top_k_report(df).collect()) == H.counted(want)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    assert H.counted(con.execute(ORACLES["op3_top_k"]).fetchall()) == H.counted(want)


def test_reading_stops_early_on_proof():
    """Vectors with one large component each: the answer is proven long before the last segment."""
    rng = np.random.default_rng(0)
    x = rng.integers(-3, 4, (2000, 16))
    x[np.arange(2000), rng.integers(0, 16, 2000)] += rng.integers(100, 2000, 2000)
    q = np.zeros((2, 16), np.int64)
    q[0, 3], q[1, 7] = 200, 150
    ids = np.arange(1, 2001)
    index = topk.build_segments(x)
    found = topk.search(ids, x, *index, np.array([0, 5000]), q)
    for j, query in enumerate((0, 5000)):
        order = sorted(range(2000), key=lambda i: (-int(x[i] @ q[j]), ids[i]))[:5]
        assert [f[1:] for f in found if f[0] == query] == [(ids[i], int(x[i] @ q[j])) for i in order]


def test_top_k_of_an_empty_table(spark):
    assert topk.top_k_report(spark.createDataFrame([], VECTORS)).count() == 0


TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def base_of(text):
    w = TOKEN.findall((text or "").translate(H.LOWER))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_license_base_equals_word_places(spark, docs, rows):
    rng = random.Random(8)
    bits = ["under the MIT license", "Apache License,\nVersion 2.0", "CC BY-NC 4.0", "cc by ncx", "xunder the mit license", "underé the mit license", "word", "mit", "GNU General Public License, version 3", "été"]
    texts = [(k, rng.choice([" ", "--", "\n"]).join(rng.choice(bits) for _ in range(rng.randrange(12)))) for k in range(100, 300)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(texts, "doc_id long, text string"))
    got = licenses.license_report(both).collect()
    want = H.counted((i, *base_of(t)) for i, t in [*[(r[0], r[1]) for r in rows], *texts])
    assert H.counted(tuple(r)[:6] for r in got) == want
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


@pytest.mark.parametrize(
    "text, labels",
    [
        ("licensed under the GNU Lesser General Public License, version 2.1", ["lgpl-2.1"]),
        ("licensed under the GNU General Public License, version 3.", ["gpl-3"]),
        ("SPDX-License-Identifier: BSD-3-Clause", ["bsd-3-clause"]),
        ("Creative Commons Attribution-NonCommercial-ShareAlike", ["cc-by-nc-sa"]),
        ("All rights reserved.", ["all-rights-reserved"]),
        ("mit der Lizenz und gnu und cc", []),
    ],
)
def test_rules_and_suppression(text, labels):
    assert sorted({d[4] for d in licenses.scanner().detections(text.lower())}) == labels


def test_prefilter_loses_no_detection():
    """Every rule on texts made of the rules' own words gives what the gated rules give."""
    scan, rng = licenses.scanner(), random.Random(3)
    assert len(scan.rules) > 300
    names = ["gnu lesser general public license version 3", "mozilla public license 2.0", "cc by sa 4.0", "new bsd license", "apache license, version 2.0", "copyright (c) 2020", "public domain", "spdx license identifier mpl 2 0", "licensed under the", "released under", "eclipse public license", "filler"]
    for _ in range(200):
        text = " ".join(rng.choice(names) for _ in range(rng.randrange(6)))
        everything = [(m.start(), m.end(), r.priority, r.confidence, r.label) for r in scan.rules for m in r.pattern.finditer(text)]
        assert scan.detections(text) == licenses.unsuppressed(everything)


@pytest.mark.parametrize(
    "text, label",
    [
        ("License: GPL-2.0", "gpl-2"), ("license: LGPL 2.1", "lgpl-2.1"), ("License: GFDL 1.3", "gfdl"), ("license is MPL-2.0", "mpl-2"),
        ("License: EPL-2.0", "epl-2"), ("License: AGPL-3.0", "agpl-3"), ("License: PSF-2.0", "python-2"), ("License: MS-PL", "ms-pl"),
        ("License: EUPL-1.2", "eupl-1.2"), ("License: BUSL-1.1", "bsl-1.1"), ("License: SSPL-1.0", "sspl-1"), ("under the Expat license", "mit"),
        ("Common Development and Distribution License", "cddl-1"), ("http://creativecommons.org/licenses/by/4.0", None),
    ],
)
def test_a_notice_alone_is_found(text, label):
    assert {d[4] for d in licenses.scanner().detections(text.lower())} == ({label} if label else set())


def sample(rng, parsed):
    """A text that a parsed pattern matches, but for what its assertions refuse."""
    out = ""
    for kind, value in parsed:
        if str(kind) == "LITERAL":
            out += chr(value)
        elif str(kind) == "IN":
            first, what = value[0]
            out += {"NEGATE": " ", "CATEGORY": "7"}.get(str(first)) or chr(what if str(first) == "LITERAL" else what[0])
        elif str(kind) == "BRANCH":
            out += sample(rng, rng.choice(value[1]))
        elif str(kind) == "SUBPATTERN":
            out += sample(rng, value[-1])
        elif str(kind) in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(sample(rng, value[2]) for _ in range(value[0] + rng.randrange(2 if value[1] > value[0] else 1)))
        else:
            assert str(kind) == "ASSERT_NOT"
    return out


def test_each_rule_finds_its_own_match_alone():
    scan, rng = licenses.scanner(), random.Random(5)
    for r in scan.rules:
        texts = {sample(rng, re._parser.parse(r.pattern.pattern)) for _ in range(6)}
        texts = {t for t in texts if r.pattern.search(t)}
        assert texts
        for text in texts:
            everything = [(m.start(), m.end(), x.priority, x.confidence, x.label) for x in scan.rules for m in x.pattern.finditer(text)]
            assert scan.detections(text) == licenses.unsuppressed(everything), text


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so"""
MIT_KEEP = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND'
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
 * conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
 * following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
 * the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_ADS = " 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by X."
BSD_NAME = " Neither the name of X nor the names of its contributors may be used to endorse or promote products."
BSD_END = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"
FEE = "Permission to use, copy, modify, and{} distribute this software for any purpose with or without fee is hereby granted"
GNU = "is free software; you can redistribute it and/or modify\n# it under the terms of the GNU {} General Public License as published by the Free Software Foundation; either version {} of the License"


@pytest.mark.parametrize(
    "text, labels",
    [
        (MIT + MIT_KEEP + AS_IS, {"mit"}),
        (MIT + ". " + AS_IS, {"mit-0"}),
        (MIT + MIT_KEEP + " Except as contained in this notice, the name of X shall not be used", {"x11"}),
        (MIT.replace("deal in", "deal with"), {"ncsa"}),
        (BSD + BSD_END, {"bsd-2-clause"}),
        (BSD + BSD_NAME + BSD_END, {"bsd-3-clause"}),
        (BSD + BSD_ADS + BSD_NAME + BSD_END, {"bsd-4-clause"}),
        (BSD[:120], {"bsd"}),
        (FEE.format("/or") + ", provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR", {"isc"}),
        (FEE.format("") + ", provided that the above copyright notice and this permission notice appear in all copies. " + AS_IS, {"curl"}),
        (FEE.format("/or") + ". " + AS_IS, {"0bsd"}),
        ("you may not use this file except in compliance with the License.\n// You may obtain a copy of the License at\n//\n// http://www.apache.org/licenses/LICENSE-2.0\n", {"apache-2"}),
        ("This program " + GNU.format("", 2), {"gpl-2"}),
        ("This program " + GNU.format("", 3), {"gpl-3"}),
        ("This library " + GNU.format("Lesser", "2.1"), {"lgpl-2.1"}),
        ("This program " + GNU.format("Affero", 3), {"agpl-3"}),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mpl-2"}),
        ("are made available under the terms of the Eclipse Public License v2.0 which", {"epl-2"}),
        ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", {"zlib"}),
        ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
        ("By exercising the rights, You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-ShareAlike 4.0 International Public License", {"cc-by-sa"}),
        ("Permission is hereby granted to enter. Redistribution of wealth and use of sources, free of charge to any person.", set()),
    ],
)
def test_wording_alone_is_found(text, labels):
    assert {d[4] for d in licenses.scanner().detections(text.lower())} == labels


def test_licenses_of_an_empty_table(no_docs):
    assert licenses.license_report(no_docs).count() == 0


@pytest.fixture(scope="module")
def counter():
    return edit_counts.counter(*vocabulary()[1:])


@pytest.mark.parametrize("seed", range(8))
def test_edited_counts_equal_counting_anew(counter, seed):
    rng = random.Random(seed)
    parts = ["a", " ", "  ", "\n", "\n\n", "'s", "'", "ll", "é", "1", "!!", " foo", "\t", " \n x", "中", " word" * 40]
    for _ in range(40):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(500)))
        tree = edit_counts.Tree(*counter.leaves(counter.pieces(text)))
        for _ in range(6):
            at, cut = rng.randrange(len(text) + 3), rng.choice([0, 0, 1, 3, 30, 900])
            put = rng.choice(["", "x", " ", "  \n", "'s", " word here", "y z " * 800])
            want = text[:at] + put + text[at + cut :]
            text, tree, _ = edit_counts.edited(counter, text, tree, at, cut, put)
            assert text == want and tree.chars == len(text)
            assert tree.tokens == len(counter.encoding.encode_ordinary(text))


def test_an_edit_encodes_only_its_surroundings(counter):
    text = H.prose(random.Random(1), 50_000)
    tree = edit_counts.Tree(*counter.leaves(counter.pieces(text)))
    _, tree, encoded = edit_counts.edited(counter, text, tree, 100_000, 10, "new words")
    assert encoded < 3000


def test_token_counts_of_awkward_rows(spark, docs, rows, no_docs, counter):
    got = edit_counts.apply_edits(edit_counts.build_trees(edit_counts.derived_edits(docs.select("doc_id", "text")))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_tokens == len(counter.encoding.encode_ordinary(r.text)) == sum(r.leaf_tokens) and r.n_chars == len(r.text)
    before = H.counted((r.doc_id, r.n_tokens_before) for r in got)
    assert before == H.counted((r[0], len(counter.encoding.encode_ordinary(r[1] or ""))) for r in rows)
    assert edit_counts.token_count_report(no_docs).count() == 0


def test_edits_from_a_table(spark, counter):
    docs = spark.createDataFrame([(1, "some text here"), (2, None)], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 2, 0, 4, "any"), (1, 1, 99, 5, " end"), (2, 1, 0, None, "put"), (2, 0, None, None, None)], "doc_id long, seq long, at long, cut long, put string")
    got = {r.doc_id: r.text for r in edit_counts.apply_edits(edit_counts.with_edits(edit_counts.build_trees(docs), edits)).collect()}
    assert got == {1: "any text here end", 2: "put"}


def test_pretokens_split_alike_on_every_character(counter):
    """The regular expression library splits as the encoder does."""
    for first in range(0, 0x30000, 64):
        text = "".join(f"a{c}b {c}1{c} .{c}\n{c}  {c}{c} x" for c in map(chr, range(first, first + 64)) if not 0xD800 <= ord(c) < 0xE000)
        assert sum(counter.leaves(counter.pieces(text))[1]) == len(counter.encoding.encode_ordinary(text)), hex(first)


def test_clashing_columns(docs):
    clashing = docs.withColumn("places", F.lit(1)).withColumn("n_words", F.lit(2)).withColumn("edits_", F.lit(3))
    assert licenses.license_report(clashing).count() == docs.count()
    assert edit_counts.token_count_report(clashing).count() == docs.count()
