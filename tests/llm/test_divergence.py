"""The source divergence audit against a direct computation with Python's integers."""

import random
import re
from collections import Counter, defaultdict

import helpers as H
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratafile.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """rows: (lang, source, text); the result's rows as a Counter."""
    counts, in_docs, by_lang = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(H.LOWER))
        counts[lang, source].update(found)
        in_docs[lang].update(set(found))
        by_lang[lang].add(source)
    out = []
    for lang, sources in by_lang.items():
        kept = [t for t, n in in_docs[lang].items() if n >= 3]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        of = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))

        def f(p, q):
            return (p - q) ** 2 // q

        for s in sources:
            pairs = [(sum(f(of[s][t], of[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(of[s][t], whole[t]), t) for t in kept if counts[lang, s][t] and of[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 200)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items[:most])]
    return Counter(out)


def audited(df):
    return H.counted(D.audit(df).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(rng, n=160, sources=7):
    words = ["alpha", "Beta", "été", "ÉTÉ", "x", "don't", "a1b2", "ß", "語", *(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(260))]
    rows = []
    for i in range(n):
        k = int(sources * rng.random() ** 2)
        own = words[k * 9 :] + words[:9]
        text = " ".join(own[int(len(own) * rng.random() ** 3)] for _ in range(rng.randrange(1, 90)))
        rows.append((rng.choice(["en", "en", "de"]), f"s{k}", text))
    return rows


def test_rows_equal_brute_force(spark):
    rows = corpus(random.Random(4))
    rows += [(None, None, None), ("", None, "x"), (None, "", "x x"), ("", "", "x"), ("", "b", None), ("en", "empty", ""), ("fr", "a", "one"), ("fr", "b", "one two"), ("alone", "a", "b b b")]
    rows += [rows[0]] * 5
    df = spark.createDataFrame([(i, t, la, s, 1) for i, (la, s, t) in enumerate(rows)], DOCS).repartition(4)
    want = brute(rows)
    assert any(r[2] == "term" and r[5] == 200 for r in want) or max(r[5] for r in want) > 50
    assert audited(df) == want


def test_small_rounds_and_flushes_change_nothing(spark, monkeypatch):
    rows = corpus(random.Random(8), 90)
    df = spark.createDataFrame([(i, t, la, s, 1) for i, (la, s, t) in enumerate(rows)], DOCS).repartition(3)
    want = brute(rows)
    made = [(("en", "s", "a b c d"),), (("en", "s", "a"), ("de", "t", "a b"))]
    for one in made:  # counting in small pieces, in this process
        import pyarrow as pa

        monkeypatch.setattr(D, "HELD", 2)
        monkeypatch.setattr(D, "SEGMENT", 3)
        batch = pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*one, strict=True)], ["lang", "source", "text"])
        sums = Counter()
        for part in D._count(iter([batch])):
            for r in part.to_pylist():
                sums[r["lang"], r["source"], r["term"]] += r["n"]
        assert +sums == Counter((la, s, t) for la, s, text in one for t in text.split())
    monkeypatch.undo()
    assert audited(df) == want


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_corrections_by_rounds(monkeypatch, size):
    """Whole terms stay together whatever the batches are; the sums equal those of all pairs of postings."""
    import pyarrow as pa

    monkeypatch.setattr(D, "ROUND", size)
    rng = random.Random(2)
    peers, rows = 6, []
    for lang in ("a", "b"):
        for t in range(40):
            rows += [(lang, f"t{t:02d}", g, rng.randrange(20, 10**9), 3 + g, peers) for g in rng.sample(range(peers), rng.randrange(1, peers))]
    names = ["lang", "term", "g", "p", "z", "peers"]
    types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    got = Counter()
    for batch in D._corrections(iter(table.to_batches(max_chunksize=5))):
        for r in batch.to_pylist():
            got[r["lang"], r["g"], r["h"]] += r["value"]

    def f(p, q):
        return (p - q) ** 2 // q

    want = Counter()
    for a in rows:
        for b in rows:
            if a[:2] == b[:2] and a[2] != b[2]:
                want[a[0], a[2], b[2]] += f(a[3], b[3]) - f(a[3], b[4]) - f(a[4], b[3]) + f(a[4], b[4])
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_no_pair_of_postings_leaves_a_task():
    """A task's output is one place for each two groups, however many terms they share."""
    import pyarrow as pa

    terms, peers = 500, 8
    rows = [("en", f"t{t:04d}", g, 1000 + t + g, 5, peers) for t in range(terms) for g in range(peers)]
    types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["lang", "term", "g", "p", "z", "peers"])
    out = sum(b.num_rows for b in D._corrections(iter(table.to_batches(max_chunksize=100))))
    assert out <= peers * (peers - 1)


def test_counts_beyond_a_double(spark):
    """Shares of counts of 10^13 and more are still exact."""
    n = [(10**13 + 7, 3 * 10**13 + 1), (0, 10**9), (9_223_372_036, 9_223_372_037 * 5)]
    got = spark.createDataFrame(n, "c long, total long").select("c", "total", D.share(F.col("c"), F.col("total")).alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (c + 1) // t for c, t in n]
    p, q = np.int64(10**9), np.int64(1)
    assert int(D._f(p, q)) == (10**9 - 1) ** 2


def test_awkward_tables(spark, docs, rows, no_docs):
    given = [(r[2], r[3], r[1]) for r in rows]
    assert audited(docs.withColumn("term", F.lit("clash")).withColumn("g", F.lit(1)).withColumn("value", F.lit(2))) == brute(given)
    assert D.audit(no_docs).collect() == []
