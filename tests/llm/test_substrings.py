"""Substring dedup against all windows."""

import hashlib
import random

import helpers as H
import numpy as np
from pyspark.sql import functions as F

from stratafile.llm import substrings, tables


def expected(rows):
    gone = H.removed_words([(r[0], r[1]) for r in rows])
    out = []
    for k, (doc_id, text, *_) in enumerate(rows):
        w = H.words(text)
        kept = " ".join(x for p, x in enumerate(w) if p not in gone[k])
        out.append((doc_id, len(w), len(gone[k]), hashlib.sha256(kept.encode()).hexdigest()))
    return H.counted(out)


def test_awkward_rows_equal_all_windows(spark, rows):
    df = spark.createDataFrame(rows, H.DOCS).coalesce(1)  # one chunk: rows of one doc_id keep their order
    assert H.counted(substrings.substring_report(df).collect()) == expected(rows)


def test_many_chunks_and_partitions(spark):
    rng = random.Random(9)
    shared = [H.prose(rng, n, 9999) for n in (19, 20, 25, 60, 200)]
    rows = []
    for k in range(150):
        parts = [H.prose(rng, rng.randrange(0, 60), 9999)]
        for _ in range(rng.randrange(3)):
            text = rng.choice(shared).split()
            a = rng.randrange(len(text))
            parts += [" ".join(text[a:] if rng.random() < 0.4 else text), H.prose(rng, rng.randrange(30), 9999)]
        rows.append((1000 - k, "\n".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, before, gone = substrings.dedup_substrings(df, chunk_bytes=2000)
    removed = H.removed_words(rows)
    want = {r[0]: (len(H.words(r[1])), len(removed[k]), [x for p, x in enumerate(H.words(r[1])) if p not in removed[k]]) for k, r in enumerate(rows)}
    for r in got.collect():
        assert (r[before], r[gone], H.words(r["text"])) == want[r["doc_id"]]
    assert sum(v[1] for v in want.values()) > 500


def test_columns_stay_and_names_do_not_clash(docs):
    clashing = docs.withColumn("_chunk", F.lit(7)).withColumn("chunk", F.lit("c")).withColumn("hashes", F.lit(1)).withColumn("range", F.lit(2))
    out = substrings.without_repeats(clashing)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    assert out.where("_chunk <> 7 or chunk <> 'c'").count() == 0


def test_untouched_texts_stay_as_they_are(spark):
    text = "two  blanks\nand lines\t" + H.prose(random.Random(2), 40)
    assert substrings.without_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text == text


def test_empty_table(no_docs):
    assert substrings.substring_report(no_docs).count() == 0


def test_packed_hashes_come_back():
    rng = np.random.default_rng(4)
    for n in (1, 2, 1000):
        values = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        assert (substrings.unpack_sorted(substrings.pack_sorted(values)) == values).all()


def test_plan_numbers_up_to_100_terabytes():
    """What a chunk sends to a range stays worth a row, tasks grow with the root, and Spark accepts the buckets."""
    for size in (0, 10**6, 10**9, 50 * 10**9, 10**12, 10**13, 10**14):
        chunk, ranges, bits = substrings.plan_numbers(size)
        words, chunks = size // substrings.WORD_BYTES, size // chunk + 1
        per_row = min(chunk, size) / substrings.WORD_BYTES / ranges
        assert per_row >= (300 if size > 10**13 else 900) or size < 2 * 10**9
        assert words / ranges <= 1.4e8 and chunk <= 256 << 20 and 24 <= bits <= 62
        assert min(chunks, tables.MOST_BUCKETS) <= 100_000
    assert substrings.plan_numbers(10**14)[1] < 2 * 10 * substrings.plan_numbers(10**12)[1]


def test_many_chunks_a_bucket(spark, monkeypatch):
    """With fewer buckets than chunks the result is the same, and dropping the stored tables leaves no file behind."""
    monkeypatch.setattr(tables, "MOST_BUCKETS", 2)
    rng = random.Random(3)
    passage = H.prose(rng, 40, 9999)
    rows = [(k, H.prose(rng, 30, 9999) + " " + passage) for k in range(40)]
    with tables.scope("test"):
        got, _, gone = substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), chunk_bytes=300)
        assert sorted((r.doc_id, r[gone]) for r in got.collect()) == [(0, 0)] + [(k, 40) for k in range(1, 40)]
        assert tables.drop_stored(spark, "test") > 1
