"""Quality rules, mixing and packing."""

import hashlib
import random
import zlib

import helpers as H
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratafile.llm import mixing, packing, quality_rules, substrings
from stratafile.llm.tokens import encoder, vocabulary


def rule_measures(text):
    w = H.words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {p for i, x in enumerate(windows) if windows.count(x) > 1 for p in range(i, i + 5)} if len(w) < 2000 else set()
    lines = [x for x in (text or "").split("\n") if H.words(x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_measures_of_awkward_rows(docs, rows):
    got = H.counted(tuple(r)[:6] for r in quality_rules.quality_report(docs).collect())
    assert got == H.counted((r[0], *rule_measures(r[1])) for r in rows)


@pytest.mark.parametrize("end", ["\x85", "\u2028", "\u2029"])
def test_a_line_end_of_unicode_is_a_last_word(spark, end):
    texts = [f"foo {end}", f"one two  {end}", f" {end}", f"foo{end}", f"foo {end} \n", f"{end} foo"]
    df = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in enumerate(texts)], H.DOCS)
    want = {k: len(H.words(t)) for k, t in enumerate(texts)}
    assert {r.doc_id: r.n_words for r in quality_rules.quality_report(df).collect()} == want
    assert {r.doc_id: r.size for r in mixing.mixing_report(df).collect()} == want
    kept = {k: hashlib.sha256(" ".join(H.words(t)).encode()).hexdigest() for k, t in enumerate(texts)}
    assert {r.doc_id: r.kept_sha256 for r in substrings.substring_report(df).collect()} == kept


def test_base_rule_and_host_strictness(spark):
    clean, symbols = H.prose(random.Random(1), 50, 9999), " ".join(f"w{k}" + "#" * (k % 4 == 0) for k in range(50))
    rows = [(k, "few words", None, "bad", None) for k in range(60)] + [(100, clean, None, "bad", None), (101, symbols, None, "bad", None)]
    rows += [(200 + k, clean + f" {k}", None, "good", None) for k in range(60)] + [(300, symbols, None, "good", None), (301, None, None, None, None)]
    got = {r.doc_id: r for r in quality_rules.quality_report(spark.createDataFrame(rows, H.DOCS)).collect()}
    assert got[0].base_failed and not got[0].kept and got[301].base_failed
    assert got[100].kept and all(got[200 + k].kept for k in range(60))  # a bad host's clean documents stay
    assert got[300].kept and not got[101].kept  # what fails one soft rule goes only from a bad host


def test_rules_empty_table_and_clashing_names(no_docs, docs):
    assert quality_rules.quality_report(no_docs).count() == 0
    clashing = docs.withColumn("_quality", F.lit(1)).withColumn("_kept", F.lit("k")).withColumn("_host", F.lit(2)).withColumn("_words", F.lit(3))
    out = quality_rules.keep_good(clashing)
    assert out.columns == clashing.columns and out.count() == quality_rules.keep_good(docs).count()


def test_no_python_in_the_rules(docs):
    plan = quality_rules.keep_good(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def water_targets(sizes, weights=(1, 2, 3), epochs=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(epochs * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * level > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


@pytest.mark.parametrize("seed", range(3))
def test_mixture_meets_its_targets(spark, seed):
    rng = random.Random(seed)
    rows = [(k, H.prose(rng, rng.randrange(40)), None, rng.choice(["a", "b", "b", "b", "b", "B", "é", "z", None, f"s{k % 9}"]), 1) for k in range(300)]
    df = spark.createDataFrame(rows, H.DOCS)
    got = mixing.mixing_report(df).collect()
    source = {r[0]: r[3] for r in rows}
    sizes, taken = {}, {}
    for r in got:
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    target = water_targets(sizes)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert taken[s] == int(r.target + 1e-6)
    assert H.counted(got) == H.counted(mixing.mixing_report(df.repartition(7)).collect())
    copies = mixing.mixed_documents(df)
    assert copies.columns == df.columns
    assert sum(len(H.words(r.text)) for r in copies.collect()) == sum(taken.values())


def test_mixture_of_awkward_rows(docs, rows, no_docs):
    got = mixing.mixing_report(docs).collect()
    assert H.counted((r.doc_id, r["size"]) for r in got) == H.counted((r[0], len(H.words(r[1]))) for r in rows)
    assert mixing.mixing_report(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    empty = docs.withColumn("text", F.lit(None).cast("string"))
    assert {r.taken for r in mixing.mixing_report(empty).collect()} == {0}
    clashing = docs.withColumn("_mix", F.lit(1)).withColumn("_size", F.lit(2)).withColumn("_source", F.lit(3))
    assert mixing.mixed_documents(clashing).columns == clashing.columns


def reference_ids():
    path = vocabulary()[0]
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check_pieces(pieces, texts):
    ids_of, sequences, covered = reference_ids(), {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        covered.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024 and end & (end - 1) == 0  # whole, or a power of two: no padding
    want = H.counted(p for i, t in texts for p in [(i, tuple(ids_of(t)))])
    for (i, ids), n in want.items():
        own = sorted((p for p in covered[i, len(ids)]), key=lambda p: p.start)
        assert sum(p.length for p in own) >= n * len(ids)
        for p in own:
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            if len([x for x in want if x[0] == i and len(x[1]) == len(ids)]) == 1:
                assert p.ids_crc32 == zlib.crc32(part)
    assert sum(p.length for p in pieces) == sum(n * len(ids) for (_, ids), n in want.items())


def test_packing_awkward_rows(docs, rows, no_docs):
    check_pieces(packing.packing_report(docs).collect(), [(r[0], r[1]) for r in rows])
    check_pieces(packing.pack_documents(docs, block_tokens=500).collect(), [(r[0], r[1]) for r in rows])
    assert packing.packing_report(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_every_sequence_is_full(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 300, 1023, 1024, 1025, rng.randrange(1, 4000)]) for _ in range(rng.randrange(80))]
    pieces = packing.pack(lengths)
    used = {}
    for _, _, n, s, offset in pieces:
        assert offset == used.get(s, 0)
        used[s] = offset + n
    assert sorted(used.values()) == sorted(packing.room_sizes(sum(lengths) // 1024 * 1024) + packing.room_sizes(sum(lengths) % 1024)) or all(
        n & (n - 1) == 0 for n in used.values()
    )
    assert sum(used.values()) == sum(lengths)


def test_costs_are_balanced():
    """Descending documents go to the sequence of lowest cost, so whole-length costs lie close together."""
    rng = random.Random(4)
    lengths = [rng.randrange(20, 400) for _ in range(600)]
    cost = {}
    for _, _, n, s, _ in packing.pack(lengths):
        cost[s] = cost.get(s, 0) + packing.cost(n)
    costs = sorted(cost.values())[12:]
    assert max(costs) / min(costs) < 1.5


@pytest.mark.parametrize("text", ["", " ", "<|endoftext|> and more<|endoftext|>", "a" * 50_000, "é中 \U0001f600   x\r\n", "don't  we'll"])
def test_encoder_gives_the_same_ids(text):
    assert encoder(vocabulary()).ids(text).tolist() + [0] == reference_ids()(text)
