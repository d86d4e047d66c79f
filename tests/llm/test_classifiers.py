"""Held-out accuracy, gradients and awkward rows of the two classifiers."""

import random
import zlib

import helpers as H
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratafile.llm import byte_cnn, labelled, toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(seed, n=700):
    """Junk is symbols or shouting; toxic is an insult beside a group, either alone is not."""
    rng, rows, labels = random.Random(seed), [], []
    for k in range(n):
        w = H.prose(rng, rng.randrange(20, 90), 300).split()
        toxic, junk = rng.random() < 0.3, rng.random() < 0.4
        for word in (["dolt", "folk"] if toxic else [rng.choice(["dolt", "folk", "calm"])]) * 2:
            w.insert(rng.randrange(len(w)), word)
        text = " ".join(x + "###" if junk else x for x in w)
        rows.append((k, text))
        labels.append((k, int(not junk), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def data(spark):
    rows, labels = corpus(1)
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS), {r[0]: r for r in labels}


def agreement(got, truth, column):
    held = [(r.predicted, truth[r.doc_id][column]) for r in got if r.held_out]
    return np.mean([a == b for a, b in held])


def test_quality_held_out(data):
    docs, labels, truth = data
    got = byte_cnn.quality_scores(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert agreement(got, truth, 1) > 0.95


def better(scores, y):
    """Share of pairs of a toxic and a calm row that are ranked right."""
    toxic, calm = scores[y == 1], scores[y == 0]
    return float(np.mean((toxic[:, None] > calm[None, :]) + 0.5 * (toxic[:, None] == calm[None, :])))


def ablation(rows, y):
    """Held-out ranking of the whole machine, of its linear part alone, and its factors."""
    slots, cuts = toxicity.terms(pa.array(rows))
    cut = len(rows) * 3 // 4
    machine = toxicity.fit(slots[: cuts[cut]], cuts[: cut + 1], y[:cut], {1: int(y[:cut].sum()), 0: int(cut - y[:cut].sum())})
    own, at = slots[cuts[cut] :], cuts[cut:] - cuts[cut]
    linear = toxicity.Machine(machine.intercept, machine.linear, np.zeros_like(machine.factors))
    return better(machine.logits(own, at), y[cut:]), better(linear.logits(own, at), y[cut:]), machine.factors


@pytest.mark.parametrize("length", [40, 80])
def test_toxicity_learns_what_only_the_pair_tells(length):
    """Insult and group are each in half of the toxic and of the calm rows; together or apart decides. Weights alone are
    chance there, the machine is not, and without its factors it is chance again."""
    rng = random.Random(length)
    rows, y = [], np.array([k % 2 for k in range(2000)], float)
    for label in y:
        insult = rng.random() < 0.5
        group = insult == bool(label)
        w = H.prose(rng, length, 400).split()
        for word, there in (("dolt", insult), ("folk", group)):
            if there:
                w.insert(rng.randrange(len(w)), word)
        rows.append(" ".join(w))
    whole, linear, factors = ablation(rows, y)
    assert whole > 0.9 and abs(linear - 0.5) < 0.1 and np.abs(factors).max() > 0.1


def test_toxicity_held_out_needs_pairs(data):
    docs, labels, truth = data
    got = toxicity.toxicity_report(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [(r.score, truth[r.doc_id][2]) for r in got if r.held_out]
    assert better(np.array([s for s, _ in held]), np.array([y for _, y in held])) > 0.85
    rows, y = corpus(2, 1600)
    whole, linear, _ = ablation([t for _, t in rows], np.array([r[2] for r in y], float))
    assert whole > 0.9 and whole > linear + 0.02


def test_factors_are_not_zero_on_the_given_tables(spark):
    from stratafile.llm.tables import table

    machine = toxicity.train(*(table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels")))
    assert np.abs(machine.factors).max() > 0.05 and np.abs(machine.linear).max() > 0.05


def test_sample_takes_short_texts_first(spark):
    """Texts over the limit don't use up the sample; a class with long texts only is an error; of an id's texts the
    smallest is taken."""
    docs = spark.createDataFrame([(k, "x" * (500 if k < 90 else 5)) for k in range(100)] + [(95, "a"), (95, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, int(k < 50)) for k in range(100)], LABELS)
    rows, counts = labelled.sample(docs, labels, "quality", 1000, 999, {1: 10, 0: 10}, 100)
    got = {r.doc_id: r.text for r in rows.collect()}
    assert sorted(got) == list(range(90, 100)) and got[95] == "a" and counts == {0: 50, 1: 50}
    with pytest.raises(ValueError):
        labelled.sample(docs, labels, "toxic", 1000, 999, {1: 10, 0: 10}, 100)


def test_held_out_labels_are_never_read(spark, data):
    docs, labels, _ = data
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in byte_cnn.quality_scores(docs, x).collect()} for x in (labels, flipped))
    assert a == pytest.approx(b, abs=1e-6)


@pytest.mark.parametrize("report", [byte_cnn.quality_scores, toxicity.toxicity_report])
def test_awkward_rows(spark, docs, rows, no_docs, report):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(1, 40)] + [(None, 1, 1), (5, None, None), (5, 1, 1), (99, 0, 0)], LABELS)
    got = report(docs.withColumn("y", F.lit(9)).withColumn("slots", F.lit(1)), labels).collect()
    assert H.counted((r.doc_id,) for r in got) == H.counted((r[0],) for r in rows)
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert len({r.score for r in got if r.doc_id == 13}) == 1  # repeated rows score alike
    assert report(no_docs, labels).count() == 0
    none = report(docs, labels.limit(0)).collect()
    assert len(none) == len(rows) and all(r.score < 0.01 for r in none)


def test_cnn_gradients_are_right():
    rng = np.random.default_rng(1)
    net = {k: v.astype(np.float64) for k, v in byte_cnn.untrained(rng).items()}
    texts = [rng.integers(32, 127, n).astype(np.uint8) for n in (5, 130, 700, 0)]
    data, offsets, y = np.concatenate(texts), np.append(0, np.cumsum([len(t) for t in texts])), np.array([1, 0, 1, 0.0])
    grad, _ = byte_cnn.gradients(net, data, offsets, y)
    for name in ("filters", "embed", "mix", "out", "bias"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        step, loss = 1e-2, []
        for sign in (1, -1):
            moved = {k: v.copy() for k, v in net.items()}
            moved[name][at] += sign * step
            loss.append(byte_cnn.gradients(moved, data, offsets, y)[1])
        assert (loss[0] - loss[1]) / (2 * step) == pytest.approx(grad[name][at], rel=0.2, abs=2e-3)


def test_cnn_scores_do_not_depend_on_neighbours():
    net = byte_cnn.untrained(np.random.default_rng(2))
    texts = [np.frombuffer(H.prose(random.Random(k), 3 + 60 * k).encode(), np.uint8) for k in range(6)] + [np.zeros(0, np.uint8)]
    together = byte_cnn.logits(net, np.concatenate(texts), np.append(0, np.cumsum([len(t) for t in texts])))
    alone = [byte_cnn.logits(net, t, np.array([0, len(t)]))[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-4)


def test_machine_pairwise_part_is_the_sum_over_pairs():
    rng = np.random.default_rng(6)
    linear, factors = rng.normal(0, 1, 50), rng.normal(0, 1, (50, toxicity.FACTORS))
    slots, cuts = np.array([3, 7, 9, 20, 7]), np.array([0, 4, 4, 5])
    got = toxicity.Machine(0.5, linear, factors).logits(slots, cuts)
    first = sum(linear[[3, 7, 9, 20]]) + sum(factors[a] @ factors[b] for i, a in enumerate([3, 7, 9, 20]) for b in [3, 7, 9, 20][:i]) / 2
    assert got == pytest.approx([0.5 + first, 0.5, 0.5 + linear[7]])
