"""SetSketch near-duplicates against all pairs."""

import random

import helpers as H
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratafile.llm import near_dups, setsketch
from stratafile.llm.words import mixed


def found(df):
    return {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dups.near_duplicates(df).collect()}


def expected(rows):
    of = H.components([(r[0], r[1]) for r in rows])
    return {(i, len(H.shingles(t)), of.get(i), i is None or i == of[i]) for i, t, *_ in rows}


def test_awkward_rows_equal_all_pairs(docs, rows):
    assert near_dups.near_duplicates(docs).count() == len(rows)
    assert found(docs) == expected(rows)


def test_empty_table(no_docs):
    assert near_dups.near_duplicates(no_docs).count() == 0
    assert near_dups.one_of_each(no_docs).count() == 0


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Families around the threshold that share a passage, with buckets refined from two members apart on."""
    rng = random.Random(5)
    passage, rows = H.prose(rng, 60, 9999), []
    for family in range(12):
        base = (passage + " " + H.prose(rng, 40, 9999)).split()
        for k in range(12):
            own = list(base)
            for _ in range(k % 5):
                own[rng.randrange(len(own))] = f"y{rng.randrange(9999)}"
            rows.append((family * 100 + k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == expected(rows)
    monkeypatch.setattr(near_dups, "CROWDED", 2)
    assert found(df) == expected(rows)


def test_one_of_each_keeps_rows_without_id_and_other_columns(docs, rows):
    kept = near_dups.one_of_each(docs)
    assert kept.columns == docs.columns
    of = H.components([(r[0], r[1]) for r in rows])
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(of.values()))
    assert kept.where("doc_id is null").count() == 2
    assert kept.where("doc_id = 1").first().text.startswith("w")  # not the empty text of the same id


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 900), (900, 700), (3, 3)]
    got = {r.node: r.component for r in near_dups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {500: 500, 900: 500, 700: 500}


@pytest.mark.parametrize("similarity", [0.5, 0.75, 0.9])
def test_registers_merge_and_are_locality_sensitive(similarity):
    rng = np.random.default_rng(3)
    n = 400
    both = round(2 * n * similarity / (1 + similarity))
    values = mixed(rng.integers(0, 2**62, 2 * n - both).astype(np.uint64))
    u, v = setsketch.registers(np.concatenate([values[:n], values[n - both :]]), np.array([0, n]))
    union = setsketch.registers(values, np.array([0]))[0]
    assert (setsketch.merged(u, v) == union).all()
    assert abs((u == v).mean() - similarity) < 0.12
    sizes = np.array([n])
    assert setsketch.plausible(0.75, sizes, sizes, u[None], v[None])[0] == (similarity >= 0.7)


def test_extra_columns_do_not_clash(docs):
    clashing = docs.withColumn("node", F.lit(1)).withColumn("key", F.lit("x")).withColumn("kept", F.lit(False))
    assert found(clashing) == found(docs)
    assert near_dups.one_of_each(clashing).columns == clashing.columns
