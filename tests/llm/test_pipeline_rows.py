"""The pipeline's stages one after the other on awkward, clashing and empty tables, each against a plain computation."""

from collections import Counter, defaultdict

import helpers as H
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratafile.llm import quality_rules
from stratafile.llm.tokens import encoder, vocabulary

CLASHING = ("_chunk", "_n_words", "_sum", "_key", "_size", "_mix", "_place", "_copy", "hashes", "range", "node", "component", "n_shingles", "kept", "_q", "_kept")


def run_stages(spark, docs, path):
    """The rows after each stage, written and read again as the driver does."""
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "nowhere").write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
        out.append(docs)
    return out


def test_stages_on_awkward_rows(spark, docs, rows, tmp_path):
    given = docs.withColumns({c: F.lit("mine") for c in CLASHING})
    good, single, cut, mixed, packed = run_stages(spark, given, tmp_path)
    for df in (good, single, cut, mixed):
        assert df.columns == given.columns
        assert df.where(" or ".join(f"`{c}` <> 'mine'" for c in CLASHING)).count() == 0
    verdicts = H.counted((r.doc_id, r.kept) for r in quality_rules.quality_report(docs).collect())
    good, single, cut, mixed = (df.collect() for df in (good, single, cut, mixed))
    assert Counter(r.doc_id for r in good) == Counter({i: n for (i, kept), n in verdicts.items() if kept})

    groups = H.components([(r.doc_id, r.text) for r in good])
    longest = {}
    for r in good:
        if r.doc_id is not None:
            longest[r.doc_id] = max(longest.get(r.doc_id, ""), r.text or "", key=lambda t: len(t.encode()))
    want = Counter((i, longest[i]) for i in set(groups.values())) + Counter((None, r.text) for r in good if r.doc_id is None)
    assert Counter((r.doc_id, r.text or "") for r in single) == want

    gone = H.removed_words([(r.doc_id, r.text) for r in single])
    want = Counter((r.doc_id, " ".join(w for p, w in enumerate(H.words(r.text)) if p not in gone[k])) for k, r in enumerate(single))
    assert Counter((r.doc_id, " ".join(H.words(r.text))) for r in cut) == want

    sizes = defaultdict(int)
    for r in cut:
        sizes[r.source] += len(H.words(r.text))
    taken = defaultdict(int)
    for r in mixed:
        taken[r.source] += len(H.words(r.text))
    assert abs(sum(taken.values()) - sum(sizes.values())) <= 2 * len(sizes)
    whole = defaultdict(set)
    for r in cut:
        whole[r.doc_id].add(" ".join(H.words(r.text)))
    partial = [r for r in mixed if " ".join(H.words(r.text)) not in whole[r.doc_id]]
    assert len(partial) <= len(sizes) and all(any(w.startswith(" ".join(H.words(r.text))) for w in whole[r.doc_id]) for r in partial)

    check_packing(mixed, packed.collect())


def check_packing(texts, pieces):
    """Every token of every row lies in one piece, sequences have no gap and no padding but at a power of two."""
    own = encoder(vocabulary())
    want = Counter()
    for r in texts:
        want.update((r.doc_id, int(x)) for x in [*own.ids(r.text or ""), 0])
    assert Counter((p.doc_id, x) for p in pieces for x in p.ids) == want
    whole = defaultdict(list)  # a document's pieces by their start are its ids
    for p in pieces:
        assert len(p.ids) == p.length > 0
        whole[p.doc_id, p.doc_tokens].append(p)
    for r in texts:
        ids = [int(x) for x in [*own.ids(r.text or ""), 0]]
        same = whole[r.doc_id, len(ids)]
        assert any(p.start == 0 and list(p.ids) == ids[: p.length] for p in same)
        assert all(0 <= p.start and p.start + p.length <= p.doc_tokens for p in same)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024 and end & (end - 1) == 0


def test_stages_on_an_empty_table(spark, no_docs, tmp_path):
    after = run_stages(spark, no_docs.withColumns({c: F.lit("mine") for c in CLASHING}), tmp_path)
    assert all(df.count() == 0 for df in after) and all(df.columns == [*no_docs.columns, *CLASHING] for df in after[:4])


@pytest.mark.parametrize("rows", [[(None, None, None, None, None)] * 3, [(1, "", "en", None, None), (1, "", "en", None, None)]])
def test_stages_on_rows_without_anything(spark, rows, tmp_path):
    after = run_stages(spark, spark.createDataFrame(rows, H.DOCS), tmp_path)
    assert [df.count() for df in after] == [0] * 5  # fewer than 10 words: rejected at once


def test_packing_check_notices(spark):
    """The check itself fails on a lost piece."""
    from stratafile.llm.packing import pack_documents

    rows = spark.createDataFrame([(1, H.prose(__import__("random").Random(1), 700))], "doc_id long, text string")
    pieces = pack_documents(rows).collect()
    check_packing(rows.collect(), pieces)
    with pytest.raises(AssertionError):
        check_packing(rows.collect(), pieces[1:])
