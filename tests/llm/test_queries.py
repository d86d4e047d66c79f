"""The registered queries against their SQL twins, and the pipeline stage by stage."""

from pathlib import Path

import helpers as H
import pytest
from check_oracles import duck, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from stratafile.llm import queries, quality_rules

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck(SF).execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, len(queries.QUERIES) + 1))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows.append(docs.collect())
        assert docs.columns == columns or k == 4
    given, good, single, cut, mixed, packed = rows
    kept = {r.doc_id for r in quality_rules.quality_report(spark.createDataFrame(given, H.DOCS)).where("kept").collect()}
    assert {r.doc_id for r in good} == kept
    of = H.components([(r.doc_id, r.text) for r in good])
    assert sorted(r.doc_id for r in single) == sorted(set(of.values()))
    gone = H.removed_words([(r.doc_id, r.text) for r in single])
    want = {r.doc_id: [w for p, w in enumerate(H.words(r.text)) if p not in gone[k]] for k, r in enumerate(single)}
    assert {r.doc_id: H.words(r.text) for r in cut} == want
    size = sum(len(H.words(r.text)) for r in cut)
    assert abs(sum(len(H.words(r.text)) for r in mixed) - size) <= len({r.source for r in cut})
    whole = {r.doc_id: r.text for r in cut}
    assert all(whole[r.doc_id] == r.text or whole[r.doc_id].split()[: len(r.text.split())] == r.text.split() for r in mixed)
    assert sum(r.length for r in packed) == sum({(r.doc_id, r.start, r.sequence_id, r.offset): r.length for r in packed}.values())


def test_entry_without_the_subpackage(tmp_path):
    """Without both folders and the pipeline the other queries still register."""
    import shutil
    import subprocess
    import sys

    root = Path(entry.__file__).resolve().parent
    shutil.copytree(root / "stratafile", tmp_path / "stratafile", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not any(n.startswith('op') or n == 'pipeline' for n in q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, timeout=120).returncode == 0


def test_rules_keep_rows_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    assert set(quality_rules.keep_good(docs).columns) == set(docs.columns)
