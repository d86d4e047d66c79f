"""Every registered query against its SQL twin on the smallest tables, plus whole-set checks."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry_module  # noqa: E402
from check_oracles import compare, duck  # noqa: E402
from stratafile.operators import normalize as P  # noqa: E402
from stratafile.plans import inputs as I  # noqa: E402
from stratafile.plans import resources as R  # noqa: E402
from stratafile.plans.oracles import ORACLES  # noqa: E402
from stratafile.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name) == ""


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_good_plus_bad_is_everything(spark, cfg):
    rows = I.raw_files(spark, SF)
    good, bad = P.split_bad_rows(P.normalize_files(rows, cfg))
    assert good.count() + bad.count() == rows.count()


def test_yielded_plus_skipped_is_everything(spark, cfg):
    summary = entry_module.queries()["A03_change_summary"](spark, SF)
    assert summary.where("total_yielded + skipped <> total_changes").count() == 0
    records = entry_module.queries()["Q13_webhook_changes"](spark, SF)
    assert records.count() == summary.agg({"total_yielded": "sum"}).first()[0]


def test_hot_connections_change_no_result(spark, cfg):
    raw, connections = I.raw_files(spark, SF), I.connections(spark, SF)
    plain = R.full_sync(raw, connections, cfg).select("idempotency_key")
    spread = R.full_sync(raw, connections, cfg, hot=["conn_1"]).select("idempotency_key")
    assert plain.exceptAll(spread).count() == 0 and plain.count() == spread.count()


def test_no_python_in_batch_plans(spark):
    names = [n for n in QUERIES if not n.startswith(("stream_", "T02"))]
    for name in names:
        text = entry_module.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
