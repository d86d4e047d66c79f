import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import helpers as H  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return H.awkward(random.Random(1))


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, H.DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], H.DOCS)
