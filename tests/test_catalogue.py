"""Every query that has an oracle against DuckDB, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__
from tests.compare import oracle_rows, spark_rows

SF = "/root/testdata/sf0.001"
NAMES = [n for n in __spark_entry__.oracle_sql() if not n.startswith("op")]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_oracle(spark, name):
    assert spark_rows(__spark_entry__.queries()[name](spark, SF)) == oracle_rows(__spark_entry__.oracle_sql()[name], SF)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 200


def test_oracles_are_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_outside_names_the_llm_subpackage():
    root = Path(__file__).resolve().parents[1]
    for p in (root / "quillmark").rglob("*.py"):
        if "llm" not in p.parts:
            assert "quillmark.llm" not in p.read_text()
