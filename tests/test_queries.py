"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle_sql()

#: Queries that SQL cannot express, with the file of their brute-force tests.
TESTED_ELSEWHERE = {
    "op1_licenses": "tests/llm/test_licenses.py",
    "op2_bpe": "tests/llm/test_bpe.py",
    "op3_simhash": "tests/llm/test_simhash.py",
    "op4_toxicity": "tests/llm/test_toxicity.py",
    "op6_passages": "tests/llm/test_passages.py",
    "op8_lm": "tests/llm/test_lm.py",
    "op9_suffix_dedup": "tests/llm/test_suffix_dedup.py",
    "op11_language": "tests/llm/test_langid.py",
    "pipeline": "tests/llm/test_pipeline.py",
}


@pytest.fixture(scope="module")
def con():
    connection = duck(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    status, note = compare(spark, con, SF_DIR, name, queries()[name], SQL.get(name))
    # a query without SQL needs a test of its own, named here
    assert status == "ok" or status == "rows" and name in TESTED_ELSEWHERE, f"{status} {note}"


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["city", "year", "cumulative_area"]
    assert df.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(queries())
