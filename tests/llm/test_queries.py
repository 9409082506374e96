"""The registered queries beside their SQL, on the smallest tables."""

import pytest

from checks.compare import compare, connect
from fleetmart.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF), SF, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op12_nearest", "op13_whitening"}))
def test_other_queries_return_every_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in QUERIES[name](spark, SF).select("doc_id").collect()}
    assert ids == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_thirteen_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
