"""Mixing of more sources than are broadcast."""

import pytest
from pyspark.sql import functions as F

from fleetmart.llm import mixing

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("options", [{}, {"repetitions": None, "target_entropy": 2.0}, {"total": 30_000}])
def test_many_sources_mix_as_few_do(spark, rows_of, options):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 7 > 0, F.col("source"))
    )
    few = rows_of(mixing.mix(docs, block_tokens=500, **options))
    assert few and rows_of(mixing.mix(docs, block_tokens=500, most_sources=2, **options)) == few


def test_exponents_of_a_frame_are_those_of_a_list(spark):
    tokens = [1000, 100, 10, 10, 7]
    totals = spark.createDataFrame([(n,) for n in tokens], "n long")
    for options in ({"repetitions": 3.0}, {"target_entropy": 0.9}, {"target_entropy": 0.1}, {"target_entropy": 9.0}):
        both = {"repetitions": None, "target_entropy": None} | options
        assert mixing._exponent_over(totals, **both) == pytest.approx(mixing.exponent_for(tokens, **options))
