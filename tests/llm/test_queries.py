"""Registered queries next to their SQL, on the smallest test tables."""

from pathlib import Path

import pytest
from compare import compare, connect

from tierwright.llm.queries import QUERIES, SQL

SMALLEST = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALLEST).is_dir(), reason="test tables not present")


@pytest.mark.parametrize("name", SQL)
def test_query(spark, name):
    assert compare(spark, connect(SMALLEST), name, QUERIES[name], SQL[name], SMALLEST) is None


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALLEST)
        assert docs.columns == columns
    packed = corpus_pipeline.run(spark, SMALLEST).toPandas()
    assert (packed.groupby("sequence_id")["length"].sum() <= 1024).all() and len(packed)
