from __future__ import annotations

import pytest
from llm.samples import edge_rows, with_clashes


@pytest.fixture(scope="session")
def edge():
    return edge_rows()


@pytest.fixture(scope="session")
def edge_docs(spark, edge):
    return with_clashes(spark, edge)


@pytest.fixture(scope="session")
def no_docs(spark):
    return with_clashes(spark, []).limit(0)


@pytest.fixture(scope="session")
def documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
