"""The stages, each against what its operator says about its input."""

from __future__ import annotations

from llm import brute
import corpus_pipeline
import __spark_entry__ as driver
from rowtide.llm import pii
from rowtide.llm.queries import ORACLES, QUERIES


def test_registered():
    names = set(driver.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert len([n for n in QUERIES if n.startswith("op")]) == 10
    assert set(ORACLES) <= set(QUERIES)


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]

    def rows(df):
        assert df.columns == docs.columns
        return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())

    known = stages["language"](spark, docs, small)
    first = rows(known)
    single = stages["near_duplicates"](spark, known, small)
    second = rows(single)
    assert second == sorted({min(r for r, c in zip(first, brute.components(first)) if c[2] == k) for k in {c[2] for c in brute.components(first)}})
    clean = stages["decontamination"](spark, single, small)
    third = rows(clean)
    assert third == [r for r, c in zip(second, brute.contamination(second, items)) if not c[-1]]
    hidden = stages["personal_data"](spark, clean, small)
    fourth = rows(hidden)
    assert [r[0] for r in fourth] == [r[0] for r in third]
    spans = {d: sum(n) for d, *n, _ in brute.private(third)}
    more = {r.doc_id: len(r.spans) for r in pii.scan(clean).collect()}
    for (doc_id, before), (_, after) in zip(third, fourth):
        assert (before == after) == (more[doc_id] == 0)
        assert spans[doc_id] <= more[doc_id]
    packed = stages["packing"](spark, hidden, small)
    assert packed.select("doc_id").distinct().count() == len(fourth)


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 100
