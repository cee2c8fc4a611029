"""Exact deduplication by a stream (operator 13) against grouping by the whole text."""

from __future__ import annotations

import pytest
from llm import brute
from llm.samples import same, with_clashes
from pyspark.sql import functions as F
from rowtide.llm import exact_dedup
from rowtide.llm.exact_dedup import advance, deduplicate, states
from rowtide.llm.folders import new_path

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
ROWS = [(1, "a b"), (2, "ab"), (3, " ab "), (4, " a b"), (5, None), (6, "\x0b\x0c"), (7, "a\x85b"), (2, "ab")]


def _write(spark, rows, path, mode="errorifexists"):
    with_clashes(spark, rows).coalesce(1).write.mode(mode).parquet(path)
    return path


def test_edge_rows(spark, edge):
    rows = [*edge, *ROWS]
    table = _write(spark, rows, new_path(spark, "table"))
    same(deduplicate(spark, table), COLUMNS, brute.deduplicated(rows))


def test_table_that_grows(spark, edge):
    """A later call takes the new files alone into the state that is there."""
    table, folder = new_path(spark, "table"), new_path(spark, "state")
    _write(spark, ROWS, table)
    same(deduplicate(spark, table, folder), COLUMNS, brute.deduplicated(ROWS))
    more = [(9, "  a  b  "), (0, "ab"), *edge]
    _write(spark, more, table, "append")
    same(deduplicate(spark, table, folder), COLUMNS, brute.deduplicated([*ROWS, *more]))
    total = states(spark, folder).agg(F.sum("size")).first()[0]
    assert total == len(ROWS) + len(more)
    # Nothing new: the state stays.
    advance(spark, table, folder)
    assert states(spark, folder).agg(F.sum("size")).first()[0] == total


def test_one_file_a_batch(spark):
    """Micro-batches of one file each give what one batch gives."""
    table, folder = new_path(spark, "table"), new_path(spark, "state")
    for i in range(3):
        _write(spark, [(10 * i + d, t) for d, t in ROWS], table, "append")
    advance(spark, table, folder, batch_bytes=1)
    rows = [(10 * i + d, t) for i in range(3) for d, t in ROWS]
    want = {(r[1], r[2]) for r in brute.deduplicated(rows)}
    got = {(r.keep.doc_id, r.size) for r in states(spark, folder).collect()}
    assert got == want
    assert len(spark.read.json(f"{folder}/commits").collect()) >= 3


@pytest.mark.parametrize("broadcast", [True, False])
def test_bytes_decide(spark, edge, monkeypatch, broadcast):
    """A digest that many texts share: the bytes tell them apart."""
    monkeypatch.setattr(exact_dedup, "is_small", lambda df: broadcast)
    rows = [*edge, *ROWS]
    table = _write(spark, rows, new_path(spark, "table"))
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1).cast("binary")
    same(deduplicate(spark, table, digest=weak), COLUMNS, brute.deduplicated(rows))


def test_empty_table(spark):
    table = _write(spark, [], new_path(spark, "table"))
    assert deduplicate(spark, table).isEmpty()


def test_settings_are_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with exact_dedup.disk_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key) == before
