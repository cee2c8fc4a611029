"""Filter interaction audit (operator 11) against filtering document by document."""

from __future__ import annotations

import itertools

import pytest
from hypothesis import given, settings, strategies as st
from llm import brute
from llm.samples import prose, same
from rowtide.llm import filter_audit
from rowtide.llm.filter_audit import Diagram, adjacent_swaps, part_steps

COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


@pytest.mark.parametrize("n", range(6))
def test_swaps_meet_every_order_once(n):
    order, met = list(range(n)), []
    for place in [None, *adjacent_swaps(n)]:
        if place is not None:
            order[place], order[place + 1] = order[place + 1], order[place]
        met.append(tuple(order))
    assert sorted(met) == sorted(itertools.permutations(range(n)))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 15), st.tuples(*[st.integers(1, 4)] * 3), max_size=16))
def test_diagram_steps(counts):
    names = "ABCD"
    rows = []
    for mask, (n, good, toxic) in counts.items():
        fails = "".join(f for i, f in enumerate(names) if mask >> i & 1)
        good, toxic = min(n, good), min(n, toxic)
        counts[mask] = (n, good, toxic)
        rows += [("p", fails, int(i < good), int(i < toxic)) for i in range(n)]
    got = sorted(("p", *row) for row in part_steps(counts, names))
    # A part without rows has steps of zeros here; Spark gives it none.
    assert not rows or got == sorted(brute.audit(rows, names))


def test_diagram_shares_equal_subgraphs():
    """Two filters that do not interact need one node a level and weight."""
    diagram = Diagram({mask: (5, 0, 0) for mask in range(32)}, 5)
    assert [len(level) for level in diagram.levels] == [1] * 5
    for place in adjacent_swaps(5):
        diagram.swap(place)
    assert [len(level) for level in diagram.levels] == [1] * 5
    assert diagram.weight[diagram.root] == (160, 0, 0)


def _expected(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    told = {}
    for doc_id, quality, toxic in labels:
        before = told.get(doc_id, (0, 0))
        told[doc_id] = (max(before[0], int(quality == 1)), max(before[1], int(toxic == 1)))
    told.pop(None, None)
    fails = brute.failing([d[:2] for d in docs])
    return list(brute.audit([(lang or "", f, *told.get(i, (0, 0))) for (i, _, lang), f in zip(docs, fails)], "ABCDE"))


def _frames(spark, docs, labels):
    docs = [(*d, 1, "x", "y", 0) for d in docs]
    ddl = "doc_id bigint, text string, lang string, part int, digest string, first string, mask int"
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return spark.createDataFrame(docs, ddl), labels


def test_audit(spark, edge):
    plain = prose(5, 150)
    docs = [(d, t, [None, "en", "de", ""][i % 4]) for i, (d, t) in enumerate(edge)]
    docs += [(100 + i, plain, "en") for i in range(4)] + [(100, plain, "en"), (None, plain, "de")]
    docs += [(120, "A" * 11 + "a" * 89, "de"), (121, "A" * 10 + "a" * 90, "de"), (122, "  a\x0b#\x0c ", "fr")]
    docs += [(123, " ".join(f"w{i % 80}" for i in range(100)), "fr"), (124, " ".join(f"w{i % 79}" for i in range(100)), "fr")]
    labels = [(5, 1, 0), (5, 0, 1), (6, None, 1), (100, 1, 0), (101, 1, None), (None, 1, 1), (120, 1, 1), (999, 1, 1)]
    got = filter_audit.audit(filter_audit.failures(*_frames(spark, docs, labels)))
    same(got, COLUMNS, _expected(docs, labels))


def test_hot_text_and_shuffled_copies(spark, monkeypatch):
    """Copies joined by shuffling, as beyond the size that is broadcast."""
    monkeypatch.setattr(filter_audit, "is_small", lambda df: False)
    docs = [(i, "the same text | again" if i % 3 == 0 else f"text {i}", "en") for i in range(300)]
    labels = [(i, int(i % 2 == 0), int(i % 5 == 0)) for i in range(0, 300, 2)]
    got = filter_audit.audit(filter_audit.failures(*_frames(spark, docs, labels)))
    same(got, COLUMNS, _expected(docs, labels))


def test_empty(spark):
    assert filter_audit.audit(filter_audit.failures(*_frames(spark, [], []))).isEmpty()
