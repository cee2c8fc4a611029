from __future__ import annotations

import json
import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from conftest import rows
from logs import COLUMNS, announce, frame, message, tuple_, workload
from rowtide.operators import encode, relations
from rowtide.operators.decode import (
    commit_positions,
    decode_changes,
    distinct_changes,
    truncate_audit,
    typed_rows,
    with_positions,
)
from rowtide.operators.messages import split_quarantine
from rowtide.operators.relations import relation_asof
from rowtide.schemas import CHANGE_LOG
from rowtide.sources.change_log import keepalives, published_only


@pytest.fixture(params=["by_shape", "by_list"])
def encoder(request, monkeypatch):
    """Both ways to encode, which have to agree."""
    if request.param == "by_list":
        monkeypatch.setattr(encode, "MAX_SHAPES", -1)
    return request.param


def decoded(spark, messages, **kw):
    out = decode_changes(frame(spark, messages), **kw)
    return rows(out.orderBy("commit_pos", "ord", "op"), "table", "op", "key", "value", "error")


def test_operations(spark, encoder):
    log = [
        announce(),
        message("B", 10, None),
        message("I", 10, 0, new=tuple_(1, 'a"b', 1.5)),
        message("U", 20, 0, new=tuple_(1, None, ...)),
        message("U", 30, 0, new=tuple_(1, "x", "oops")),
        message("D", 40, 0, old=tuple_(1, None, None)),
        message("C", 40, 1),
    ]
    assert decoded(spark, log) == sorted(
        [
            ("public.t", "c", '{"id":1}', '{"id":1,"name":"a\\"b","score":1.5}', None),
            ("public.t", "u", '{"id":1}', '{"id":1,"name":null}', None),
            ("public.t", "u", '{"id":1}', '{"id":1,"name":"x","score":"oops"}', None),
            ("public.t", "d", '{"id":1}', None, None),
        ],
        key=repr,
    )


def test_quarantine(spark, encoder):
    log = [
        announce(),
        message("I", 1, 0, relation_id=9, new=tuple_(1, "a", 1)),
        message("D", 2, 0),
        message("I", 3, 0, new=tuple_(1, b"\x01", 1)),
        message("I", 4, 0, new=tuple_(2, "a", "NaN")),
        message("U", 5, 0, new=tuple_(3, "NaN", "Infinity")),
        message("I", 6, 0, new=tuple_(4, "NaN", 1)),
    ]
    good, bad = split_quarantine(decode_changes(frame(spark, log)))
    assert rows(good, "key") == [('{"id":4}',)]
    assert rows(bad, "op", "error") == [
        ("c", "binary_tuple"),
        ("c", "unencodable_float"),
        ("c", "unknown_relation"),
        ("d", "delete_without_old_tuple"),
        ("u", "unencodable_float"),
    ]


def test_strict_fails_on_unknown_relation(spark):
    log = frame(spark, [message("I", 1, 0, relation_id=9, new=tuple_(1, "a", 1))])
    with pytest.raises(Exception, match="unknown relation 9"):
        decode_changes(log, strict=True).collect()


def test_tuple_and_relation_of_different_length(spark, encoder):
    two = [("id", 20, 1), ("name", 25, 0)]
    log = [
        announce(columns=two),
        message("I", 1, 0, new=tuple_(1, "a", "surplus")),
        message("I", 2, 0, new=tuple_(2)),
    ]
    assert [r[3] for r in decoded(spark, log)] == ['{"id":1,"name":"a"}', '{"id":2}']


def test_schema_change_inside_the_log(spark, encoder):
    wider = [("id", 20, 1), ("name", 25, 0), ("at", 1184, 0)]
    log = [
        announce(0),
        message("I", 10, 0, new=tuple_(1, "a", 2)),
        message("I", 20, 0, new=tuple_(2, "b", 2)),
        announce(20, 1, columns=wider),
        message("I", 20, 1, new=tuple_(3, "c", "2026-01-15 10:00:00+00")),
        announce(30, 0),
        message("I", 30, 0, new=tuple_(4, "d", 2)),
    ]
    values = sorted(r[3] for r in decoded(spark, log))
    assert values == [
        '{"at":"2026-01-15T10:00:00Z","id":3,"name":"c"}',
        '{"id":1,"name":"a","score":2.0}',
        '{"id":2,"name":"b","score":2.0}',
        '{"id":4,"name":"d","score":2.0}',
    ]


def test_key_modes(spark, encoder):
    full = [(n, o, 1) for n, o, _ in COLUMNS]
    log = [announce(columns=full), message("I", 1, 0, new=tuple_(1, ..., 2))]
    identity = decoded(spark, log)[0][2]
    assert identity == '{"id":1,"name":null,"score":2.0}'
    pk = spark.createDataFrame([("public.t", ["id"])], "table string, pk_columns array<string>")
    assert decoded(spark, log, pk=pk)[0][2] == '{"id":1}'


def test_old_key_tombstone(spark, encoder):
    log = [
        announce(),
        message("U", 1, 0, old=tuple_(1, None, None), new=tuple_(2, "a", 1)),
        message("U", 2, 0, old=tuple_(2, None, None), new=tuple_(2, "b", 1)),
        message("U", 3, 0, new=tuple_(2, "c", 1)),
    ]
    assert len(decoded(spark, log, old_key_tombstones=False)) == 3
    with_old = decoded(spark, log)
    assert [r for r in with_old if r[1] == "d"] == [("public.t", "d", '{"id":1}', None, None)]
    assert len(with_old) == 4


def test_leaf_is_published_as_root(spark, encoder):
    roots = spark.createDataFrame([("public.t", "public.root")], "table string, root string")
    log = [announce(), announce(0, 0, 2, name="other"), message("I", 1, 0, new=tuple_(1, "a", 1)), message("I", 2, 0, 2, new=tuple_(1, "a", 1))]
    assert sorted(r[0] for r in decoded(spark, log, roots=roots)) == ["public.other", "public.root"]


def test_names_need_escaping(spark, encoder):
    odd = [('i"d', 20, 1), ("a,b", 25, 0)]
    log = [announce(columns=odd), message("I", 1, 0, new=tuple_(1, "x"))]
    (row,) = decoded(spark, log)
    assert json.loads(row[2]) == {'i"d': 1}
    assert json.loads(row[3]) == {'i"d': 1, "a,b": "x"}


@pytest.mark.parametrize("local", [True, False])
@pytest.mark.parametrize("seed", range(3))
def test_as_of_matches_a_search(spark, monkeypatch, seed, local):
    """Against bisection, with hot relations, repeats and one big transaction."""
    monkeypatch.setattr(relations, "CANDIDATES", 3)
    monkeypatch.setattr(relations, "WINDOW_ROWS", 7)
    if not local:
        monkeypatch.setattr(relations, "LOCAL_VERSIONS", 0)
    rng = random.Random(seed)
    versions, changes = [], []
    for _ in range(120):
        rid = rng.choice([1, 1, 1, 2, 3])
        pos = rng.choice([500, rng.randrange(1000)])
        versions.append((rid, (pos, rng.randrange(20)), f"v{rng.randrange(3)}"))
    versions = list({(v[0], v[1]): v for v in versions}.values())
    for i in range(400):
        changes.append((i, rng.choice([1, 1, 2, 3, 4]), rng.choice([500, rng.randrange(1100)]), rng.randrange(20)))
    v = spark.createDataFrame(versions, "relation_id bigint, valid_from struct<commit_pos:bigint,ord:bigint>, name string")
    c = spark.createDataFrame(changes, "i int, relation_id bigint, commit_pos bigint, ord bigint")
    got = {r.i: r.name for r in relation_asof(c, v).select("i", "name").collect()}
    want = {}
    for i, rid, pos, place in changes:
        mine = sorted((at, name) for r, at, name in versions if r == rid)
        n = bisect_right([at for at, _ in mine], (pos, place))
        want[i] = mine[n - 1][1] if n else None
    assert got == want


def test_as_of_without_any_relation(spark):
    v = frame(spark, []).select("relation_id", F.struct("commit_pos", "ord").alias("valid_from"), "kind")
    c = frame(spark, [message("I", 1, 0)]).drop("kind")
    assert rows(relation_asof(c, v), "kind") == [(None,)]


def test_truncate_audit(spark):
    log = [
        announce(0, 0, 1),
        announce(0, 0, 2, name="u"),
        message("T", 5, 0, None, relation_ids=[1, 2, 3]),
    ]
    assert rows(truncate_audit(frame(spark, log))) == [("public.t", 5, 0), ("public.u", 5, 0)]


def test_resent_transaction_is_dropped(spark):
    log = workload(12)
    resent = log + log[-4:]
    once = distinct_changes(frame(spark, resent))
    assert once.count() == 17


def test_typed_rows(spark):
    log = [
        announce(),
        message("I", 1, 0, new=tuple_(1, "a", 1.5)),
        message("U", 2, 0, new=tuple_(1, ..., "bad")),
        message("D", 3, 0, old=tuple_(1, None, None)),
    ]
    typed = typed_rows(frame(spark, log), [(c, o) for c, o, _ in COLUMNS], 1)
    assert rows(typed, "op", "id", "name", "name__sent", "score", "score__sent") == [
        ("c", 1, "a", True, 1.5, True),
        ("d", 1, None, True, None, True),
        ("u", 1, None, False, None, True),
    ]


def test_text_positions(spark):
    text = spark.createDataFrame(
        [(1, "C", 7, "0/10", 0, "0/12", "0/14", None, None, None, None, None, None)], CHANGE_LOG
    )
    row = with_positions(text).first()
    assert (row.commit_pos, row.wal_pos, row.end_pos) == (16, 18, 20)
    assert rows(commit_positions(with_positions(text))) == [(7, 16)]


def test_publication_filter_and_keepalives(spark):
    log = frame(
        spark,
        [
            announce(0, 0, 1),
            message("I", 1, 0, 1, new=tuple_(1, "a", 1)),
            message("I", 2, 0, 2, new=tuple_(1, "a", 1)),
            message("K", arrival=9, end_pos=77, reply_requested=True),
        ],
    )
    only = published_only(log, spark.createDataFrame([(1,)], "relation_id bigint"))
    assert rows(only, "kind", "relation_id") == [("I", 1), ("K", 1), ("R", 1)]
    assert rows(keepalives(log)) == [(9, 77, True)]


def test_wide_projection_is_not_fused(spark):
    """The value projection has to stay outside of whole-stage code."""
    log = frame(spark, [announce(), message("I", 1, 0, new=tuple_(1, "a", 1))])
    plan = decode_changes(log).select("value")._jdf.queryExecution().executedPlan().toString()
    assert "exists(" in plan




def test_versions_are_not_multiplied(spark):
    """Many relations and one with many versions: what is broadcast stays in proportion."""
    from rowtide.operators.relations import History

    versions = [(i, f"t{i}", (1, 0)) for i in range(400)] + [(0, f"v{i}", (10 + i, 0)) for i in range(300)]
    ddl = "relation_id bigint, table string, valid_from struct<commit_pos:bigint,ord:bigint>"
    known = History(spark.createDataFrame(versions, ddl))
    assert known.frame.count() <= 2 * len(versions)
    changes = spark.createDataFrame([(0, p, 0) for p in (1, 9, 10, 155, 400)] + [(7, 0, 0), (7, 1, 0)], "relation_id bigint, commit_pos bigint, ord bigint")
    got = rows(known.attach(changes), "relation_id", "commit_pos", "table")
    assert got == [(0, 1, "t0"), (0, 10, "v0"), (0, 155, "v145"), (0, 400, "v299"), (0, 9, "t0"), (7, 0, None), (7, 1, "t7")]


@pytest.mark.parametrize("small", [True, False])
def test_a_hot_relation_is_shuffled_once(spark, monkeypatch, tmp_path, small):
    """One relation holds 90 % of the changes; many others have a version or two."""
    from rowtide.operators.relations import History

    monkeypatch.setattr(relations, "LOCAL_VERSIONS", 0)
    if not small:
        monkeypatch.setattr(relations, "SLICED_RELATIONS", 0)
    at = F.struct(F.col("id").alias("commit_pos"), F.lit(0).cast("bigint").alias("ord"))
    hot = spark.range(0, 20_000, 40).select(F.lit(0).cast("bigint").alias("relation_id"), at.alias("valid_from"))
    cold = spark.range(6_000).select((F.col("id") % 3_000 + 1).alias("relation_id"), at.alias("valid_from"))
    versions = hot.unionByName(cold).withColumn("name", F.concat_ws(".", "relation_id", "valid_from.commit_pos"))
    rel = F.when(F.col("id") % 10 == 0, F.col("id") % 3_500 + 1).otherwise(0)
    spark.range(20_000).select(
        rel.alias("relation_id"), F.col("id").alias("commit_pos"), F.lit(1).cast("bigint").alias("ord")
    ).write.parquet(str(tmp_path / "changes"))
    changes = spark.read.parquet(str(tmp_path / "changes"))
    known = History(versions)
    got = {(r.relation_id, r.commit_pos): r.name for r in known.attach(changes).collect()}
    assert len(got) == 20_000
    for (relation, pos), name in got.items():
        if relation == 0:
            assert name == f"0.{pos // 40 * 40}"
        else:
            begun = [p for p in (relation - 1, relation + 2_999) if p <= pos and relation <= 3_000]
            assert name == (f"{relation}.{begun[-1]}" if begun else None)
    most = known.frame.groupBy("_relation_id", "_version_slice").count().agg({"count": "max"}).first()[0]
    assert most <= 3 * relations.CANDIDATES
    if small:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            plans = [d._jdf.queryExecution().sparkPlan().toString() for d in (known.attach(changes), known.frame)]
            joins = [p.count("SortMergeJoin") for p in plans]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        # One join more than the versions have themselves shuffles: that with the changes.
        assert joins[0] == joins[1] + 1


def test_a_delete_needs_its_key_alone(spark, encoder):
    full = [("id", 20, 1), ("name", 25, 1), ("score", 701, 1)]
    pk = spark.createDataFrame([("public.t", ["id"])], "table string, pk_columns array<string>")
    log = [
        announce(columns=full),
        message("D", 1, 0, old=tuple_(1, "a", "NaN")),
        message("D", 2, 0, old=tuple_(..., "a", 1)),
        message("U", 3, 0, old=tuple_(3, "a", 1), new=tuple_(..., "b", 1)),
    ]
    got = decoded(spark, log, pk=pk)
    assert [(r[2], r[4]) for r in got] == [
        ('{"id":1}', None),
        ('{"id":null}', "key_not_sent"),
        ('{"id":3}', None),
    ]
