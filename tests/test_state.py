from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from logs import COLUMNS, announce, frame, message, tuple_, workload
from rowtide.operators.decode import decode_changes, truncate_audit, typed_rows
from rowtide.operators.lineage import fill_moved
from rowtide.operators.messages import compact
from rowtide.operators.progress import with_boundary
from rowtide.operators.snapshot import snapshot_table
from rowtide.operators.state import current_table, fill_omitted, newest_per_key, table_as_of

TYPED = [(c, o) for c, o, _ in COLUMNS]


@pytest.mark.parametrize("n,events,live", [(12, 17, 10), (24, 34, 20), (100, 141, 84)])
def test_workload(spark, n, events, live):
    messages = decode_changes(frame(spark, workload(n)))
    assert messages.count() == events
    current = current_table(messages)
    assert current.count() == live
    if n == 12:
        keys = {r.key: r.op for r in current.collect()}
        assert '{"id":2}' not in keys and '{"id":8}' not in keys
        assert keys['{"id":6}'] == keys['{"id":10}'] == "u"


def test_any_order_split_or_replay_gives_the_same_table(spark):
    log = workload(60)
    columns = ("key", "op", "value", "commit_pos")
    want = rows(current_table(decode_changes(frame(spark, log))), *columns)
    history = frame(spark, log[:1]).select(
        "relation_id", "relation", F.struct("commit_pos", "ord").alias("valid_from")
    )
    rng = random.Random(5)
    for _ in range(3):
        mixed = log + rng.sample(log, 20)
        rng.shuffle(mixed)
        cut = rng.randrange(len(mixed))
        parts = [
            newest_per_key(decode_changes(frame(spark, part), history))
            for part in (mixed[:cut], mixed[cut:])
            if part
        ]
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        assert rows(current_table(both), *columns) == want


def test_snapshot_and_log_meet(spark):
    """Snapshot at a point plus later changes is the table at the end.

    The transaction that commits at the point is not in the snapshot, although
    its rows were written before.
    """
    log = workload(40)
    messages = decode_changes(frame(spark, log))
    end = rows(current_table(messages), "key", "value")
    for point in (10, 200, 350, 10_000):
        before = current_table(messages.filter(F.col("commit_pos") < point))
        fields = F.from_json("value", "id bigint, name string, score double")
        table = before.select(fields.alias("v")).select("v.*")
        snapshot = snapshot_table(table, "public.t", ["id"], position=point)
        both = with_boundary(snapshot, messages, point)
        assert rows(current_table(both.drop("consistent")), "key", "value") == end


def test_as_of(spark):
    messages = decode_changes(frame(spark, workload(12)))
    last = messages.agg(F.max("commit_pos")).first()[0]
    for position in (0, 50, 90, last):
        want = rows(current_table(messages.filter(F.col("commit_pos") <= position)), "key", "value")
        assert rows(table_as_of(messages, position), "key", "value") == want


def test_fill_omitted(spark):
    log = [
        announce(),
        message("I", 1, 0, new=tuple_(1, "big", 1)),
        message("U", 2, 0, new=tuple_(1, ..., 2)),
        message("I", 3, 0, new=tuple_(2, "two", 1)),
        message("D", 4, 0, old=tuple_(2, None, None)),
        message("U", 5, 0, new=tuple_(2, ..., 9)),
        message("I", 6, 0, new=tuple_(3, "x", 1)),
        message("U", 7, 0, new=tuple_(3, None, ...)),
        message("I", 8, 0, new=tuple_(4, "gone", 1)),
        message("D", 9, 0, old=tuple_(4, None, None)),
    ]
    filled = fill_omitted(typed_rows(frame(spark, log), TYPED, 1), ["id"], ["name", "score"])
    assert rows(filled, "id", "name", "score") == [(1, "big", 2.0), (2, None, 9.0), (3, None, 1.0)]


def test_truncates_apply_on_request(spark):
    log = frame(
        spark,
        [
            announce(),
            message("I", 1, 0, new=tuple_(1, "a", 1)),
            message("T", 2, 0, None, relation_ids=[1]),
            message("I", 3, 0, new=tuple_(2, "b", 1)),
        ],
    )
    messages = decode_changes(log)
    assert current_table(messages).count() == 2
    assert rows(current_table(messages, truncates=truncate_audit(log)), "key") == [('{"id":2}',)]


def test_moved_key(spark):
    log = [
        announce(),
        message("I", 1, 0, new=tuple_(1, "a", 1)),
        message("U", 2, 0, old=tuple_(1, None, None), new=tuple_(2, "a", 1)),
    ]
    assert current_table(decode_changes(frame(spark, log), old_key_tombstones=False)).count() == 2
    moved = current_table(decode_changes(frame(spark, log)))
    assert rows(moved, "key") == [('{"id":2}',)]


def test_compaction_keeps_tombstones(spark):
    topic = spark.createDataFrame(
        [(1, "a", "1"), (2, "b", "2"), (3, "a", None)], "offset bigint, key string, value string"
    )
    assert rows(compact(topic), "key", "offset", "value") == [("a", 3, None), ("b", 2, "2")]


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    messages = decode_changes(frame(spark, workload(12)))
    plan = current_table(messages)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_dead_letters_are_not_rows(spark):
    log = [announce(), message("I", 1, 0, 9, new=tuple_(1, "a", 1)), message("I", 2, 0, new=tuple_(1, "a", 1))]
    assert rows(current_table(decode_changes(frame(spark, log))), "key") == [('{"id":1}',)]


def replayed(log):
    """Rows after a log is applied change by change: key to its values."""
    table = {}
    for m in log:
        kind, old, new = m[1], m[10], m[11]
        if kind not in "IUD":
            continue
        if kind == "D":
            table.pop(old[0][1], None)
            continue
        key = new[0][1]
        row = table.pop(old[0][1], {}) if old and old[0][1] != key else dict(table.get(key, {}))
        row |= {i: data for i, (status, data) in enumerate(new) if i and status != "u"}
        table[key] = row
    return table


def random_moves(seed, n, keys, hot):
    """A log in which most changes fall on one key, and rows move and come back."""
    rng = random.Random(seed)
    log = [announce()]
    for pos in range(1, n + 1):
        key = 1 if rng.random() < hot else rng.randrange(1, keys)
        kind = rng.choice("IUUUUMMMD")
        name = rng.choice([..., ..., f"n{pos}", None])
        score = rng.choice([..., float(pos)])
        if kind == "I":
            log.append(message("I", pos // 3, pos % 3, new=tuple_(key, f"i{pos}", float(pos))))
        elif kind == "D":
            log.append(message("D", pos // 3, pos % 3, old=tuple_(key, None, None)))
        else:
            to = rng.randrange(1, keys) if kind == "M" else key
            old = tuple_(key, None, None) if kind == "M" else None
            log.append(message("U", pos // 3, pos % 3, old=old, new=tuple_(to, name, score)))
    return log


@pytest.mark.parametrize("seed,keys,hot", [(1, 6, 0.0), (2, 40, 0.0), (3, 12, 0.6), (4, 3, 0.9)])
def test_values_follow_moved_rows(spark, seed, keys, hot):
    log = random_moves(seed, 400, keys, hot)
    shuffled = log[:1] + random.Random(seed).sample(log[1:], len(log) - 1)
    typed = typed_rows(frame(spark, shuffled), TYPED, 1, old=["id"])
    got = {r.id: (r.name, r.score) for r in fill_moved(typed, ["id"], ["name", "score"]).collect()}
    want = {
        int(k): (v.get(1), None if v.get(2) is None else float(v[2])) for k, v in replayed(log).items()
    }
    assert got == want


def test_a_long_chain_of_moves(spark):
    log = [announce(), message("I", 1, 0, new=tuple_(1, "far", 1.0))]
    for i in range(1, 70):
        log.append(message("U", 1 + i, 0, old=tuple_(i, None, None), new=tuple_(i + 1, ..., ...)))
    typed = typed_rows(frame(spark, log), TYPED, 1, old=["id"])
    filled = fill_moved(typed, ["id"], ["name", "score"])
    assert rows(filled, "id", "name", "score") == [(70, "far", 1.0)]


def test_moves_of_an_empty_log(spark):
    typed = typed_rows(frame(spark, [announce()]), TYPED, 1, old=["id"])
    assert fill_moved(typed, ["id"], ["name", "score"]).count() == 0


def test_rounds_store_climbing_lives_alone(spark, monkeypatch):
    """Lives that know every value are stored once, however long the other chains are."""
    from rowtide.operators import lineage

    sizes, stored = [], lineage._stored

    def counted(rows, name):
        out = stored(rows, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(lineage, "_stored", counted)
    ddl = "op string, commit_pos bigint, ord bigint, k bigint, k__sent boolean, k__old bigint, v bigint, v__sent boolean"
    moves = [("u", i, 0, i + 1, True, i, None, False) for i in range(1, 9)]
    plain = [("u", 100 + i, 0, 1000 + i % 4, True, 1000 + (i - 1) % 4, i, True) for i in range(60)]
    log = [("c", 0, 0, 1, True, None, 7, True), *moves, *plain]
    live = lineage.fill_moved(spark.createDataFrame(log, ddl), ["k"], ["v"])
    assert (9, 7) in {(r.k, r.v) for r in live.select("k", "v").collect()}
    assert [name for name, _ in sizes[:3]] == ["moved-changes", "life-events", "lives"]
    rounds = [n for name, n in sizes if name == "climbed"]
    assert 1 < len(rounds) <= 5 and max(rounds) < 20 < sizes[2][1]
