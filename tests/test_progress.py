from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rowtide.operators.monitor import (
    differing_keys,
    differing_ranges,
    errors_by_stage,
    events_by_table_op,
    observe_messages,
    range_bits,
    range_digests,
    retention_alerts,
    rows_in_ranges,
    slot_health,
    snapshot_in_progress,
    table_topic_parity,
)
from rowtide.operators.progress import (
    all_snapshotted,
    bootstrap_decision,
    checkpoint_record,
    checkpoint_units,
    latest_units,
    load_checkpoint,
    pending_units,
    safe_position,
    skip_finished,
    start_positions,
)
from rowtide.operators.snapshot import snapshot_table
from rowtide.schemas import SLOT_STATUS, STATE_LOG, TOPIC_RECORD

LOG = "slot_name string, arrival bigint, kind string, wal_pos bigint, end_pos bigint, commit_pos bigint"


def fold(trace, start, last=None):
    """The rule, one message after the other."""
    pos, last = start, start if last is None else last
    for _, _, kind, wal, end, commit in trace:
        pos = max(pos, end if kind == "K" else wal)
        if kind == "C" and commit > last:
            pos = last = commit
    return pos, last


def safe(spark, trace, starts, **kw):
    ddl = "slot_name string, start_pos bigint" + (", last_commit bigint" if len(starts[0]) > 2 else "")
    log = spark.createDataFrame(trace, LOG)
    got = safe_position(log, spark.createDataFrame(starts, ddl), **kw)
    return {r.slot_name: (r.safe_pos, r.last_commit) for r in got.collect()}


def test_worked_trace(spark):
    trace = [
        ("s", 1, "I", 110, None, None),
        ("s", 2, "C", 120, None, 118),
        ("s", 3, "K", None, 500, None),
        ("s", 4, "C", 600, None, 510),
    ]
    for n, want in enumerate((110, 118, 500, 510), 1):
        assert safe(spark, trace[:n], [("s", 100)])["s"][0] == want
    assert safe(spark, trace, [("s", 100)], monotone=True)["s"][0] == 600
    assert safe(spark, trace[:1], [("s", 100), ("idle", 7)])["idle"] == (7, 7)


def test_random_traces(spark):
    rng = random.Random(3)
    trace, want, starts = [], {}, []
    for s in range(150):
        mine = []
        for a in range(rng.randrange(1, 9)):
            kind = rng.choice("ICK")
            mine.append((f"s{s}", a, kind, rng.randrange(60), rng.randrange(60), rng.randrange(60) if kind == "C" else None))
        starts.append((f"s{s}", rng.randrange(40)))
        want[f"s{s}"] = fold(mine, starts[-1][1])
        trace += mine
    rng.shuffle(trace)
    assert safe(spark, trace, starts) == want


def test_traces_cut_into_batches(spark):
    rng = random.Random(4)
    first, second, want, starts = [], [], {}, []
    for s in range(100):
        mine = [
            (f"s{s}", a, k, rng.randrange(60), rng.randrange(60), rng.randrange(60) if k == "C" else None)
            for a, k in enumerate(rng.choices("ICK", k=8))
        ]
        cut = rng.randrange(9)
        first += mine[:cut]
        second += mine[cut:]
        starts.append((f"s{s}", 5))
        want[f"s{s}"] = fold(mine, 5)
    middle = safe(spark, first, starts)
    assert safe(spark, second, [(s, *p) for s, p in middle.items()]) == want


GOOD = {"confirmed_lsn": "16/B374D848", "snapshots": {"public.t": {"done": True}, "public.u": {"done": False, "last_pk": [9007199254740993, "a"]}}, "updated_at": "2026-01-15T10:00:00Z"}


def topic(spark, *values, key="checkpoint", partition=0):
    data = [(partition, i, key, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, TOPIC_RECORD)


@pytest.mark.parametrize(
    "last", ["", None, "{broken", "[]", '"text"', {"confirmed_lsn": 5}, {"snapshots": []}, {"snapshots": {"u": {"done": 3}}}]
)
def test_bad_record_keeps_the_good_one(spark, last):
    found = load_checkpoint(topic(spark, GOOD, last))
    assert found.first()["confirmed_lsn"] == "16/B374D848"
    assert rows(checkpoint_units(found)) == [
        ("public.t", True, None),
        ("public.u", False, '[9007199254740993,"a"]'),
    ]


def test_later_record_replaces_the_whole(spark):
    found = load_checkpoint(topic(spark, GOOD, {"confirmed_lsn": "0/1", "snapshots": None}))
    assert found.first()["confirmed_lsn"] == "0/1" and found.first()["snapshots"] == {}
    assert load_checkpoint(topic(spark, GOOD, {})).first()["confirmed_lsn"] is None


def test_other_keys_and_partitions_do_not_count(spark):
    assert load_checkpoint(topic(spark, GOOD, key="x")).count() == 0
    assert load_checkpoint(topic(spark, GOOD, partition=1)).count() == 0
    assert load_checkpoint(topic(spark)).count() == 0


def test_checkpoint_record_reads_back(spark):
    units = spark.createDataFrame(
        [('public."t"', True, None), ("public.u", False, '[9007199254740993,"a"]')],
        "unit string, done boolean, last_pk string",
    )
    record = checkpoint_record(units, "0/10").withColumn("offset", F.lit(0).cast("bigint"))
    assert json.loads(record.first()["value"])["snapshots"]['public."t"'] == {"done": True}
    found = load_checkpoint(record)
    assert found.first()["confirmed_lsn"] == "0/10"
    assert rows(checkpoint_units(found)) == rows(units)


def state(spark, *data):
    return spark.sql("select 1").sparkSession.createDataFrame(
        [(u, d, p, __import__("datetime").datetime(2026, 1, 1, 0, 0, s)) for u, d, p, s in data], STATE_LOG
    )


def test_units(spark):
    log = state(spark, ("a", False, "[1]", 1), ("a", False, "[2]", 2), ("b", False, "[1]", 1), ("b", True, None, 3))
    now = latest_units(log)
    assert rows(now) == [("a", False, "[2]"), ("b", True, None)]
    units = spark.createDataFrame([("a",), ("b",), ("c",)], "unit string")
    assert rows(pending_units(units, now)) == [("a", "[2]"), ("c", None)]
    assert rows(skip_finished(units, now)) == [("a",), ("c",)]
    assert not all_snapshotted(units, now)
    assert all_snapshotted(units.filter("unit = 'b'"), now)
    named = units.withColumn("pipeline", F.when(F.col("unit") == "b", "y").otherwise("x"))
    assert rows(snapshot_in_progress(named, now)) == [("x", 1.0), ("y", 0.0)]


def test_start_positions(spark):
    slots = spark.createDataFrame([(s, "0/1") for s in "abcd"], "slot_name string, confirmed_flush_lsn string")
    saved = spark.createDataFrame([("a", "0/2"), ("d", "0/2")], "slot_name string, confirmed_lsn string")
    created = spark.createDataFrame([("b", "0/3"), ("d", "0/3")], "slot_name string, consistent_point string")
    assert rows(start_positions(slots, saved, created), "slot_name", "start_pos") == [("a", 2), ("b", 3), ("c", 1), ("d", 2)]
    bound = start_positions(slots, saved, created, bind_to_slot=True)
    assert rows(bound, "slot_name", "start_pos") == [("a", 2), ("b", 3), ("c", 1), ("d", 3)]


def test_bootstrap_decision(spark):
    objects = spark.createDataFrame([(s, u) for s in ("new", "half", "full", "again") for u in "xy"], "slot_name string, unit string")
    done = spark.createDataFrame(
        [("half", "x", True), ("half", "y", False), ("full", "x", True), ("full", "y", True), ("again", "x", True), ("again", "y", True)],
        "slot_name string, unit string, done boolean",
    )
    created = spark.createDataFrame([("new",), ("again",)], "slot_name string")
    assert rows(bootstrap_decision(objects, done, created)) == [
        ("again", "pinned_snapshot", 2),
        ("full", "stream", 0),
        ("half", "recovery_snapshot", 1),
        ("new", "pinned_snapshot", 2),
    ]


def test_slot_health(spark):
    at = __import__("datetime").datetime
    status = spark.createDataFrame(
        [
            (at(2026, 1, 1), "a", False, "0/0", "0/0", "0/0"),
            (at(2026, 1, 2), "a", True, "0/0", "0/5", "0/64"),
            (at(2026, 1, 1), "b", False, None, None, "0/64"),
            (at(2026, 1, 1), "c", True, "0/0", "0/0", "0/65"),
        ],
        SLOT_STATUS,
    )
    wanted = spark.createDataFrame([(s,) for s in "abcd"], "slot_name string")
    health = slot_health(wanted, status, warn_bytes=100)
    assert rows(health, "slot_name", "slot_active", "retained_bytes", "alert", "error") == [
        ("a", 1.0, 100, False, None),
        ("b", 0.0, 0, False, None),
        ("c", 1.0, 101, True, None),
        ("d", 0.0, None, False, "slot_missing"),
    ]
    assert rows(retention_alerts(health), "slot_name") == [("c",)]


def test_counters(spark):
    messages = spark.createDataFrame(
        [("t", "r", None), ("t", "c", None), ("t", "d", None), ("t", "d", "delete_without_old_tuple"), ("t", "u", "binary_tuple"), ("t", "r", "unencodable_float")],
        "table string, op string, error string",
    )
    assert rows(events_by_table_op(messages.filter("error is null"))) == [("t", "c", 1), ("t", "d", 1)]
    assert rows(errors_by_stage(messages.filter("error is not null"))) == [("update", 1)]
    seen_df, seen = observe_messages(messages)
    seen_df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"messages": 6, "snapshot_rows": 2, "tombstones": 2}


def test_parity(spark):
    table = snapshot_table(spark.range(5), "t", ["id"])
    topic_rows = snapshot_table(spark.range(1, 6), "t", ["id"])
    assert rows(table_topic_parity(table, topic_rows)) == [("t", 5, 5, 1, 1, False)]
    assert rows(table_topic_parity(table, table), "in_parity") == [(True,)]


def test_rows_are_compared_in_differing_ranges_alone(spark):
    keys = spark.range(20_000).select(F.lit("s.t").alias("table"), F.col("id").cast("string").alias("key"))
    source = keys.withColumn("value", F.concat(F.lit("v"), "key"))
    target = source.filter("key <> '77'").withColumn("value", F.when(F.col("key") == "500", "w").otherwise(F.col("value")))
    target = target.unionByName(spark.createDataFrame([("s.t", "x", "1")], "table string, key string, value string"))
    assert rows(differing_keys(source, target, 10)) == [("s.t", "500", "changed"), ("s.t", "77", "missing"), ("s.t", "x", "extra")]
    ranges = differing_ranges(range_digests(source, 10), range_digests(target, 10))
    assert 1 <= ranges.count() <= 3
    assert 1 <= rows_in_ranges(source, ranges, 10).count() <= 3 * 60
    assert range_digests(source, 10).count() <= 1024
    assert rows(differing_keys(source, source.repartition(3), 10)) == []
    assert (range_bits(0), range_bits(10_000), range_bits(10_001), range_bits(10**9)) == (0, 0, 1, 17)


@pytest.mark.parametrize("bits", [None, 0, 3])
@pytest.mark.parametrize("seed", range(2))
def test_differing_keys_match_a_count(spark, seed, bits):
    """Against multisets: NULL and empty keys and values, repeated rows, empty sides."""
    rng = random.Random(seed)
    ddl = "table string, key string, value string"

    def side(n):
        return [(rng.choice("ab"), rng.choice([None, "", *"cdefgh"]), rng.choice([None, "", "x"])) for _ in range(n)]

    for left, right in ((side(12), side(12)), ([], side(5)), (side(5), []), ([], [])):
        want = []
        for table, key in {r[:2] for r in left + right}:
            mine, other = (sorted((r for r in x if r[:2] == (table, key)), key=repr) for x in (left, right))
            if mine != other:
                want.append((table, key, "extra" if not mine else "missing" if not other else "changed"))
        got = rows(differing_keys(spark.createDataFrame(left, ddl), spark.createDataFrame(right, ddl), bits))
        assert got == sorted(want, key=repr)
