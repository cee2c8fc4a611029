from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rowtide.functions.keyset import last_cursor, read_cursor
from rowtide.functions.names import route
from rowtide.operators.messages import (
    in_wave,
    kafka_layout,
    ordered_by_key,
    position_waves,
    row_messages,
    split_quarantine,
)
from rowtide.operators.snapshot import (
    between,
    keyset_page,
    page_cursors,
    page_plan,
    range_pages,
    range_units,
    refresh_views,
    snapshot_partitioned,
    snapshot_table,
    snapshot_view,
)
from rowtide.plans.snapshot import SourceObject, read_state, run_snapshot
from rowtide.schemas import MESSAGE
from rowtide.sources.sinks import read_message_log, write_message_log
from rowtide.sources.tables import jdbc_options, pin_files, read_pinned


@pytest.fixture(scope="module")
def keyed(spark):
    """Composite keys; one leading value holds more than a third of the rows."""
    rng = random.Random(1)
    data = [(1 if i % 5 < 2 else rng.randrange(50), i, f"row {i}") for i in range(600)]
    return spark.createDataFrame(data, "a bigint, b bigint, text string").repartition(4)


PK = ["a", "b"]


def test_reading_page_after_page(keyed):
    want = rows(keyed)
    seen, cursor, cursors = [], None, []
    while True:
        page = keyset_page(keyed, PK, cursor, 150)
        got = [tuple(r) for r in page.collect()]
        seen += got
        if len(got) < 150:
            break
        saved = last_cursor(page, PK).first()["last_pk"]
        cursors.append(saved)
        cursor = read_cursor(saved, keyed, PK)
    assert seen == sorted(want)
    # 600 rows are a full multiple: a fifth, empty page ends the unit.
    assert len(cursors) == 4 and got == []
    at_once = page_cursors(keyed, PK, 150, slice_rows=100).orderBy("page_no").collect()
    assert [r.last_pk for r in at_once] == cursors


def test_page_plan(spark):
    counts = spark.createDataFrame([("u", 12000), ("v", 999), ("w", 0)], "unit string, rows bigint")
    assert rows(page_plan(counts, 1000), "unit", "pages", "last_page_rows") == [
        ("u", 13, 0),
        ("v", 1, 999),
        ("w", 1, 0),
    ]


def test_page_size_must_be_positive(keyed):
    for call in (lambda: keyset_page(keyed, PK, None, 0), lambda: range_units(keyed, PK, 0), lambda: page_cursors(keyed, PK, 0)):
        with pytest.raises(ValueError):
            call()


def test_ranges_are_disjoint_complete_and_even(keyed):
    units = range_units(keyed, PK, 100).orderBy("unit_no").collect()
    assert units[0].start is None and units[-1].end is None
    assert [u.end for u in units[:-1]] == [u.start for u in units[1:]]
    assert sum(u.rows for u in units) == 600
    # The hot leading value does not end up in one range.
    assert max(u.rows for u in units) < 200
    seen = []
    for u in units:
        part = between(keyed, PK, read_cursor(u.start, keyed, PK), read_cursor(u.end, keyed, PK))
        seen += rows(part)
    assert sorted(seen) == sorted(rows(keyed))


def test_range_pages_split_a_hot_value(keyed):
    sizes = range_pages(keyed, PK, 6).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 600 and max(r["count"] for r in sizes) < 200


def test_messages(spark):
    df = spark.createDataFrame([(2, "x", None), (1, "y", 1.5)], "id int, name string, v double")
    got = rows(snapshot_table(df, "s.t", ["id"], position=7, ts=F.lit(99)), "table", "op", "key", "value", "commit_pos", "ord", "ts", "consistent")
    assert got == [
        ("s.t", "r", '{"id":1}', '{"id":1,"name":"y","v":1.5}', 7, -1, 99, True),
        ("s.t", "r", '{"id":2}', '{"id":2,"name":"x","v":null}', 7, -1, 99, True),
    ]
    unpinned = snapshot_table(df, "s.t", ["id"])
    assert rows(unpinned, "commit_pos", "consistent") == [(None, False)] * 2
    assert rows(snapshot_view(df, "s.v"), "key") == [("{}",)] * 2
    assert rows(snapshot_view(df, "s.v", key=["id"]), "key") == [('{"id":1}',), ('{"id":2}',)]


def test_floats_that_json_cannot_carry(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("-inf")), (3, 0.5)], "id int, v double")
    good, bad = split_quarantine(row_messages(df, "s.t", ["id"]))
    assert rows(good, "key") == [('{"id":3}',)]
    assert rows(bad, "key", "error") == [('{"id":1}', "unencodable_float"), ('{"id":2}', "unencodable_float")]


def test_partitioned_root(spark):
    children = {
        n: spark.createDataFrame([(i,)], "id int") for i, n in enumerate(("p_01", "p_02", "p_default"))
    }
    got = snapshot_partitioned(spark, children, "s.root", ["id"])
    assert rows(got, "table", "unit") == [("s.root", "p_01"), ("s.root", "p_02"), ("s.root", "p_default")]
    empty = snapshot_partitioned(spark, {}, "s.root", ["id"])
    assert empty.count() == 0 and set(got.columns) == set(empty.columns)


def test_view_refresh(spark):
    views = {"s.a": spark.range(2), "s.b": spark.range(1)}
    assert rows(refresh_views(views, 4), "cycle_id", "table", "key") == [
        (4, "s.a", "{}"),
        (4, "s.a", "{}"),
        (4, "s.b", "{}"),
    ]
    assert refresh_views({}, 1) is None


def test_view_rows_are_spread_and_keys_kept_together(spark):
    view = snapshot_view(spark.range(400), "s.v")
    table = snapshot_table(spark.range(50).crossJoin(spark.range(4).toDF("x")), "s.t", ["id"])
    placed = ordered_by_key(view.unionByName(table), 8).withColumn("p", F.spark_partition_id())
    counts = {(r.table, r.key): r.parts for r in placed.groupBy("table", "key").agg(F.countDistinct("p").alias("parts")).collect()}
    assert counts.pop(("s.v", "{}")) == 8
    assert set(counts.values()) == {1}


def test_kafka_layout(spark):
    row = kafka_layout(snapshot_table(spark.range(1), "s.t", ["id"], 5)).first()
    assert (row.key, json.loads(row.value)) == ('{"id":0}', {"id": 0})
    assert [h.key for h in row.headers] == ["table", "op", "ts"]


def test_message_log_routes_dead_letters(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id int, v double")
    write_message_log(row_messages(df, "s.t", ["id"]), str(tmp_path / "log"), "out")
    assert rows(read_message_log(spark, str(tmp_path / "log"), "out"), "key") == [('{"id":2}',)]
    assert rows(read_message_log(spark, str(tmp_path / "log"), "out-dlq"), "key") == [('{"id":1}',)]


def test_pinned_files_hide_later_rows(spark, tmp_path):
    path, manifest = str(tmp_path / "t"), str(tmp_path / "m")
    spark.range(10).write.parquet(path)
    pin_files(spark, path, manifest)
    spark.range(5).write.mode("append").parquet(path)
    assert spark.read.parquet(path).count() == 15
    assert read_pinned(spark, manifest).count() == 10


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "public.t", 20000, "00-1", user="u")
    assert options["fetchsize"] == "20000" and "SET TRANSACTION SNAPSHOT '00-1'" in options["sessionInitStatement"]
    assert "sessionInitStatement" not in jdbc_options("jdbc:x", "public.t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", 0)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", exported_snapshot="a'; drop")


def published(spark, out):
    log = spark.read.schema(f"{MESSAGE}, error string, topic string, part string").parquet(out)
    return rows(log, "table", "key")


def test_snapshot_job_resumes(spark, keyed, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    children = {"s.r_1": spark.range(5), "s.r_2": spark.range(5, 8)}
    tables = {"s.t": keyed, "s.v": spark.range(3), **children}
    objects = [
        SourceObject("s.t", "table", tuple(PK)),
        SourceObject("s.root", "part_root", ("id",), tuple(children)),
        SourceObject("s.none", "part_root", ("id",)),
        SourceObject("s.v", "view"),
    ]
    reads = []

    def failing(name):
        reads.append(name)
        if name == "s.r_1":
            raise RuntimeError("connection lost")
        return tables[name]

    with pytest.raises(RuntimeError):
        run_snapshot(spark, objects, failing, out, state, 100, rows_per_wave=150)
    saved = {r.unit: (r.done, r.last_pk) for r in read_state(spark, state).collect()}
    assert saved == {"s.t": (True, None)}
    reads.clear()
    run_snapshot(spark, objects, lambda n: reads.append(n) or tables[n], out, state, 100)
    assert "s.t" not in reads
    got = published(spark, out)
    assert len(got) == len(set(got)) + 2  # the view's three rows share a key
    assert len([g for g in got if g[0] == "s.t"]) == 600
    assert len([g for g in got if g[0] == "s.root"]) == 8
    saved = {r.unit: r.done for r in read_state(spark, state).collect()}
    assert saved == dict.fromkeys(["s.t", "s.root", "s.none", "s.v", "s.r_1", "s.r_2"], True)
    run_snapshot(spark, objects, lambda n: pytest.fail(n), out, state, 100)


def test_snapshot_job_goes_on_from_a_cursor(spark, keyed, tmp_path, monkeypatch):
    """Lost between writing a wave and saving it: the wave is repeated in place."""
    from rowtide.plans import snapshot

    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    objects = [SourceObject("s.t", "table", tuple(PK))]
    save, calls = snapshot._save, []

    def flaky(*args):
        calls.append(args)
        if len(calls) == 3:
            raise RuntimeError("lost")
        save(*args)

    monkeypatch.setattr(snapshot, "_save", flaky)
    with pytest.raises(RuntimeError):
        run_snapshot(spark, objects, lambda _: keyed, out, state, 100, rows_per_wave=120)
    begun = read_state(spark, state).first()
    assert not begun.done and begun.last_pk
    run_snapshot(spark, objects, lambda _: keyed, out, state, 100, rows_per_wave=120)
    got = published(spark, out)
    assert set(got) == {("s.t", f'{{"a":{a},"b":{b}}}') for a, b, _ in rows(keyed)}
    assert read_state(spark, state).first().done


def test_bulk_load(spark):
    """Twelve thousand seeded rows over 58 days lie in two months."""
    seed = F.rand(7)
    bulk = spark.range(1, 12001).select(
        "id",
        F.concat(F.lit("Customer "), "id").alias("name"),
        F.round(seed * 500, 2).alias("amount"),
        (F.lit("2026-01-01").cast("timestamp") + F.make_interval(secs=F.floor(seed * 58 * 86400))).alias("created_at"),
    )
    ranges = [("2026_01", "2026-01-01", "2026-02-01"), ("2026_02", "2026-02-01", "2026-03-01")]
    child = route(F.col("created_at"), ranges, "default").alias("unit")
    counts = bulk.groupBy(child).agg(F.count("*").alias("rows"))
    assert {r.unit for r in counts.collect()} == {"2026_01", "2026_02"}
    whole = bulk.agg(F.lit("all").alias("unit"), F.count("*").alias("rows"))
    assert rows(page_plan(whole, 1000), "pages", "last_page_rows") == [(13, 0)]
    assert page_cursors(bulk, ["id"], 1000, slice_rows=5000).count() == 12


def test_publishing_in_waves(spark):
    """Disjoint, complete and in order, whatever the positions look like."""
    positions = [None, None] + [7] * 300 + list(range(400))
    log = spark.createDataFrame([(p, i) for i, p in enumerate(positions)], "commit_pos bigint, i int")
    for size in (10, 100, 10_000):
        waves = position_waves(log, size)
        parts = [rows(log.filter(in_wave(w))) for w in waves[:20]]
        if len(waves) <= 20:
            assert sorted(sum(parts, []), key=repr) == rows(log)
        tops = [max(p for p, _ in part if p is not None) for part in parts]
        lows = [min(p for p, _ in part if p is not None) for part in parts]
        assert all(a < b for a, b in zip(tops, lows[1:]))
    assert position_waves(log, 10_000) == [(None, None)]
    assert position_waves(log.filter("i < 0"), 10) == [(None, None)]
