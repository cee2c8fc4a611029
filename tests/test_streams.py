from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from logs import announce, frame, message, tuple_, workload
from rowtide.operators.decode import decode_changes
from rowtide.operators.progress import load_checkpoint
from rowtide.operators.relations import described_versions, relation_versions
from rowtide.operators.state import current_table, newest_per_key
from rowtide.plans.bootstrap import bootstrap, pipeline_messages
from rowtide.plans.snapshot import SourceObject, read_state
from rowtide.queries import streams
from rowtide.schemas import MESSAGE
from rowtide.sources import change_log
from rowtide.sources.change_log import (
    land_change_log,
    landed_relations,
    position_of,
    read_change_log,
    stream_change_log,
)
from rowtide.sources.sinks import kafka_available, write_message_topic
from rowtide.streaming.capture import (
    _Prepared,
    captured_messages,
    checkpoint_topic,
    start_capture,
    stream_messages,
)
from rowtide.streaming.tables import fold_table, read_table, start_table
from rowtide.sources.tables import pin_cycle, read_cycle
from rowtide.streaming.views import pinned_views, refresh_once, start_pinned_refresh, start_refresh

COLUMNS = ("key", "op", "value", "commit_pos")


def capture(spark, folder, **kw):
    start_capture(
        stream_change_log(spark, f"{folder}/log"),
        folder,
        "s",
        relations=lambda: landed_relations(spark, f"{folder}/log"),
        path=f"{folder}/log",
        **kw,
    ).awaitTermination()


def commits(log):
    """A commit after every transaction, in arrival order."""
    out = []
    for i, m in enumerate(log):
        out.append((i * 2, *m[1:5], m[3], *m[6:]))
        if m[1] != "R":
            out.append(message("C", m[3], 1, arrival=i * 2 + 1, wal_pos=m[3] + 2))
    return out


def test_stream_equals_batch_across_restarts_and_replay(spark, tmp_path):
    folder = str(tmp_path)
    log = commits(workload(24))
    cut = len(log) // 2
    # The second stretch resends the last transactions of the first.
    for stretch in (log[:cut], log[cut - 4 :]):
        land_change_log(frame(spark, stretch), f"{folder}/log")
        capture(spark, folder)
    want = rows(decode_changes(frame(spark, log)), *COLUMNS)
    got = rows(captured_messages(spark, folder), *COLUMNS)
    assert sorted(set(got), key=repr) == want and len(got) >= len(want)

    start_table(stream_messages(spark, folder, 1), f"{folder}/table").awaitTermination()
    live = rows(current_table(decode_changes(frame(spark, log))), *COLUMNS)
    assert rows(read_table(spark, f"{folder}/table"), *COLUMNS) == live
    fold_table(spark, f"{folder}/table", f"{folder}/folded")
    assert rows(read_table(spark, f"{folder}/folded"), *COLUMNS) == live

    found = load_checkpoint(checkpoint_topic(spark, folder)).first()
    assert position_of(found["confirmed_lsn"], spark) == max(m[3] for m in log)


def test_relations_announced_in_an_earlier_batch(spark, tmp_path):
    folder = str(tmp_path)
    stretches = [
        [announce(), message("I", 10, 0, new=tuple_(1, "a", 1), wal_pos=10)],
        [message("I", 20, 0, new=tuple_(2, "b", 1), wal_pos=20)],
    ]
    from rowtide.schemas import POSITIONED_LOG

    for stretch in stretches:
        frame(spark, stretch).coalesce(1).write.mode("append").parquet(f"{folder}/topic")
        stream = spark.readStream.schema(POSITIONED_LOG).parquet(f"{folder}/topic")
        start_capture(stream, folder, "s").awaitTermination()
    assert rows(captured_messages(spark, folder), "key", "error") == [
        ('{"id":1}', None),
        ('{"id":2}', None),
    ]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """The offsets of the last batch are lost after its files were written."""
    import shutil

    folder = str(tmp_path)
    land_change_log(frame(spark, commits(workload(6))), f"{folder}/log")
    capture(spark, folder)
    first = rows(captured_messages(spark, folder), *COLUMNS)
    shutil.rmtree(f"{folder}/offsets/commits")
    capture(spark, folder)
    assert rows(captured_messages(spark, folder), *COLUMNS) == first


def test_dead_letters_have_their_own_topic(spark, tmp_path):
    folder = str(tmp_path)
    log = [announce(), message("I", 1, 0, 9, new=tuple_(1, "a", 1)), message("I", 2, 0, new=tuple_(1, "a", 1))]
    land_change_log(frame(spark, log), f"{folder}/log")
    capture(spark, folder)
    assert rows(captured_messages(spark, folder, "messages-dlq"), "error") == [("unknown_relation",)]
    assert captured_messages(spark, folder).count() == 1


def test_streaming_aggregate_equals_batch(spark, tmp_path):
    messages = decode_changes(frame(spark, workload(24)))
    messages.drop("relation_id").write.parquet(str(tmp_path / "m"))
    stream = spark.readStream.schema(f"{MESSAGE}, error string").parquet(str(tmp_path / "m"))
    q = newest_per_key(stream).writeStream.outputMode("complete").format("memory").queryName("live").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("live").filter("op <> 'd'"), *COLUMNS) == rows(current_table(messages), *COLUMNS)


def test_reading_from_a_start_position(spark, tmp_path):
    path = str(tmp_path / "log")
    land_change_log(frame(spark, commits(workload(24))), path)
    later = read_change_log(spark, path, start=200)
    assert later.filter("kind <> 'R' AND kind <> 'K'").agg(F.min("commit_pos")).first()[0] == 200
    assert later.filter("kind = 'R'").count() == 1
    plan = later.select("ord")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(commit_pos,200)" in plan


def test_bootstrap_snapshot_then_changes(spark, tmp_path):
    """From nothing, and again after the pipeline was stopped."""
    folder = str(tmp_path)
    log = commits(workload(24))
    point = 150
    fields = F.from_json("value", "id bigint, name string, score double")
    before = current_table(decode_changes(frame(spark, [m for m in log if m[3] < point])))
    table = before.select(fields.alias("v")).select("v.*")
    land_change_log(frame(spark, log), f"{folder}/log")
    objects = [SourceObject("public.t", "table", ("id",))]

    def run(at):
        bootstrap(
            spark,
            objects,
            lambda _: table,
            stream_change_log(spark, f"{folder}/log", start=point),
            folder,
            "s",
            at,
            point,
            relations=lambda: landed_relations(spark, f"{folder}/log"),
            path=f"{folder}/log",
        ).awaitTermination()

    def live():
        return rows(current_table(pipeline_messages(spark, folder)), "key", "value")

    want = rows(current_table(decode_changes(frame(spark, log))), "key", "value")
    run(point)
    assert live() == want
    run(None)
    assert live() == want
    assert read_state(spark, f"{folder}/state").first().done
    checkpoint = json.loads(checkpoint_topic(spark, folder).first()["value"])
    assert checkpoint["snapshots"] == {"public.t": {"done": True}}


def test_view_refresh(spark, tmp_path):
    out = str(tmp_path / "views")

    def broken():
        raise RuntimeError("view gone")

    assert refresh_once({"s.v": lambda: spark.range(2)}, out, 0)
    assert not refresh_once({"s.v": lambda: spark.range(2), "s.w": broken}, out, 1)
    assert refresh_once({"s.v": lambda: spark.range(3)}, out, 2)
    log = spark.read.schema(f"{MESSAGE}, error string, cycle int").parquet(out)
    assert rows(log.groupBy("cycle").count()) == [(0, 2), (2, 3)]
    assert start_refresh(spark, {}, out, 5, out) is None
    assert start_refresh(spark, {"s.v": lambda: spark.range(1)}, out, 0, out) is None


def test_kafka_needs_its_connector(spark):
    if kafka_available(spark):
        pytest.skip("connector present")
    messages = decode_changes(frame(spark, workload(2)))
    with pytest.raises(Exception, match="(?i)kafka"):
        write_message_topic(messages, "localhost:0", "t")


def test_views_are_refreshed_at_an_interval(spark, tmp_path):
    out = str(tmp_path / "views")
    query = start_refresh(spark, {"s.v": lambda: spark.range(2)}, out, 1, str(tmp_path / "ticks"))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    log = spark.read.schema(f"{MESSAGE}, error string, cycle int").parquet(out)
    counts = {r["count"] for r in log.groupBy("cycle").count().collect()}
    assert counts == {2}


def test_a_cycle_has_one_read_point(spark, tmp_path, monkeypatch):
    """Tables that grow while they are listed, repeats of a cycle, a manifest cut short."""
    paths = {"a": str(tmp_path / "a b"), "b": str(tmp_path / "b")}
    points = str(tmp_path / "points")
    for path in paths.values():
        spark.range(2).write.parquet(path)

    def add(_spark, *args):
        # A row reaches `a` after `a` was listed in the first round, then `b`.
        if len(grown) < 1:
            for path in paths.values():
                spark.range(1).write.mode("append").parquet(path)
            grown.append(1)
        return real(_spark, *args)

    grown = []
    real = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda r, *p: add(r, *p) if p == (paths["b"],) else real(r, *p))
    pin_cycle(spark, paths, points, 7)
    monkeypatch.undo()
    assert [read_cycle(spark, points, 7, t).count() for t in "ab"] == [3, 3]
    spark.range(5).write.mode("append").parquet(paths["a"])
    pin_cycle(spark, paths, points, 7)
    assert read_cycle(spark, points, 7, "a").count() == 3
    (tmp_path / "points" / "cycle=7" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="no read point"):
        read_cycle(spark, points, 7, "a")
    pin_cycle(spark, paths, points, 7)
    assert read_cycle(spark, points, 7, "a").count() == 8
    with pytest.raises(ValueError, match="not in cycle"):
        read_cycle(spark, points, 7, "c")
    views = {"s.a": lambda read: read("a"), "s.b": lambda read: read("b")}
    out = str(tmp_path / "views")
    assert refresh_once(pinned_views(spark, paths, views, points, 8), out, 8)
    assert rows(spark.read.parquet(out).groupBy("table").count()) == [("s.a", 8), ("s.b", 3)]


def test_pinned_views_are_refreshed_at_an_interval(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "views")
    spark.range(2).write.parquet(path)
    views = {"s.v": lambda read: read("t"), "s.w": lambda read: read("t")}
    points, ticks = str(tmp_path / "points"), str(tmp_path / "ticks")
    query = start_pinned_refresh(spark, {"t": path}, views, points, out, 1, ticks)
    try:
        # A cycle may take longer than a tick, so there is no end to wait for.
        deadline = time.monotonic() + 60
        while not query.recentProgress and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        query.stop()
    counts = spark.read.parquet(out).groupBy("cycle", "table").count()
    assert {r["count"] for r in counts.collect()} == {2}
    assert start_pinned_refresh(spark, {}, {}, points, out, 1, ticks) is None


def test_a_start_position_prunes_the_scan(spark, tmp_path):
    """Of a log of 200,000 changes the last hundredth reads a twentieth at most."""
    path = str(tmp_path / "log")
    n = 200_000
    ids = spark.range(n)
    from rowtide.queries.feed import log_rows

    log = log_rows(
        ids, "I", arrival=F.col("id"), commit_pos=F.col("id") + 10, ord=F.lit(0), relation_id=F.lit(1)
    ).unionByName(log_rows(ids.filter("id % 10 = 0"), "K", arrival=F.col("id"), end_pos=F.col("id") + 11))
    spark.conf.set("parquet.block.size", str(64 << 10))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land_change_log(log, path)
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    late = read_change_log(spark, path, start=n - n // 100 + 10).filter("kind = 'I'")
    changes = spark.read.schema("commit_pos bigint").parquet(f"{path}/changes")
    groups = changes.filter(F.col("commit_pos") >= n - n // 100 + 10)
    assert late.count() == n // 100
    execution = groups._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    read = [
        int(leaf.metrics().apply("numOutputRows").value())
        for leaf in leaves(execution.executedPlan())
        if leaf.metrics().contains("numOutputRows")
    ]
    assert read and sum(read) <= n // 20


def leaves(plan):
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def test_killed_after_any_batch(spark, tmp_path):
    """A restart from the confirmed position gets every change."""
    folder = str(tmp_path)
    log = commits(workload(24))
    for i in range(0, len(log), 12):
        land_change_log(frame(spark, log[i : i + 12]).repartition(3), f"{folder}/log")
    start_capture(
        stream_change_log(spark, f"{folder}/log", files_per_batch=1),
        folder,
        "s",
        relations=lambda: landed_relations(spark, f"{folder}/log"),
        path=f"{folder}/log",
    ).awaitTermination()
    done = spark.read.parquet(f"{folder}/progress").select("batch", "safe_pos").orderBy("batch").collect()
    messages = spark.read.parquet(f"{folder}/messages")
    published = {r.batch: set() for r in done}
    for r in messages.select("batch", "commit_pos", "ord").collect():
        published[r.batch].add((r.commit_pos, r.ord))
    every = set().union(*published.values())
    have = set()
    assert len(done) > 4
    for batch, safe in done:
        have |= published[batch]
        assert {p for p in every if p[0] >= safe} | have == every


def test_strict_stops_before_progress(spark, tmp_path):
    folder = str(tmp_path)
    land_change_log(frame(spark, [message("I", 1, 0, 9, new=tuple_(1, "a", 1))]), f"{folder}/log")
    with pytest.raises(Exception, match="unknown relation"):
        capture(spark, folder, strict=True)
    assert not (tmp_path / "progress").exists()


def test_landing_lost_at_each_write(spark, tmp_path, monkeypatch):
    """A landing that ends after any of its writes is captured, repeated, and never confirmed early."""
    folder, log = str(tmp_path), commits(workload(24))
    path = f"{folder}/log"
    half = len(log) // 2
    write = change_log._write
    for kept in (1, 2, 3, 4):
        done = []

        def dies(rows, folder, *rest, **more):
            if len(done) == kept:
                raise RuntimeError("lost")
            done.append(folder)
            write(rows, folder, *rest, **more)

        monkeypatch.setattr(change_log, "_write", dies)
        with pytest.raises(RuntimeError, match="lost"):
            land_change_log(frame(spark, log[: half + kept]), path)
        monkeypatch.setattr(change_log, "_write", write)
    assert change_log.landings(spark, path).isEmpty() and read_change_log(spark, path).filter("kind = 'I'").isEmpty()
    capture(spark, folder)
    progress = spark.read.parquet(f"{folder}/progress")
    assert {r.safe_pos for r in progress.collect()} == {0}
    assert land_change_log(frame(spark, log).repartition(3), path) == 0
    capture(spark, folder)
    from rowtide.queries.streams import confirmed_by_batch

    batches = confirmed_by_batch(spark, folder)
    assert batches.filter("safe_pos > unpublished").isEmpty() and batches.count() >= 2
    whole = read_change_log(spark, path)
    assert rows(current_table(captured_messages(spark, folder)), *COLUMNS) == rows(
        current_table(decode_changes(whole)), *COLUMNS
    )
    assert whole.filter("kind IN ('I', 'U', 'D')").count() == sum(m[1] in "IUD" for m in log)


def test_start_opens_only_the_pieces_it_needs(spark, tmp_path):
    path = f"{tmp_path}/log"
    log = commits(workload(24))
    for i in range(0, len(log), 16):
        land_change_log(frame(spark, log[i : i + 16]), path)
    changes = [m for m in log if m[1] != "R"]
    start = changes[-4][3]
    opened = [f for f in read_change_log(spark, path, start).inputFiles() if "/changes/" in f]
    stored = spark.read.parquet(f"{path}/changes").inputFiles()
    assert 0 < len(opened) < len(stored)
    got = read_change_log(spark, path, start).filter("kind NOT IN ('R', 'K')").count()
    assert got == sum(m[3] >= start for m in changes)
    assert read_change_log(spark, path, 2**62).filter("kind != 'R'").isEmpty()


def test_relations_are_prepared_once_while_they_stay(spark):
    prepared = _Prepared()
    log = [announce(1, 0, 0), announce(2, 0, 1)]
    versions = lambda n: described_versions(relation_versions(frame(spark, log[:n])))
    first = prepared.of(versions(1))
    assert prepared.of(versions(1)) is first
    second = prepared.of(versions(2))
    assert second is not first and len(second.rows) == 2
    assert prepared.of(versions(2)) is second


def test_batches_do_not_grow_with_partitions(spark, small):
    """A landing has a file for each partition, but is captured in parts of a set number."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "24")
    try:
        folder = streams.captured_after_loss(spark, small)
        assert streams.landed_files(spark, f"{folder}/log") > 24
        batches = streams.confirmed_by_batch(spark, folder)
        # Before, three files at a time.
        assert streams.PARTS < batches.count() <= 2 * streams.PARTS
        assert batches.filter("safe_pos > unpublished").isEmpty()
    finally:
        spark.conf.set(key, before)
