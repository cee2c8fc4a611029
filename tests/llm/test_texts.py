"""Language identification, fingerprints, chat format, decontamination and the Jaccard join."""

from __future__ import annotations

from llm import brute
import numpy as np
import pyarrow as pa
import pytest
from llm.samples import prose, same, with_clashes
from pyspark.sql import functions as F
from rowtide.llm import chat, components as components_module, decontam, fingerprints, jaccard, langid
from rowtide.llm.components import components
from rowtide.llm.queries import QUERIES
from rowtide.llm.shingles import SPACED, text_shingles

HITS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
TURNS = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
EDITED = ("doc_id", "n_chars", "edited_sha256")


def test_language_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op2_language_id"](spark, small).join(docs, "doc_id").filter("held_out").collect()
    assert len(got) > 50
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(spark, edge_docs, edge, no_docs):
    got = {r.doc_id: r for r in langid.identify(edge_docs).collect()}
    assert langid.identify(edge_docs).count() == len(edge)
    assert {got[d].lang_pred for d in (1, 2, 12)} == {"und"} and got[1].score == 0
    assert got[8].lang_pred == "en"
    assert langid.identify(no_docs).count() == 0
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
    kept = langid.with_known_language(edge_docs)
    assert kept.columns == edge_docs.columns and kept.filter("doc_id IN (1, 2, 12)").isEmpty()


def test_language_stage_decides(spark):
    """Texts that no learned language explains go; short, clean and ambiguous ones stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    noise = ["xkq wvzzt qqj xxz bkq zvk", "Это русский текст", "日本語テキスト", "12 ...", None, ""]
    clean = ["the", "Dans la", "und der", "the house is big", "o"]
    planted = [(-1 - i, t, "en" if i % 2 else None) for i, t in enumerate(noise + clean)]
    both = docs.filter("doc_id >= 0").unionByName(spark.createDataFrame(planted, docs.schema))
    gone = {r.doc_id for r in both.join(langid.with_known_language(both), "doc_id", "left_anti").collect()}
    assert gone == {-1 - i for i in range(len(noise))}


def test_language_stage_without_labels(spark, edge_docs, no_docs):
    """Nothing can be learned: whatever has a letter stays."""
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    kept = langid.with_known_language(unlabelled)
    assert kept.columns == unlabelled.columns
    letters = [r for r in edge_docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert kept.count() == len(letters)
    assert langid.with_known_language(no_docs).isEmpty()


def test_held_out_by_crc(spark):
    import zlib

    df = spark.createDataFrame([(i,) for i in [None, *range(-5, 60)]], "doc_id bigint")
    for r in df.select("doc_id", langid.held_out().alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_grams_of_pieces_are_those_of_the_text(monkeypatch):
    text = prose(5, 4000)
    whole = np.sort(np.concatenate(list(langid.gram_buckets(text))))
    monkeypatch.setattr(langid, "PIECE", 1000)
    assert np.array_equal(whole, np.sort(np.concatenate(list(langid.gram_buckets(text)))))


def test_fingerprint_query(spark, small, documents):
    got = QUERIES["op4_fingerprints"](spark, small)
    same(got, EDITED, brute.edited(sorted(documents[1])))
    near, far = got.selectExpr("avg(near_edited)", "avg(near_next)").first()
    assert near > 0.4 > 0.1 > far


def test_fingerprint_edges(edge_docs, edge, no_docs):
    # Rows that share an id follow their text's hash: only the multiset of ids is fixed here.
    got = fingerprints.edited_fingerprints(edge_docs)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(d) for d, _ in edge)
    assert fingerprints.edited_fingerprints(no_docs).count() == 0
    single = with_clashes(edge_docs.sparkSession, [(7, "abcdefgh")])
    same(fingerprints.edited_fingerprints(single), EDITED, brute.edited([(7, "abcdefgh")]))
    ordered = [(d, t) for d, t in edge if d is not None and d not in (5, 8)]
    few = with_clashes(edge_docs.sparkSession, ordered)
    same(fingerprints.edited_fingerprints(few), EDITED, brute.edited(sorted(ordered)))


def exact(a: str, b: str) -> tuple[float, float]:
    x, y = brute.shingle_set(a), brute.shingle_set(b)
    return len(x & y) / len(x | y), len(x & y) / len(x)


@pytest.mark.parametrize("words, tolerance", [(60, 1e-9), (3000, 0.12)])
def test_sketch_estimates(words, tolerance):
    a = prose(11, words)
    b = " ".join(a.split()[: words * 3 // 4] + prose(12, words // 4).split())
    s, t = fingerprints.sketches(pa.array([a, b]))
    assert fingerprints.resemblance(s, t) == pytest.approx(exact(a, b)[0], abs=tolerance)
    assert fingerprints.containment(s, t) == pytest.approx(exact(a, b)[1], abs=max(tolerance, 1e-9))
    n = len(brute.shingle_set(a))
    assert fingerprints.distinct_shingles(s) == pytest.approx(n, rel=max(tolerance * 3, 1e-9))
    assert np.array_equal(fingerprints.from_text(fingerprints.to_text(s)), s)


def test_sketches_merge():
    words = prose(13, 900).split()
    parts = [" ".join(words[:504]), " ".join(words[500:])]
    a, b, whole = fingerprints.sketches(pa.array([*parts, " ".join(words)]))
    assert np.array_equal(fingerprints.merged(a, b), whole)


def test_shingles_match_plain_words(edge):
    texts = [t for _, t in edge]
    hashes, begins = text_shingles(pa.array(texts), SPACED)
    for text, a, b in zip(texts, begins[:-1], begins[1:]):
        assert len(np.unique(hashes[a:b])) == len(brute.shingle_set(text))


def test_chat_query(spark, small):
    turns = spark.read.parquet(f"{small}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    marks = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", marks), (-1, 1, "assistant", marks)]
    got = QUERIES["op5_chat_format"](spark, small)
    same(got, TURNS, brute.conversations(rows))
    assert got.filter("formatted_chars <= loss_chars").isEmpty()


def test_chat_edges(spark):
    rows = [
        (1, 2, "assistant", "b"),
        (1, 1, "user", "a<|im_sep|>\\<|"),
        (1, 2, "assistant", "b"),
        (1, 3, "assistant", "<\\|im_end|>\n\\n"),
        (1, None, None, None),
        (2, 1, "ro\nle<", "|im_start|>"),
        (2, 2, "assistant", ""),
        (3, 1, "assistant", "x" * 200_000),
        (None, 1, "user", "no id"),
    ]
    rows += [(4, i, "assistant" if i % 3 else "user", f"t{i}") for i in range(2000)]
    ddl = "conv_id bigint, turn bigint, role string, text string, turns int, pieces string"
    turns = spark.createDataFrame([(*r, 0, "") for r in rows], ddl)
    done = chat.format_conversations(turns)
    same(chat.digest(done), TURNS, brute.conversations(rows))
    blocks = done.filter("conv_id = 1").first()["formatted"].count(chat.START)
    assert blocks == 3
    assert chat.format_conversations(turns.limit(0)).count() == 0


def test_contamination_query(spark, small, documents):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    known = [tuple(r) for r in items.select("item_id", "text").collect()]
    want = list(brute.contamination(documents[1], known))
    same(QUERIES["op3_decontamination"](spark, small), HITS, want)
    assert any(w[-1] for w in want)


ITEMS = [
    (10, prose(3, 60)),
    (11, " ".join(prose(3, 60).split()[20:45])),
    (9, "ONE two"),
    (9, "Two one, three"),
    (None, prose(1, 20)),
    (12, None),
    (13, "..."),
    (14, "iota1 " * 30),
]


@pytest.mark.parametrize("most", [decontam.BROADCAST_WINDOWS, 0])
def test_contamination_edges(spark, edge_docs, edge, monkeypatch, most):
    """With and without broadcasting."""
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", most)
    rows = [*edge, (30, "iota1 " * 50), (31, prose(8, 300) + " " + prose(3, 60)[:200])]
    docs = with_clashes(spark, rows)
    items = spark.createDataFrame([(i, t, "k") for i, t in ITEMS], "item_id bigint, text string, key string")
    want = list(brute.contamination(rows, ITEMS))
    same(decontam.report(docs, items), HITS, want)
    left = decontam.without_contaminated(docs, items)
    assert left.columns == docs.columns
    assert left.count() == sum(not w[-1] for w in want)


def test_contamination_empty(spark, edge_docs, edge, no_docs):
    items = spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id bigint, text string")
    assert decontam.report(no_docs, items).count() == 0
    same(decontam.report(edge_docs, items.limit(0)), HITS, brute.contamination(edge, []))


def test_jaccard_query(spark, small, documents):
    want = brute.components(documents[1])
    same(QUERIES["op6_jaccard_join"](spark, small), ("doc_id", "n_shingles", "component_id"), want)


def copies(seed: int, n: int, words: int, edits: int) -> list[str]:
    import random

    pick, base, out = random.Random(seed), prose(seed, words).split(), []
    for _ in range(n):
        own = list(base)
        for _ in range(pick.randrange(edits + 1)):
            own[pick.randrange(words)] = f"new{pick.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_jaccard_edges(spark, edge, no_docs):
    """Chains of near copies around the threshold, in small tiles, with hot sets."""
    rows = list(edge)
    for i, texts in enumerate((copies(1, 40, 100, 6), copies(2, 30, 40, 3), copies(3, 40, 300, 14))):
        rows += [(100 * i + 100 + j, t) for j, t in enumerate(texts)]
    passage = prose(9, 30)
    rows += [(1000 + i, prose(50 + i, 20) + " " + passage) for i in range(30)]
    want = brute.components(rows)
    got = jaccard.link_components(with_clashes(spark, rows).repartition(3))
    same(got, ("doc_id", "n_shingles", "component_id"), want)
    assert jaccard.link_components(no_docs).count() == 0


def test_jaccard_small_tiles(spark, monkeypatch):
    """Blocks, bands and copies of hubs give what one tile gives."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "HUB_PAIRS", 2)
    monkeypatch.setattr(jaccard, "BROADCAST_SETS", 0)
    texts = copies(4, 40, 100, 7) + copies(5, 30, 120, 8)
    rows = list(enumerate(texts))
    got = jaccard.link_components(with_clashes(spark, rows))
    same(got, ("doc_id", "n_shingles", "component_id"), brute.components(rows))


def test_jaccard_links(spark, monkeypatch):
    """Every pair of classes and every row's number of links, in one tile and in several."""
    rows = list(enumerate(copies(4, 40, 100, 7) + copies(6, 30, 300, 4)))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (101, rows[50][1]), (102, ""), (103, None)]
    sets = [brute.shingle_set(t) for _, t in rows]
    alike = lambda x, y: x and y and 100 * len(x & y) >= 80 * len(x | y)
    counts = [(d, len(x), sum(i != j and bool(alike(x, y)) for j, y in enumerate(sets))) for i, ((d, _), x) in enumerate(zip(rows, sets))]
    classes = sorted(set(sets) - {frozenset()}, key=sorted)
    pairs = sum(bool(alike(x, y)) for i, x in enumerate(classes) for y in classes[:i])
    assert pairs > 2 * len(classes)
    docs = with_clashes(spark, rows)
    for block, size in ((jaccard.BLOCK, jaccard.BLOCK_BYTES), (4, jaccard.BLOCK_BYTES), (1_000, 2_000)):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        monkeypatch.setattr(jaccard, "BLOCK_BYTES", size)
        same(jaccard.link_counts(docs), ("doc_id", "n_shingles", "n_links"), counts)
        links, members = jaccard.class_links(docs)
        by_id = {r.class_id: r.n_shingles for r in members.collect()}
        got = [(r.a, r.b) for r in links.collect()]
        assert len(got) == len(set(got)) == pairs and all(a < b and {a, b} <= set(by_id) for a, b in got)


def test_one_of_each(spark, edge):
    docs = with_clashes(spark, edge)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    want = brute.components(edge)
    words = [w for w in want if w[1] > 0]
    # Rows without words stay, and two texts that are not alike share the id 8.
    assert len(got) == len(want) - len(words) + len({w[2] for w in words}) + 1
    assert (5, dict(edge)[5]) not in got or (-3, dict(edge)[-3]) not in got


def test_one_of_each_sends_members_not_pairs(spark, monkeypatch):
    """A group of near copies that are not all alike leaves its tiles as members alone."""
    rows = list(enumerate(copies(4, 40, 100, 7) + copies(2, 120, 100, 9)))
    sizes, stored = {}, jaccard.stored

    def counted(df, name):
        out = stored(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    kept = {r.doc_id for r in jaccard.one_of_each(with_clashes(spark, rows)).collect()}
    assert kept == {w[2] for w in brute.components(rows)}
    assert 0 < sizes["links"] <= sizes["candidates"]
    assert not {"stars", "star-links", "tile-pairs"} & set(sizes)


def test_jaccard_writes_few_files(spark, monkeypatch):
    """Small tables get few files, however many partitions a shuffle has."""
    files, stored = {}, jaccard.stored

    def counted(df, name):
        out = stored(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    for module in (jaccard, components_module):
        monkeypatch.setattr(module, "stored", counted)
    rows = list(enumerate(t for i in range(40) for t in copies(i, 6, 60, 3)))
    held = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = jaccard.link_components(with_clashes(spark, rows))
        files["result"] = got.rdd.getNumPartitions()
        same(got, ("doc_id", "n_shingles", "component_id"), brute.components(rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    most = max(8, spark.sparkContext.defaultParallelism)
    assert {"tokens", "candidates", "links"} <= set(files)
    assert all(n <= most for name, n in files.items() if name != "sets")


def test_jaccard_tile_holds_no_pairs(spark, monkeypatch):
    """Deciding a tile of near copies takes memory for its members, not for its pairs."""
    import tracemalloc

    class Tiles:
        def mapInArrow(self, decide, schema):
            return decide

    pick = np.random.default_rng(7)
    base = np.unique(pick.integers(0, 1 << 63, 100, np.uint64))
    token = int(base.min())
    sets = [np.unique(np.append(base, pick.integers(token + 1, 1 << 63, 4, np.uint64))) for _ in range(600)]
    docs = with_clashes(spark, [(1, "a b c d e f")])
    known, _, _ = jaccard.indexed(docs, jaccard.described(docs))
    monkeypatch.setattr(jaccard, "_dealt", lambda rows: Tiles())
    met = spark.createDataFrame([], jaccard._TILED)
    decide = jaccard.decided(docs, known, met, np.zeros(jaccard.CELLS, np.int64), False)
    n = len(sets)
    columns = [
        pa.array([token] * n),
        pa.array([""] * n),
        pa.array([len(s) for s in sets], pa.int32()),
        pa.array(range(n), pa.int64()),
        pa.array([0] * n, pa.int32()),
        pa.array([[]] * n, pa.list_(pa.int64())),
        pa.array([0] * n, pa.int32()),
        pa.array([s.tobytes() for s in sets], pa.binary()),
        pa.array([1] * n, pa.int64()),
    ]
    names = ["token", "tile", "n", "sid", "place", "ahead", "side", "shingles", "copies"]
    batch = pa.RecordBatch.from_arrays(columns, names)
    tracemalloc.start()
    try:
        (out,) = decide(iter([batch]))
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert out.to_pydict() == {"sid": list(range(n)), "others": [n - 1] * n, "root": [0] * n}
    assert most < 40 * n * (n - 1) // 2  # a list of pairs takes 70 bytes and more for each


def test_bitmaps_bound_from_below():
    pick = np.random.default_rng(3)
    for n in (3, 40, 200, 700):
        a = np.unique(pick.integers(0, 1 << 63, n, np.uint64))
        for share in (0.1, 0.5, 0.9, 1.0):
            b = np.unique(np.concatenate([a[: int(n * share)], pick.integers(0, 1 << 63, n // 3 + 1, np.uint64)]))
            real = len(np.setxor1d(a, b))
            assert jaccard.differing(jaccard.bitmap(a), jaccard.bitmap(b)) <= real


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (5, 5), (200, i := 205), (205, 210)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 200, 205: 200, 210: 200}
    assert components(df.limit(0)).count() == 0
