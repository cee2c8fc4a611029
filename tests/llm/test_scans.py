"""Secret, personal-data and license scans against brute force."""

from __future__ import annotations

from llm import brute
import pyarrow as pa
import pytest
from llm.samples import same
from rowtide.llm import licenses, pii, secrets
from rowtide.llm.queries import QUERIES
from rowtide.llm.shingles import ALNUM, text_shingles

SECRET = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
PRIVATE = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def test_secret_query(spark, small, documents):
    same(QUERIES["op1_secret_scan"](spark, small), SECRET, brute.secrets(documents[1]))


def test_secret_edges(edge_docs, edge, no_docs):
    found = secrets.digest(secrets.scan(edge_docs))
    same(found, SECRET, brute.secrets(edge))
    assert "github:" in found.filter("doc_id = 14").first()["spans"]
    assert secrets.scan(no_docs).count() == 0


def test_long_credentials(spark):
    token = "github_pat_" + "a1B2_" * 16 + "cd"
    texts = [(1, f"https://x:{token}@host"), (2, f"key {token}"), (3, f"https://{'u' * 90}:{'p' * 900}@host")]
    found = secrets.digest(secrets.scan(spark.createDataFrame(texts, "doc_id bigint, text string")))
    spans = {r.doc_id: r.spans for r in found.collect()}
    assert "github_pat:10:103" in spans[1] and "url_password:0:104" in spans[1]
    assert "github_pat:4:97" in spans[2]
    assert "url_password:0:1000" in spans[3]


def test_trigram_queries():
    query = {r.kind: secrets.trigram_query(r.pattern, r.flags) for r in secrets.BASE + secrets.MORE}
    assert query["hex"] == []
    assert query["access"] == [(frozenset({b"aki", b"kia"}),)]
    words = {frozenset(w[i : i + 3].encode() for i in range(len(w) - 2)) for w in ("passwd", "secret", "token")}
    options = query["assign"][0]
    assert all(any(w <= o for o in options) for w in words)
    assert all(len(q) for kind, q in query.items() if kind != "hex")


def test_index_finds_what_a_search_finds():
    texts = ["", "abc", "xabcx", "ABCD", "bcd", "ab", "c", "abd abc", "tokens"]
    index = secrets.TrigramIndex([b"abc", b"bcd"])
    data, ends = secrets.text_bytes(pa.array(texts))
    postings = index.build(data, ends)
    both = [(frozenset({b"abc", b"bcd"}),)]
    either = [(frozenset({b"abc"}), frozenset({b"bcd"}))]
    assert index.candidates(postings, both, len(texts)).tolist() == [3]
    assert index.candidates(postings, either, len(texts)).tolist() == [1, 2, 3, 4, 7]
    assert len(index.candidates(postings, [], len(texts))) == len(texts)


def test_candidates_miss_nothing(documents):
    """A scan of every text with every rule gives the same spans."""
    texts = pa.array([t for _, t in documents[1]])
    rules = secrets.BASE + secrets.MORE
    queries = [secrets.trigram_query(r.pattern, r.flags) for r in rules]
    trigrams = sorted({t for q in queries for o in q for s in o for t in s})
    got = secrets.scan_blocks(texts, rules, secrets.TrigramIndex(trigrams), queries)
    everything = secrets.scan_blocks(texts, rules, secrets.TrigramIndex(trigrams), [[] for _ in rules])
    assert got == everything


def test_private_query(spark, small, documents):
    same(QUERIES["op10_pii"](spark, small), PRIVATE, brute.private(documents[1]))


def test_private_edges(edge_docs, edge, no_docs):
    found = pii.digest(pii.scan(edge_docs))
    same(found, PRIVATE, brute.private(edge))
    spans = found.filter("doc_id = 17").first()["spans"]
    assert spans.count("iban:") == 2
    assert pii.scan(no_docs).count() == 0


def test_grouped_iban(spark):
    """Account numbers as they are printed, whose groups are no card."""
    good = ("DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947", "BE68 5390 0754 7034")
    rows = [(i, f"iban {x}, thanks") for i, x in enumerate(good)] + [(9, "iban DE88 3704 0044 0532 0130 00, thanks")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {r.doc_id: r.spans for r in pii.digest(pii.scan(docs)).collect()}
    assert all(f"iban:5:{5 + len(x)}" in spans[i] for i, x in enumerate(good)) and "iban" not in spans[9]
    texts = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert all(texts[i] == "iban [IBAN], thanks" for i in range(len(good)))


def test_context_raises_score(spark):
    rows = [(1, "write to a@b.de", None), (2, "zzz a@b.de", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, x string")
    scores = {r.doc_id: r.top_score for r in pii.digest(pii.scan(docs)).collect()}
    assert scores[1] > scores[2] > 0


def test_redaction(spark, edge_docs, edge):
    done = pii.redact(edge_docs)
    assert done.columns == edge_docs.columns and done.count() == len(edge)
    by_id = {r.doc_id: r for r in done.collect()}
    assert by_id[16].text == "card [CARD] or 4111-1111-1111-1112, call [PHONE]."
    assert by_id[16].n_chars == len(by_id[16].text)
    assert by_id[15].text.startswith("mail [EMAIL][EMAIL], a@b..c, [IP].5, 999")
    assert by_id[12].text == dict(edge)[12]
    assert pii.digest(pii.scan(done)).selectExpr("sum(n_email + n_card + n_phone)").first()[0] == 0


@pytest.mark.parametrize("number, good", [("4111111111111111", True), ("4111111111111112", False)])
def test_luhn(spark, number, good):
    df = spark.createDataFrame([(number,)], "n string")
    assert df.select(pii.luhn(df.n)).first()[0] == good == brute.luhn(number)


def license_names(rows):
    templates = licenses.templates_of(licenses.TEMPLATES)
    for doc_id, text in rows:
        shingles, _ = text_shingles(pa.array([text or ""]), ALNUM)
        names = set()
        for t in templates:
            for begin in range(0, len(shingles), t.size):
                if t.contained(shingles[begin : begin + 2 * t.size]) * 5 >= 4:
                    names.add(t.name)
        yield (doc_id, len(names), ",".join(sorted(names)))


def test_license_query(spark, small, documents):
    want = list(license_names(documents[1]))
    same(QUERIES["op7_license_scan"](spark, small), ("doc_id", "n_licenses", "licenses"), want)
    assert sum(w[1] for w in want) > 0


def test_license_edges(spark, edge_docs, edge, no_docs):
    same(licenses.scan(edge_docs), ("doc_id", "n_licenses", "licenses"), license_names(edge))
    assert licenses.scan(no_docs).count() == 0
    assert licenses.scan(edge_docs, {}).selectExpr("sum(n_licenses)").first()[0] == 0
    words = licenses.TEMPLATES["MIT"].split()
    words[10] = "anything"
    texts = [(1, "x " * 500 + " ".join(words)), (2, " ".join(words[:20]))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {r.doc_id: r.licenses for r in licenses.scan(docs).collect()} == {1: "MIT", 2: ""}
