"""Cross-tokenizer alignment (operator 12) against whole texts encoded one by one."""

from __future__ import annotations

import public_tokenizers
import pytest
from llm import brute
from llm.samples import prose, same, with_clashes
from rowtide.llm import alignment
from rowtide.llm.alignment import Aligner, align_corpus
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    " leading", "trailing ", "two  spaces", "a \n b", "a\n b", "a \nb", "\tb c", "x y z", " ", "\n", "  ",
    "<s> </s> <unk> <0x41> <|endoftext|> ok", "ﬁne Å naïve", "it's we'll THEY'RE", "▁ mark ▁▁", "a\x1cb c\x1c d",
    "\U0001f600 \U0001f600\U0001f600", "\x00 nul", "日本語 テキスト", "1234567 3.14 -- ...", "a b c 　 d", "é e ́",
]


@pytest.fixture(scope="module")
def libraries():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer, SentencePieceProcessor(model_file=B)


def test_edge_rows(spark, edge, libraries):
    rows = [*edge, *((100 + i, t) for i, t in enumerate(ODD)), (200, ODD[2]), (200, ODD[2])]
    same(align_corpus(with_clashes(spark, rows), A, B), COLUMNS, brute.alignment(rows, *libraries))


def test_documents(spark, documents, libraries):
    df, rows = documents
    same(align_corpus(df, A, B), COLUMNS, brute.alignment(rows, *libraries))


def test_pairs_joined_by_shuffling(spark, edge, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "is_small", lambda df, rows: False)
    rows = [*edge, *((100 + i, prose(i % 5, 40) + " zxqvk") for i in range(60))]
    same(align_corpus(with_clashes(spark, rows).repartition(3), A, B), COLUMNS, brute.alignment(rows, *libraries))


def _flat(found):
    counts, digests, links = found
    return counts.tolist(), digests, [x.tolist() for x in links]


def test_words_and_whole_texts_agree(documents, monkeypatch):
    """Parting at spaces, and a book that begins anew, change nothing."""
    texts = [t for _, t in documents[1]][:60] + ODD
    whole = Aligner(A, B)
    whole.words = alignment.Vocabularies(A, B)
    whole.words.words_apart = False
    whole.book = alignment.Book(whole.words)
    want = _flat(whole.align(texts))
    assert _flat(Aligner(A, B).align(texts)) == want
    monkeypatch.setattr(alignment, "JOINED", 50)
    assert _flat(Aligner(A, B).align(texts)) == want
    monkeypatch.setattr(alignment, "BOOK_WORDS", 100)
    small = Aligner(A, B)
    for begin in range(0, len(texts), 7):
        counts, digests, _ = small.align(texts[begin : begin + 7])
        assert (counts.tolist(), digests) == (want[0][begin : begin + 7], want[1][begin : begin + 7])


def test_identity_map():
    words = alignment.vocabularies(A, B)
    linked = [(a, b) for a, b in enumerate(words.same.tolist()) if b >= 0]
    assert len(linked) > 10_000
    assert all(words.bytes_a[a] == words.bytes_b[b] for a, b in linked)
    assert len({b for _, b in linked}) == len(linked)


def test_empty(spark, no_docs):
    assert align_corpus(no_docs, A, B).isEmpty()
