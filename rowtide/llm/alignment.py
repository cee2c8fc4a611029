"""Where the tokens of two tokenizers end together, and how often their ids meet.

A text is encoded by tokenizer A, with a space in front, and by tokenizer B,
which adds that space itself. Byte places where tokens of both end cut the text
into groups. The last tokens of a group end together: they are its one link, as
every token has at least one byte.

Most groups hold one token of each, with the same bytes. For these an identity
map, computed once, gives the B id of an A id, so that a link is known by its A id
alone: they are counted in vectors of the length of A's vocabulary, one a task.
Only the links of irregular groups go as pairs of ids through a shuffle. A pair is
counted in one of the two ways always: two tokens with equal bytes that end
together also begin together.

Both tokenizers cut at a single space between characters that are not white
space: A's pattern never crosses it, and no piece of B has a space after another
character (else texts are encoded whole). A text's groups are then those of its
words in turn, and words met before are looked up. A text whose tokens, joined,
are not the text with its space has no tokens; the same holds for its words.

Results: null and empty texts have no tokens; texts without tokens have zeros and
an empty `groups_sha256`. Every row counts, repeated ones too, and gives one row,
also without an id. An empty table gives none. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from rowtide.llm.folders import stored
from rowtide.llm.shingles import slices
from rowtide.llm.workers import ship
from rowtide.operators.sizes import is_small

# A task has one core; the library's own threads would take those of others.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words in a worker's book, about 400 bytes each, before it begins a new one.
#: The book changes the speed only, never the tokens.
BOOK_WORDS = 400_000
#: Characters of new words that are encoded as one text.
JOINED = 50_000
#: Bytes of texts that are held as words at once.
SLICE = 4 << 20
#: Irregular pairs that are broadcast at once, 16 bytes each; more are joined by shuffling.
BROADCAST_PAIRS = 1_000_000

# Fixed value: the mark that stands for a space in pieces.
SPACE_MARK = "▁"
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")

_ALIGNED = (
    "doc_id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, same array<int>, pairs array<int>"
)


def byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others follow from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the identity map."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        names = self.a.get_vocab()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            if name not in special:
                self.bytes_a[i] = bytes(letters[c] for c in name)
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        inner = re.compile(f"[^{SPACE_MARK}]{SPACE_MARK}")
        self.words_apart = not any(inner.search(self.b.id_to_piece(i)) for i in range(len(self.bytes_b)))
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Of B's ids with equal bytes the last one is taken: bytes come before pieces.
        known = {x: i for i, x in enumerate(self.bytes_b) if x}
        self.same = np.array([known.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)

    def _piece(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B for each text, or None where they do not spell it."""
        spaced = [f" {t}" for t in texts]
        ones = self.a.encode_batch_fast(spaced, add_special_tokens=False)
        twos = self.b.encode(texts, num_threads=1)
        for text, one, two in zip(spaced, ones, twos):
            raw = text.encode()
            a, b = one.ids, two
            if b"".join(map(self.bytes_a.__getitem__, a)) != raw:
                yield None
            elif b"".join(map(self.bytes_b.__getitem__, b)) != raw:
                yield None
            else:
                yield np.array(a, np.int64), np.array(b, np.int64)


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


class Book:
    """What is known of words: their groups as text, and their links.

    A word is known by its string if it neither begins nor ends with white space,
    else (at the ends of a text) by a tuple of it.
    """

    #: Kinds of words: aligned, to be parted otherwise, without tokens.
    GOOD, ODD, BAD = 0, 1, 2

    def __init__(self, words: Vocabularies):
        self.words = words
        self.index: dict[str | tuple[str], int] = {}
        self.groups: list[str] = []
        self.counts: list[tuple[int, int, int, int, int, int]] = []
        self.same: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self._names = [f"{a}|{b}" for a, b in enumerate(words.same.tolist())]
        self._settled = 0
        self.table = np.empty((0, 6), np.int64)

    def _enter(self, word, kind: int, groups: str = "", n_a=0, n_b=0, n_groups=0, n_same=0) -> None:
        self.index[word] = len(self.groups)
        self.groups.append(groups)
        self.counts.append((kind, n_a, n_b, n_groups, n_same, n_groups - n_same))

    def learn(self, words: list[str | tuple[str]]) -> None:
        plain: list[str] = []
        alone: list[str | tuple[str]] = []
        for word in words:
            if isinstance(word, tuple) or not self.words.words_apart:
                alone.append(word)
            elif not word or word[0].isspace() or word[-1].isspace():
                self._enter(word, self.ODD)
            else:
                plain.append(word)
        chunks: list[list[str]] = []
        size = JOINED
        for word in plain:
            if size + len(word) >= JOINED:
                chunks.append([])
                size = 0
            chunks[-1].append(word)
            size += len(word) + 1
        for chunk, ids in zip(chunks, self.words.encode([" ".join(c) for c in chunks])):
            if ids is None or not self._align(chunk, *ids):
                alone.extend(chunk)
        for at in range(0, len(alone), 1000):
            part = alone[at : at + 1000]
            texts = [w[0] if isinstance(w, tuple) else w for w in part]
            for word, ids in zip(part, self.words.encode(texts)):
                if ids is None or not len(ids[0]):
                    self._enter(word, self.BAD)
                else:
                    self._align([word], *ids)

    def _align(self, words: list, a: np.ndarray, b: np.ndarray) -> bool:
        """Enter words whose texts, each with a space in front, A and B encode as given."""
        voc = self.words
        ends_a, ends_b = np.cumsum(voc.length_a[a]), np.cumsum(voc.length_b[b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        texts = (w[0] if isinstance(w, tuple) else w for w in words)
        ends = np.cumsum([len(t.encode()) + 1 for t in texts])
        last = np.searchsorted(cuts, ends)
        if last[-1] >= len(cuts) or not np.array_equal(cuts[last], ends):
            return False
        to_a, to_b = np.searchsorted(ends_a, cuts) + 1, np.searchsorted(ends_b, cuts) + 1
        from_a, from_b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
        final_a, final_b = a[to_a - 1], b[to_b - 1]
        one = (to_a - from_a == 1) & (to_b - from_b == 1) & (voc.same[final_a] == final_b)
        codes = final_a * len(voc.bytes_b) + final_b
        names = list(map(self._names.__getitem__, final_a.tolist()))
        list_a, list_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        edges = np.stack([from_a, to_a, from_b, to_b], axis=1)
        for k in np.flatnonzero(~one).tolist():
            i, j, m, n = edges[k].tolist()
            names[k] = f"{','.join(list_a[i:j])}|{','.join(list_b[m:n])}"
        stop = last + 1
        begin = np.append(0, stop[:-1])
        n_one = np.append(0, np.cumsum(one))
        of_words = np.stack(
            [
                begin,
                stop,
                to_a[last] - from_a[begin],
                to_b[last] - from_b[begin],
                n_one[stop] - n_one[begin],
            ],
            axis=1,
        )
        for word, (i, j, n_a, n_b, n_same) in zip(words, of_words.tolist()):
            self._enter(word, self.GOOD, ";".join(names[i:j]), n_a, n_b, j - i, n_same)
        self.same.append(final_a[one].astype(np.int32))
        self.pairs.append(codes[~one].astype(np.int32))
        return True

    def settle(self) -> None:
        """Bring what was learned since the last call into arrays."""
        if self._settled == len(self.counts):
            return
        self._settled = len(self.counts)
        self.table = np.array(self.counts, np.int64).reshape(-1, 6)
        self.same = [np.concatenate([np.empty(0, np.int32), *self.same])]
        self.pairs = [np.concatenate([np.empty(0, np.int32), *self.pairs])]
        self.same_at = np.cumsum(self.table[:, 4]) - self.table[:, 4]
        self.pairs_at = np.cumsum(self.table[:, 5]) - self.table[:, 5]


def picked(values: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of values that begin at given places, one after the other."""
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - ends + sizes, sizes)]


class Aligner:
    """Aligns texts, with a book that begins anew when it is full."""

    def __init__(self, path_a: str, path_b: str):
        self.words = vocabularies(path_a, path_b)
        self.book = Book(self.words)

    def _look_up(self, words: list) -> list[int]:
        found = list(map(self.book.index.get, words))
        if None in found:
            self.book.learn(list(dict.fromkeys(w for w, i in zip(words, found) if i is None)))
            index = self.book.index
            found = [index[w] if i is None else i for w, i in zip(words, found)]
        return found

    def _parted(self, text: str) -> list:
        """Words of a text with white space beside its spaces."""
        words = _BETWEEN.split(text)
        return [(w,) if w[0].isspace() or w[-1].isspace() else w for w in words]

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], list[np.ndarray]]:
        """For each text its n_a, n_b, n_groups, its digest, and offsets and ids of both kinds of links."""
        if len(self.book.index) > BOOK_WORDS:
            self.book = Book(self.words)
        apart = self.words.words_apart
        parts = [((t.split(" ") if apart else [(t,)]) if t else []) for t in texts]
        flat = self._look_up([w for p in parts for w in p])
        self.book.settle()
        kinds = self.book.table[:, 0] if len(self.book.table) else np.empty(0, np.int64)
        of_texts, at = [], 0
        for part in parts:
            of_texts.append(flat[at : at + len(part)])
            at += len(part)
        worst = [int(kinds[ids].max()) if ids else Book.GOOD for ids in of_texts]
        for i in [i for i, kind in enumerate(worst) if kind != Book.GOOD]:
            if any(kinds[j] == Book.ODD for j in of_texts[i]):
                of_texts[i] = self._look_up(self._parted(texts[i]))
        self.book.settle()
        book = self.book
        kinds = book.table[:, 0] if len(book.table) else np.empty(0, np.int64)
        of_texts = [ids if not ids or not kinds[ids].any() else [] for ids in of_texts]
        groups = book.groups
        digests = [
            hashlib.sha256(";".join([groups[j] for j in ids]).encode()).hexdigest() if ids else ""
            for ids in of_texts
        ]
        ids = np.array([j for part in of_texts for j in part], np.int64)
        ends = np.cumsum([len(part) for part in of_texts])
        rows = book.table[ids] if len(ids) else np.empty((0, 6), np.int64)
        sums = np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(rows, axis=0)])
        totals = sums[ends] - sums[np.append(0, ends[:-1])]
        links = []
        if len(ids):
            same = picked(book.same[0], book.same_at[ids], rows[:, 4])
            pairs = picked(book.pairs[0], book.pairs_at[ids], rows[:, 5])
        else:
            same = pairs = np.empty(0, np.int32)
        for column, values in ((4, same), (5, pairs)):
            links += [np.append(0, np.cumsum(totals[:, column])).astype(np.int32), values]
        return totals[:, 1:4], digests, links


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner, with its book, for all tasks of a Python worker."""
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each text's counts and digest, and its links: `same` by A id, `pairs` as a * |B| + b."""
    width = len(vocabularies(path_a, path_b).bytes_b)
    if len(vocabularies(path_a, path_b).bytes_a) * width >= 1 << 31:
        raise ValueError("pairs of these vocabularies do not fit 32 bits")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for texts in slices(batch.column(2), SLICE):
                counts, digests, (at_same, same, at_pairs, pairs) = aligner(path_a, path_b).align(
                    texts.to_pylist()
                )
                own = batch.slice(begin, len(texts))
                begin += len(texts)
                columns = [own.column(0), own.column(1)]
                columns += [pa.array(counts[:, k]) for k in (0, 1, 2, 2)]
                columns.append(pa.array(digests, pa.string()))
                for at, values in ((at_same, same), (at_pairs, pairs)):
                    columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(values, pa.int32())))
                names = [c.split()[0] for c in _ALIGNED.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string"),
    )
    return rows.mapInArrow(align, _ALIGNED)


def same_counts(rows: DataFrame, size: int) -> np.ndarray:
    """How often each A id is linked through the identity map.

    Tasks count in vectors; at most `size` sums reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["a", "n"])

    sums = rows.select("same").mapInArrow(count, "a bigint, n bigint").groupBy("a").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for row in sums.collect():
        out[row.a] = row.n
    return out


def highest(same_n: np.ndarray, same: np.ndarray, pairs: DataFrame, size: int) -> np.ndarray:
    """The highest count of a pair with each B id; at most `size` rows reach the driver."""
    out = np.zeros(size, np.int64)
    linked = np.flatnonzero(same_n)
    np.maximum.at(out, same[linked], same_n[linked])
    for row in pairs.groupBy((F.col("pair") % size).alias("b")).agg(F.max("n").alias("n")).collect():
        out[row.b] = max(out[row.b], row.n)
    return out


def align_corpus(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's tokens, groups and links, its links weighed by the whole table's counts."""
    spark = docs.sparkSession
    words = vocabularies(path_a, path_b)
    same, width = words.same, len(words.bytes_b)
    rows = stored(aligned(docs, path_a, path_b), "aligned")
    n = same_counts(rows, len(same))
    exploded = rows.select("row", F.explode("pairs").alias("pair"))
    pairs = stored(exploded.groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    top = highest(n, same, pairs, width)
    best = n == np.where(same >= 0, top[same], -1)
    ship(spark)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(plain))
            ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            ids = lists.flatten().to_numpy()
            sums = [np.append(0, np.cumsum(x[ids].astype(np.int64))) for x in (n, best)]
            columns = [c for i, c in enumerate(batch.columns) if i != len(plain)]
            columns += [pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    plain = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links"]
    names = [*plain, "groups_sha256", "same_sum", "same_best"]
    kinds = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in names)
    weighed = rows.select(*plain, "same", "groups_sha256").mapInArrow(weigh, kinds)

    # At most one row for each B id.
    tops = F.broadcast(spark.createDataFrame(list(enumerate(top.tolist())), "b int, top bigint"))
    known = pairs.join(tops, F.col("pair") % width == F.col("b"))
    known = known.select("pair", "n", (F.col("n") == F.col("top")).cast("bigint").alias("best"))
    known = F.broadcast(known) if is_small(pairs, BROADCAST_PAIRS) else known
    irregular = exploded.join(known, "pair").groupBy("row").agg(
        F.sum("n").alias("pair_sum"), F.sum("best").alias("pair_best")
    )
    out = weighed.join(irregular, "row", "left")
    return out.select(
        "doc_id",
        *plain[2:],
        (F.col("same_best") + F.coalesce("pair_best", F.lit(0))).alias("n_best"),
        (F.col("same_sum") + F.coalesce("pair_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
