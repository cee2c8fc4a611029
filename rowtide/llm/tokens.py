"""Token ids of whole texts with a public tokenizer file, inside tasks."""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# A task has one core; the library's own threads would take those of others.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END = 1
#: Words in each of the two generations of a worker's cache, about 200 bytes
#: each. The cache changes the speed only, never the ids.
CACHED_WORDS = 350_000
LONGEST_CACHED = 64
SEGMENT = 1_000_000
#: Bytes of texts whose words are looked up together, each different one once.
BLOCK = 4_000_000
#: Words that a call of the tokenizer takes: it holds many times their size.
AT_ONCE = 1_000
WORD_END = "</w>"
#: Letters and digits that stay such in NFC and lower case: the tokenizer parts them from punctuation
#: (not U+0130, which gets a mark). Words of others are looked up with their punctuation.
_RANGES = (
    (0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0xC0, 0xD7), (0xD8, 0xF7), (0xF8, 0x130),
    (0x131, 0x250), (0x3B1, 0x3CA), (0x400, 0x482),
)
LETTERS = "".join(chr(c) for begin, end in _RANGES for c in range(begin, end))

# Lower case is the same by character and by text in Latin-1.
_NOT_LATIN = r"[^\x00-\x{ff}]"
_NOTHING = pa.scalar(b"", pa.large_binary())
_SPACE = re.compile(r"[ \n\t]")


class Encoder:
    """Ids of texts.

    `words_apart` is for tokenizers that drop white space and never merge
    across it: a text's ids are then those of its words in turn, and words
    seen before are looked up. Other tokenizers take whole texts. Words are
    parted at ASCII white space alone; the tokenizer parts them at the rest.
    """

    def __init__(self, path: str, words_apart: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        self.words_apart = words_apart
        vocabulary = self.tokenizer.get_vocab()
        self.code = "H" if max(vocabulary.values()) < 1 << 16 else "I"
        self.width = np.dtype(self.code)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit integers, without special tokens added."""
        return next(self.ids_of(pa.array([text], pa.string())))

    def ids_of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text in turn; a null text is empty."""
        if not self.words_apart:
            for text in texts:
                encoding = self.tokenizer.encode(text.as_py() or "", add_special_tokens=False)
                yield np.array(encoding.ids, np.uint32)
            return
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for begin, end in blocks(sizes):
            if sizes[begin] > BLOCK:
                parts = segments(texts[begin].as_py())
                yield np.concatenate([ids for part in parts for ids in self._block(pa.array([part]))])
            else:
                yield from self._block(texts.slice(begin, end - begin))

    def _block(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, by its words' places among the different words of all."""
        words = pc.ascii_split_whitespace(texts)
        counts = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
        each = words.flatten().dictionary_encode()
        del words
        raw = self._raws(each.dictionary).take(each.indices)
        del each
        ends = np.cumsum([0, *counts])
        cuts = pc.binary_length(raw).to_numpy().cumsum()
        cuts = np.append(0, cuts)[ends] // self.width.itemsize
        ids = np.frombuffer(raw.buffers()[2] or b"", self.width, cuts[-1])
        del raw
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield ids[a:b].astype(np.uint32)

    def _raws(self, words: pa.Array) -> pa.Array:
        """Ids of words. Letters followed by punctuation are looked up as two words."""
        low = pc.if_else(pc.match_substring_regex(words, _NOT_LATIN), words, pc.utf8_lower(words))
        core, tail = pc.ascii_rtrim(low, string.punctuation), pc.utf8_ltrim(low, LETTERS)
        parted = pc.equal(pc.add(pc.binary_length(core), pc.binary_length(tail)), pc.binary_length(low))
        core, tail = pc.if_else(parted, core, low), pc.if_else(parted, tail, pa.scalar("", low.type))
        return pc.binary_join_element_wise(self._looked_up(core), self._looked_up(tail), _NOTHING)

    def _looked_up(self, words: pa.Array) -> pa.Array:
        """Ids of words, from the cache or learned."""
        each = words.dictionary_encode()
        # Joined and split again: pyarrow's own list of texts takes ten times as long.
        whole = pa.array([0, len(each.dictionary)], pa.int32())
        whole = pa.ListArray.from_arrays(whole, each.dictionary)
        joined = pc.binary_join(whole, pa.scalar("\n", words.type))
        different = joined[0].as_py().split("\n")
        raws = list(map(self.young.get, different))
        missing = {word for word, raw in zip(different, raws) if raw is None}
        if missing:
            learned = self._learn(missing)
            raws = [learned[w] if raw is None else raw for w, raw in zip(different, raws)]
        return pa.array(raws, pa.large_binary()).take(each.indices)

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that the young generation lacks, which then has them."""
        fresh = words.difference(self.old)
        again = words - fresh
        out = dict(zip(again, map(self.old.__getitem__, again)))
        plain = list(filter(str.isalpha, fresh))
        odd = list(fresh.difference(plain))
        for words_of, encode in ((plain, self._letters), (odd, self._apart)):
            for i in range(0, len(words_of), AT_ONCE):
                out.update(encode(words_of[i : i + AT_ONCE]))
        if len(self.young) + len(out) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        if max(map(len, out)) > LONGEST_CACHED:
            self.young.update((w, raw) for w, raw in out.items() if len(w) <= LONGEST_CACHED)
        else:
            self.young.update(out)
        return out

    def _letters(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters alone, encoded as one text and cut where words end."""
        whole = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(whole.ids, self.width)
        cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.width.itemsize).tolist()
        if len(cuts) != len(words):
            return self._apart(words)
        raw = ids.tobytes()
        return {w: raw[a:b] for w, a, b in zip(words, [0, *cuts], cuts)}

    def _apart(self, words: list[str]) -> dict[str, bytes]:
        encodings = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return {w: array(self.code, e.ids).tobytes() for w, e in zip(words, encodings)}


def blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """First and last place, exclusive, of texts of `BLOCK` bytes at most, or of a longer one."""
    begin = held = 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > BLOCK:
            yield begin, i
            begin, held = i, 0
        held += size
    if sizes:
        yield begin, len(sizes)


def segments(text: str):
    """A long text cut at white space, so that its word list stays small."""
    begin = 0
    while len(text) - begin > SEGMENT:
        space = _SPACE.search(text, begin + SEGMENT)
        if space is None:
            break
        yield text[begin : space.end()]
        begin = space.end()
    yield text[begin:]


@lru_cache(maxsize=4)
def encoder(path: str, words_apart: bool = True) -> Encoder:
    """One encoder, with its cache, for all tasks of a Python worker."""
    return Encoder(path, words_apart)


def ids_with_end(path: str, texts: pa.Array, words_apart: bool = True) -> Iterator[np.ndarray]:
    """Ids of each text in turn, with the end id."""
    for ids in encoder(path, words_apart).ids_of(texts):
        yield np.append(ids, np.uint32(END))
