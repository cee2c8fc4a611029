"""Secret scans behind a trigram index.

Each rule is a regular expression. `trigram_query` reads its parse tree and
derives the trigrams that any match must contain, as an AND of ORs of ANDs. A
block of texts gets an inverted index: for each trigram of any rule, the sorted
numbers of the texts that contain it. A rule's postings are intersected and
united as its query says, and only the candidates are searched with the regular
expression. A rule without a necessary trigram searches every text.

The index is kept by block, as a segmented index would be: a block is built and
queried in the task that reads it, so nothing is shuffled, and its size is
bounded. Index and queries fold A-Z, so they serve rules that ignore case too.

Null texts are empty. Every input row gives one output row; repeated rows give
equal rows; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from re import _parser as parse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.shingles import LOWER, text_bytes
from rowtide.llm.workers import ship

#: Bytes of an index block, unless one text is longer.
BLOCK = 4 << 20
#: Strings that a piece of an expression may stand for before it counts as open.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. `group` of a match must have `least` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    flags: int = re.ASCII
    regex: re.Pattern = field(init=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "regex", re.compile(self.pattern, self.flags))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost matches that do not overlap, without those that are too short."""
        return [m.span() for m in self.regex.finditer(text) if len(m[self.group]) >= self.least]


# The kinds of secrets, in the order in which spans are listed.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        2,
        re.ASCII | re.IGNORECASE,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    # The same spans as [0-9a-f]+ with the shorter ones dropped.
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("github_pat", r"github_pat_[A-Za-z0-9_]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,2}PRIVATE KEY-----"),
    Rule("url_password", r"[a-z]{2,10}://[^\s:/@]{1,4096}+:[^\s:/@]{3,4096}+@"),
)

#: AND over the list, OR over each tuple, AND over the trigrams of each set.
Query = list[tuple[frozenset[bytes], ...]]


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """What a text must contain, folded to lower case, for the pattern to match."""
    query: Query = []
    _flush(_walk(parse.parse(pattern, flags), {""}, query), query)
    return query


def _flush(strings: set[str], query: Query) -> None:
    """Demand the strings' trigrams; one string without any demands nothing."""
    sets = {_trigrams(s) for s in strings}
    if all(sets):
        smallest = {s for s in sets if not any(o < s for o in sets)}
        query.append(tuple(sorted(smallest, key=sorted)))


def _trigrams(text: str) -> frozenset[bytes]:
    raw = text.lower().encode()
    return frozenset(raw[i : i + 3] for i in range(len(raw) - 2))


def _walk(nodes, strings: set[str], query: Query) -> set[str]:
    """The strings that may stand just before the end of `nodes`.

    Text before them has been flushed into the query: it is demanded too.
    """
    for op, value in nodes:
        options = _exact(op, value)
        if options is not None and len(strings) * len(options) <= MOST_STRINGS:
            strings = {s + o for s in strings for o in options}
            continue
        _flush(strings, query)
        strings = {""}
        if options is not None:
            strings = options if len(options) <= MOST_STRINGS else {""}
        elif op is parse.SUBPATTERN:
            strings = _walk(value[3], strings, query)
        elif op in (parse.MAX_REPEAT, parse.MIN_REPEAT, parse.POSSESSIVE_REPEAT) and value[0] > 0:
            # One turn is certain; more may follow it.
            _flush(_walk(value[2], {""}, query), query)
            strings = {""}
    return strings


def _exact(op, value) -> set[str] | None:
    """All strings that a node matches, if they are few."""
    if op is parse.LITERAL:
        return {chr(value)}
    if op is parse.AT:
        return {""}
    if op is parse.IN:
        out: set[str] = set()
        for kind, x in value:
            if kind is parse.LITERAL:
                out.add(chr(x))
            elif kind is parse.RANGE and x[1] - x[0] < 8:
                out.update(map(chr, range(x[0], x[1] + 1)))
            else:
                return None
        return out if len(out) <= 8 else None
    if op is parse.SUBPATTERN:
        return _sequence(value[3])
    if op is parse.BRANCH:
        parts = [_sequence(b) for b in value[1]]
        return None if None in parts else set().union(*parts)
    if op in (parse.MAX_REPEAT, parse.MIN_REPEAT, parse.POSSESSIVE_REPEAT):
        low, high, inner = value
        options = _sequence(inner)
        if options is None or high is parse.MAXREPEAT or high > 4:
            return None
        out, turn = set(), {""}
        for n in range(high + 1):
            if n >= low:
                out |= turn
            turn = {t + o for t in turn for o in options}
            if len(turn) > MOST_STRINGS:
                return None
        return out
    return None


def _sequence(nodes) -> set[str] | None:
    strings = {""}
    for op, value in nodes:
        options = _exact(op, value)
        if options is None or len(strings) * len(options) > MOST_STRINGS:
            return None
        strings = {s + o for s in strings for o in options}
    return strings


class TrigramIndex:
    """Postings of some trigrams over a block of texts."""

    def __init__(self, trigrams: Sequence[bytes]):
        self.number = {t: i + 1 for i, t in enumerate(trigrams)}
        kind = np.uint8 if len(trigrams) < 256 else np.uint16
        self.place = np.zeros(1 << 24, kind)
        for t, i in self.number.items():
            self.place[t[0] << 16 | t[1] << 8 | t[2]] = i

    def build(self, data: np.ndarray, ends: np.ndarray) -> dict[int, np.ndarray]:
        """For each trigram present, by number, the texts that contain it."""
        n = len(ends)
        pairs = [np.empty(0, np.int64)]
        # Windows overlap by the two bytes that a trigram may reach into the next.
        for begin in range(0, max(0, len(data) - 2), BLOCK):
            low = LOWER[data[begin : begin + BLOCK + 2]].astype(np.uint32)
            seen = self.place[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
            at = np.flatnonzero(seen)
            text = np.searchsorted(ends, at + begin, "right") - 1
            inside = at + begin + 3 <= ends[text + 1]
            pairs.append(np.unique(seen[at[inside]].astype(np.int64) * n + text[inside]))
        both = np.unique(np.concatenate(pairs))
        if not len(both):
            return {}
        number, text = np.divmod(both, n)
        cuts = np.flatnonzero(np.diff(number)) + 1
        return {int(k[0]): t for k, t in zip(np.split(number, cuts), np.split(text, cuts)) if len(k)}

    def candidates(self, postings: dict[int, np.ndarray], query: Query, texts: int) -> np.ndarray:
        """Texts that satisfy a query; all of them if it demands nothing."""
        found = np.arange(texts)
        none = np.empty(0, np.int64)
        for options in query:
            united = none
            for trigrams in options:
                lists = sorted((postings.get(self.number[t], none) for t in trigrams), key=len)
                both = lists[0]
                for other in lists[1:]:
                    both = np.intersect1d(both, other, assume_unique=True)
                united = np.union1d(united, both)
            found = np.intersect1d(found, united, assume_unique=True)
        return found


def scan_blocks(
    batch: pa.Array, rules: Sequence[Rule], index: TrigramIndex, queries: Sequence[Query]
) -> list[list[tuple[int, int, int]]]:
    """For each text its spans as (start, rule, end)."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(batch))]
    data, ends = text_bytes(batch)
    begin = 0
    while begin < len(batch):
        end = int(np.searchsorted(ends, ends[begin] + BLOCK, "right")) - 1
        end = min(max(end, begin + 1), len(batch))
        postings = index.build(data[ends[begin] : ends[end]], ends[begin : end + 1] - ends[begin])
        texts: dict[int, str] = {}
        for i, (rule, query) in enumerate(zip(rules, queries)):
            for place in index.candidates(postings, query, end - begin).tolist():
                at = begin + place
                if at not in texts:
                    texts[at] = batch[at].as_py() or ""
                out[at] += [(a, i, b) for a, b in rule.spans(texts[at])]
        begin = end
    return [sorted(spans) for spans in out]


def scan(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE) -> DataFrame:
    """`doc_id` and `spans`, an array of (kind, start, end) by start and rule."""
    queries = [trigram_query(r.pattern, r.flags) for r in rules]
    trigrams = sorted({t for q in queries for options in q for s in options for t in s})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TrigramIndex(trigrams)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = scan_blocks(batch.column(1), rules, index, queries)
            spans = [[{"kind": rules[i].kind, "start": a, "end": b} for a, i, b in x] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        search, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def digest(found: DataFrame, base: Sequence[Rule] = BASE) -> DataFrame:
    """Counts and hashes of the base kinds, and all spans as one text."""

    def listed(spans):
        text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(text, ",")

    kinds = [r.kind for r in base]
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[count_of(spans, k).alias(f"n_{k}") for k in kinds],
        F.sha2(listed(F.filter(spans, lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )
