"""Brute-force versions, row by row in plain Python."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


SECRETS = [
    (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.I | re.A,
        ),
        lambda m: len(m[2]) >= 12,
        "assign",
    ),
    (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18, "access"),
    (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16, "hex"),
]


def secrets(rows):
    for doc_id, text in rows:
        spans, counts = [], []
        for k, (pattern, good, name) in enumerate(SECRETS):
            own = [m.span() for m in pattern.finditer(text or "") if good(m)]
            counts.append(len(own))
            spans += [(a, k, f"{name}:{a}:{b}") for a, b in own]
        yield (doc_id, *counts, sha(",".join(s[2] for s in sorted(spans))))


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def card(match: str) -> bool:
    number = re.sub("[ -]", "", match)
    return 13 <= len(number) <= 19 and luhn(number)


PRIVATE = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True, "email"),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split(".")), "ip"),
    (r"[0-9]([\x20-]?[0-9])+", card, "card"),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15, "phone"),
]


def private(rows):
    for doc_id, text in rows:
        spans, counts = [], []
        for pattern, good, name in PRIVATE:
            own = [m for m in re.finditer(pattern, text or "") if good(m[0])]
            counts.append(len(own))
            spans += [f"{name}:{m.start()}:{m.end()}" for m in own]
        yield (doc_id, *counts, sha(",".join(spans)))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items, window=13):
    known = defaultdict(set)
    for item_id, text in items:
        w = tuple(WORD.findall((text or "").translate(LOWER)))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            known[w[i : i + n]] |= {str(item_id)} if item_id is not None else set()
    sizes = {len(w) for w in known}
    for doc_id, text in rows:
        w = tuple(WORD.findall((text or "").translate(LOWER)))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if w[i : i + n] in known:
                    hit |= set(range(i, i + n))
                    found |= known[w[i : i + n]]
        bad = bool(hit) and 20 * len(hit) >= len(w)
        yield (doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), bad)


def edited(rows):
    """Rows in document order."""
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        yield (doc_id, len(text), sha(text[: len(text) - cut] + after[:cut]))


def conversations(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        turns[conv_id].append((turn is not None, turn, role or "", text or ""))
    for conv_id, own in turns.items():
        own.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        learned = "".join(t[3] for t in own if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in own)
        yield (conv_id, len(own), sha(whole), len(learned), sha(learned))


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(rows):
    """Rows by place; the component is the smallest id."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                if 100 * len(a & b) >= 80 * len(a | b):
                    root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = find(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    return [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def crc(ids) -> int:
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def failing(rows):
    """The filters that each row of (doc_id, text) fails."""
    least = {}
    for doc_id, text in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    for doc_id, text in rows:
        text = text or ""
        w = SPACED.findall(text)
        fails = "A" if len(w) < 100 else ""
        fails += "B" if 100 * len(set(w)) < 80 * len(w) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
        fails += "D" if re.search("[#$%&*|]", text) else ""
        fails += "E" if doc_id is not None and doc_id > least[text] else ""
        yield fails


def audit(rows, filters):
    """Rows of (part, failing filters, good, toxic), filtered in every order, document by document."""
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        steps, ever = [], dict.fromkeys(filters, 0)
        for order in itertools.permutations(filters):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                ever[f] += len(gone)
                redundant = sum(f in r[1] for r in own) - len(gone)
                lost = (sum(r[2] for r in gone), sum(r[3] for r in gone))
                steps.append((part, "".join(order), step, f, len(left), len(gone), redundant, *lost))
        for part, order, step, f, kept, removed, redundant, good, toxic in steps:
            alone = sum(r[1] == f for r in own)
            yield (part, order, step, kept, removed, redundant, alone, good, toxic, ever[f])


def deduplicated(rows):
    """Rows of (doc_id, text): keep_id, group size, whether it stays, digest."""
    groups = defaultdict(list)
    for place, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id, place))
    for body, own in groups.items():
        own.sort(key=lambda g: (g[0], g[1], g[2] or 0, g[3]))
        for i, g in enumerate(own):
            yield (g[2], own[0][2], len(own), i == 0, sha(body))


_OWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_REST = [b for b in range(256) if b not in _OWN]
_LETTERS = {chr(b): b for b in _OWN} | {chr(256 + i): b for i, b in enumerate(_REST)}


def byte_level(token: str) -> bytes:
    """A byte-level token's bytes, by the public rule of such vocabularies."""
    return bytes(_LETTERS[c] for c in token)


def alignment(rows, tokenizer, pieces):
    """Rows of (doc_id, text), each text encoded as a whole and every pair of tokens looked at."""
    def piece(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    found, total = [], Counter()
    for doc_id, text in rows:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        x = [byte_level(tokenizer.id_to_token(i)) for i in a]
        y = [piece(i) for i in b]
        if not text or not b"".join(x) == b"".join(y) == (" " + text).encode():
            a, b, x, y = [], [], [], []
        ends_a = list(itertools.accumulate(map(len, x)))
        ends_b = list(itertools.accumulate(map(len, y)))
        place = defaultdict(list)
        for i, e in zip(b, ends_b):
            place[e].append(i)
        links = [(i, j) for i, e in zip(a, ends_a) for j in place[e]]
        groups, p, q = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a.index(cut, p) + 1, ends_b.index(cut, q) + 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
            p, q = i, j
        total.update(links)
        found.append((doc_id, len(a), len(b), links, groups))
    top = defaultdict(int)
    for (_, j), n in total.items():
        top[j] = max(top[j], n)
    for doc_id, n_a, n_b, links, groups in found:
        best = sum(total[p] == top[p[1]] for p in links)
        digest = sha(";".join(groups)) if groups else ""
        yield (doc_id, n_a, n_b, len(groups), len(links), best, sum(total[p] for p in links), digest)
