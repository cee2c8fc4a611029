"""Personal data: proposed by regular expressions, confirmed by checksums, scored by context.

Each kind has a pattern that proposes spans (leftmost, not overlapping), a check
of the match (parts of an address, Luhn, mod-97, digit counts) that drops
failing ones for good, and words that raise its score when they stand near it.
A text is split at a pattern's matches; the lengths of the pieces and of the
matches give the places, and the pieces beside a match are its context.

A pattern runs only on texts that pass its quick test, a necessary condition.
Patterns use possessive repeats: they match what the greedy ones would, without
going back, so long texts take linear time and no deep stack.

Null texts are empty, an empty table gives an empty one. Every input row gives one output row, repeated rows equal
ones. `scan` leaves other columns out, `redact` keeps all. DataFrame functions
only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.arrays import cut, greater, let, running, text_blocks

SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"
#: Characters before and after a match that are searched for context words.
CONTEXT = 40
CONTEXT_GAIN = 0.15


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    quick: str
    check: Callable[[Column], Column]
    score: float
    context: str


def digits(match: Column) -> Column:
    return F.translate(match, " -+().", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a valid Luhn check digit."""
    n = F.length(number)

    def add(acc: Column, i: Column) -> Column:
        digit = F.substring(number, i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return acc + F.when((n - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number, its first four characters moved to the end, is 1 modulo 97."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def add(acc: Column, i: Column) -> Column:
        c = F.substring(turned, i, F.lit(1))
        letter = F.ascii(c) >= 65
        return F.when(letter, acc * 100 + F.ascii(c) - 55).otherwise(acc * 10 + c.cast("int")) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(account)), F.lit(0), add) == 1


def _address_parts(match: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _count_between(least: int, most: int) -> Callable[[Column], Column]:
    return lambda match: F.length(digits(match)).between(least, most)


def _card(match: Column) -> Column:
    number = digits(match)
    return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(F.lit(False))


def _iban(match: Column) -> Column:
    account = F.translate(match, " ", "")
    return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(F.lit(False))


# The kinds in the order in which spans are listed.
BASE = (
    Kind(
        "email",
        # A run of name characters is tried from its start, or from the end of the match before.
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]++\.[A-Za-z0-9-]",
        lambda match: F.lit(True),
        0.8,
        "mail|contact|write|kontakt|correo|courriel",
    ),
    Kind(
        "ip",
        r"[0-9]++(?:\.[0-9]++){3}",
        r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
        _address_parts,
        0.6,
        r"\bip\b|address|host|server|login",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        r"[0-9](?:[\x20-]?[0-9]){12}",
        _card,
        0.7,
        "card|visa|credit|payment|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        _count_between(9, 15),
        0.6,
        "phone|call|mobile|tel|fax",
    ),
)
# Characters of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}


def _iban_pattern() -> str:
    """Account numbers in one piece, or as printed, in groups of four and a last shorter one.

    A country's own length comes first, so that a word after a printed number is
    not taken for its last group.
    """
    forms = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        last = rf"\x20[A-Z0-9]{{{rest}}}" if rest else ""
        printed = rf"(?:\x20[A-Z0-9]{{4}}){{{groups}}}{last}"
        forms.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{length - 4}}}|{printed})")
    forms.append(r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,4})?)")
    ended = [form + r"(?![A-Za-z0-9])" for form in forms]
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(ended)})"


MORE = (
    Kind(
        "iban",
        _iban_pattern(),
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11}|(?:\x20[A-Z0-9]{4}){2})",
        _iban,
        0.8,
        "iban|bank|account|konto|compte|cuenta",
    ),
)


def found(text: Column, kind: Kind) -> Column:
    """The spans of one kind in a text."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.split(text, kind.pattern, -1)
    rows = F.arrays_zip(pieces.alias("before"), matches.alias("match"), F.slice(pieces, 2, 1 << 30).alias("after"))

    def near(row: Column) -> Column:
        before = F.substring(row["before"], -CONTEXT, CONTEXT)
        after = F.substring(row["after"], 1, CONTEXT)
        return F.lower(F.concat_ws(" ", before, after)).rlike(kind.context)

    def span(row: Column, at: Column) -> Column:
        start = at + F.length(row["before"])
        gain = F.when(near(row), CONTEXT_GAIN).otherwise(0.0)
        good = row["match"].isNotNull() & kind.check(row["match"])
        return F.when(
            good,
            F.struct(
                F.lit(kind.name).alias("kind"),
                start.cast("bigint").alias("start"),
                (start + F.length(row["match"])).cast("bigint").alias("end"),
                (F.lit(kind.score) + gain).alias("score"),
            ),
        )

    def placed(rows: Column) -> Column:
        lengths = F.transform(
            rows, lambda r: (F.length(r["before"]) + F.coalesce(F.length(r["match"]), F.lit(0))).cast("bigint")
        )
        return F.filter(F.zip_with(rows, running(lengths), span), lambda s: s.isNotNull())

    empty = F.array().cast(f"array<{SPAN}>")
    return F.when(text.rlike(kind.quick), let(rows, placed)).otherwise(empty)


def scan(docs: DataFrame, kinds: Sequence[Kind] = BASE + MORE) -> DataFrame:
    """`doc_id` and `spans`: (kind, start, end, score), by kind as listed, then start."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint"), F.concat(*[found(text, k) for k in kinds]).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def digest(scanned: DataFrame, base: Sequence[Kind] = BASE) -> DataFrame:
    """Counts and hashes of the base kinds, all spans as one text, and the highest score."""
    names = [k.name for k in base]
    spans = F.col("spans")
    return scanned.select(
        "doc_id",
        *[count_of(spans, n).alias(f"n_{n}") for n in names],
        F.sha2(listed(F.filter(spans, lambda s: s["kind"].isin(names))), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
        F.array_max(F.transform(spans, lambda s: s["score"])).alias("top_score"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets.

    Overlapping spans are replaced together, by the kind of the one that begins first.
    """
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("last"), s["kind"].alias("kind")))
    )

    def marked(spans: Column) -> Column:
        ends = F.transform(spans, lambda s: -s["last"])
        reached = running(ends, greater)

        def part(blocks: Column, s: Column, at: Column) -> Column:
            mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.when(s["start"] >= at, F.concat(cut(blocks, at, s["start"]), mark)).otherwise("")

        def whole(blocks: Column) -> Column:
            parts = F.zip_with(spans, reached, lambda s, at: part(blocks, s, at))
            rest = cut(blocks, F.array_max(ends), F.length(text).cast("bigint"))
            return F.concat(F.array_join(parts, ""), rest)

        return let(text_blocks(text), whole)

    return F.when(F.size(spans) > 0, let(ordered, marked)).otherwise(text)


def redact(docs: DataFrame, kinds: Sequence[Kind] = BASE + MORE) -> DataFrame:
    """`docs` with personal data replaced in `text`, and `n_chars`, if present, to match."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    spans = F.concat(*[found(text, k) for k in kinds])
    marked = docs.select(whole.alias("row"), spans.alias("spans"))
    clean = redacted(F.col("row.text"), F.col("spans"))
    done = marked.select("row", clean.alias("clean"))
    changed = {"text": F.col("clean"), "n_chars": F.length("clean").cast("bigint")}

    def column(name: str) -> Column:
        kept = F.col("row")[name]
        if name == "n_chars":
            changed_text = ~F.col("clean").eqNullSafe(F.col("row.text"))
            return F.when(changed_text, changed[name]).otherwise(kept).cast(docs.schema[name].dataType).alias(name)
        return changed.get(name, kept).alias(name)

    return done.select(*[column(c) for c in docs.columns])
