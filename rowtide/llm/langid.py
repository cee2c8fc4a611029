"""Language identification: naive Bayes over hashed character n-grams.

Training counts, for each language, the hashed n-grams of all labelled texts: a
multinomial model whose matrix of log-probabilities has `BUCKETS` columns and one
row a language, whatever the number of documents. The matrix is broadcast and
a batch of texts is scored as a sparse product: the entries of its n-grams are
gathered and added up by text.

Texts are lower-cased and runs of characters that are not letters count as one
space. A null text, or one without a letter, is `und` with score 0; rows without
a language or a text teach nothing. Ties go to the language that sorts first.
Without any labelled text, every text is `und`, and `with_known_language` keeps
every text with a letter. Repeated rows count as often as
they come; other columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.workers import ship

UNKNOWN = "und"
BUCKETS = 1 << 14
GRAMS = (1, 2, 3)
#: Added to every count.
SMOOTHING = 0.5
#: Characters that are turned into n-grams at once.
PIECE = 1 << 18
#: N-grams that are scored at once.
SCORED = 1 << 20
#: N-grams that count as independent evidence in a score.
EVIDENCE = 200
#: Mean log-likelihood of a text's n-grams below which no learned language explains
#: it: that of n-grams drawn evenly from all buckets. It needs no labelled negatives,
#: and a short text between two languages stays well above it.
LEAST_FIT = -math.log(BUCKETS)
#: Languages that a model may have; more are refused, so that it stays small.
MOST_LANGUAGES = 500

_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@dataclass
class Model:
    """`log_probs` has a row for each language and a column for each bucket."""

    languages: list[str]
    log_probs: np.ndarray
    priors: np.ndarray


def _letters() -> np.ndarray:
    """For each code point of the first plane its class: itself if a letter, else a space."""
    points = np.arange(1 << 16, dtype=np.uint32)
    keep = np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)
    return np.where(keep, points, 32).astype(np.uint32)


_LETTERS = _letters()


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, a space for each that is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < 1 << 16, _LETTERS[points & 0xFFFF], points).astype(np.uint32)


def gram_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of a text's n-grams, a piece of the text at a time.

    The text counts as one space, its words with one space between, and one
    space. N-grams that cross into the next piece are made with that piece.
    """
    longest = max(GRAMS)
    space = np.array([32], np.uint32)
    rest = space
    for begin in range(0, len(text), PIECE):
        last = begin + PIECE >= len(text)
        points = np.concatenate([rest, letters(text[begin : begin + PIECE]), space[: int(last)]])
        gap = points == 32
        points = points[~(gap & np.concatenate([[False], gap[:-1]]))]
        starts = len(points) if last else max(0, len(points) - longest + 1)
        out = []
        rolled = np.zeros(len(points), np.uint32)
        for size in range(1, longest + 1):
            tail = points[size - 1 :] * np.uint32(_MULTIPLIERS[size - 1])
            rolled = (rolled[: len(tail)] ^ tail) * np.uint32(0x27D4EB2F) + np.uint32(size)
            if size in GRAMS:
                hashed = rolled[:starts]
                out.append((hashed ^ (hashed >> np.uint32(15))) & np.uint32(BUCKETS - 1))
        yield np.concatenate(out)
        rest = points[starts:]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of all rows of `labelled` that have a text and a language.

    A task adds up its counts and sends one row for each bucket that it has
    seen; the driver receives one row for each bucket and language.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            for lang_, text_ in zip(batch.column(0).to_pylist(), batch.column(1)):
                total = totals.setdefault(lang_, np.zeros(BUCKETS, np.int64))
                rows[lang_] = rows.get(lang_, 0) + 1
                for buckets in gram_buckets(text_.as_py()):
                    total += np.bincount(buckets, minlength=BUCKETS)
        for lang_, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang_] * (len(seen) + 1), pa.string()),
                    pa.array(np.append(seen, -1).astype(np.int32)),
                    pa.array(np.append(total[seen], rows[lang_])),
                ],
                ["lang", "bucket", "n"],
            )

    ship(labelled.sparkSession)
    known = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    counts = (
        known.filter("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(counted, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    )
    rows = counts.limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rows.sort(key=lambda r: r["lang"])
    table = np.full((BUCKETS, len(rows)), SMOOTHING)
    documents = np.ones(len(rows))
    for i, row in enumerate(rows):
        for bucket, n in row["counts"]:
            if bucket < 0:
                documents[i] += n
            else:
                table[bucket, i] += n
    log_probs = np.ascontiguousarray(np.log(table / table.sum(axis=0)).T)
    return Model([r["lang"] for r in rows], log_probs, np.log(documents / documents.sum()))


def predicted(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column `struct<lang_pred, score, fit>` for the texts of `docs`.

    `score` is the posterior probability of the language, with the evidence
    taken by the n-gram's mean over at most `EVIDENCE` n-grams: n-grams of one
    text are far from independent, and a sum over them would always give 1. `fit`
    is the mean log-likelihood of the text's n-grams in that language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, fit double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in batches:
            found = classify(known, texts.tolist())
            yield pd.DataFrame(found, columns=["lang_pred", "score", "fit"])

    ship(docs.sparkSession)
    return predict(F.col(f"`{text}`"))


def classify(model: Model, texts: list[str | None]) -> list[tuple[str, float, float]]:
    """Language, score and fit of each text of a batch."""
    n, wide = len(texts), len(model.languages)
    totals, grams = np.zeros((n, wide)), np.zeros(n)
    held: list[tuple[int, np.ndarray]] = []
    size = 0
    for i, text in enumerate(texts):
        if not wide or not text or not any(c.isalpha() for c in text):
            continue
        for buckets in gram_buckets(text):
            held.append((i, buckets))
            grams[i] += len(buckets)
            size += len(buckets)
            if size >= SCORED:
                _add_scores(model, held, totals)
                held, size = [], 0
    if held:
        _add_scores(model, held, totals)
    out = []
    for total, count in zip(totals, grams):
        if not count:
            out.append((UNKNOWN, 0.0, -math.inf))
            continue
        scaled = total * min(1.0, EVIDENCE / count) + model.priors
        odds = np.exp(scaled - scaled.max())
        best = int((total + model.priors).argmax())
        out.append((model.languages[best], float(odds[best] / odds.sum()), float(total[best] / count)))
    return out


def _add_scores(model: Model, held: list[tuple[int, np.ndarray]], totals: np.ndarray) -> None:
    """A sparse product: rows are texts, and a column index stands once for each n-gram."""
    columns = np.concatenate([b for _, b in held])
    begins = np.cumsum([0] + [len(b) for _, b in held[:-1]])
    rows = np.array([i for i, _ in held])
    for j in range(totals.shape[1]):
        np.add.at(totals[:, j], rows, np.add.reduceat(model.log_probs[j][columns], begins))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are kept from training: crc32 of the id as text, modulo 3, is 1."""
    third = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 3
    return F.coalesce(third == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """`docs` with `held_out`, `lang_pred` and `score`, learned from the rest of them.

    A row without an id is not learned from.
    """
    model = train(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))
    return (
        docs.select("doc_id", held_out().alias("held_out"), predicted(docs, model).alias("_p"))
        .select("doc_id", "held_out", "_p.lang_pred", "_p.score")
    )


def with_known_language(docs: DataFrame, least: float = LEAST_FIT) -> DataFrame:
    """`docs` without the rows whose language cannot be told; all columns stay.

    These have no text or no letter, or a `fit` below `least` in every language.
    Where there is nothing to learn from, every text with a letter stays.
    """
    model = train(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"[\p{L}]"))
    found = predicted(docs, model)
    return docs.filter((found["lang_pred"] != UNKNOWN) & (found["fit"] >= least))
