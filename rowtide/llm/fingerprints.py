"""Bottom-k sketches of a text's word shingles.

A fingerprint holds the number of smallest distinct shingle hashes that it may
keep and those hashes. Sketches of parts merge to the sketch of the whole, and
two sketches estimate the resemblance and the containment of their texts and the
number of distinct shingles. While a text has fewer shingles than k, all
estimates are exact.

A null or empty text, or one without words, has the empty sketch; two empty
sketches are alike (1), an empty and another one are not (0). Repeated rows have
equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.shingles import SPACED, WORDS, text_shingles
from rowtide.llm.workers import ship

K = 128
#: Ranges of ids in which neighbours are looked for, for each shuffle partition.
RANGES = 4
#: Characters that are sketched at once.
BATCH_CHARS = 1 << 21


def sketches(texts: pa.Array, k: int = K, words: int = WORDS) -> list[np.ndarray]:
    """The k smallest distinct shingle hashes of each text, ascending."""
    hashes, begins = text_shingles(texts, SPACED, words)
    return [bottom(hashes[a:b], k) for a, b in zip(begins[:-1], begins[1:])]


def bottom(hashes: np.ndarray, k: int) -> np.ndarray:
    if len(hashes) > 4 * k:
        # Enough for k distinct ones, unless a text repeats itself much.
        few = np.unique(np.partition(hashes, 2 * k)[: 2 * k])
        if len(few) >= k:
            return few[:k]
    return np.unique(hashes)[:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two parts together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all shingles of both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merged(a, b, k)
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, common, assume_unique=True).mean())


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    if len(a) < k:
        return float(len(a))
    return (k - 1) / (float(a[k - 1]) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first text's shingles that the second has."""
    if not len(a):
        return 1.0
    together = distinct_shingles(merged(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * together / distinct_shingles(a, k))


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8")


def fingerprint(docs: DataFrame, k: int = K) -> DataFrame:
    """`doc_id` and `fingerprint` of each row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [to_text(s) for s in sketches(batch.column(1), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "fingerprint"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        sketch, "doc_id bigint, fingerprint string"
    )


def with_next(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text`, so dealt that a row's successor follows it.

    Rows are ordered by id (null first), equal ids by their text's hash. Ranges
    of ids are dealt out, and the first row of each range also goes to the end
    of the range before (the first range's to the end of the last) as a row with
    `_copy`. So each text is shuffled once, a few twice, and no range is larger
    than an even share unless one id has more rows than that.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_h", F.xxhash64("text"))
    cuts = rows.agg(
        F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000).alias("c")
    ).first()["c"]
    edges = [-math.inf, *sorted({float(c) for c in cuts or [0]}), math.inf]
    dealt = (
        Bucketizer(splits=edges, inputCol="_id", outputCol="_bucket")
        .transform(rows.withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf))))
        .withColumn("_range", F.col("_bucket").cast("int"))
        .drop("_id", "_bucket")
    )
    firsts = (
        dealt.groupBy("_range").agg(F.min(F.struct("doc_id", "_h")).alias("_f")).orderBy("_range").collect()
    )
    if not firsts:
        return dealt.withColumn("_copy", F.lit(False)).select("_range", "doc_id", "_h", "_copy", "text")
    before = {r["_range"]: firsts[i - 1]["_range"] for i, r in enumerate(firsts)}
    marks = spark.createDataFrame(
        [(r["_range"], r["_f"]["doc_id"], r["_f"]["_h"], before[r["_range"]]) for r in firsts],
        "_range int, _fid bigint, _fh bigint, _to int",
    )
    # One row a range: their number is a few times that of the shuffle partitions.
    copies = (
        dealt.join(F.broadcast(marks), "_range")
        .filter(F.col("doc_id").eqNullSafe(F.col("_fid")) & (F.col("_h") == F.col("_fh")))
        .select(F.col("_to").alias("_range"), "doc_id", "_h", F.lit(True).alias("_copy"), "text")
    )
    own = dealt.select("_range", "doc_id", "_h", F.lit(False).alias("_copy"), "text")
    return (
        own.unionByName(copies)
        .repartition("_range")
        .sortWithinPartitions("_range", "_copy", "doc_id", "_h")
    )


def edited_fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    The edited text has the last quarter of its code points replaced by the
    first as many of the next document.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            for part in _slices(batch):
                texts = part.column(4).to_pylist()
                rows = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(3).to_pylist(), texts, sketches(part.column(4), k)))
                if held is not None:
                    rows.insert(0, held)
                held = rows[-1]
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[2]]
                if pairs:
                    yield _compared(pairs, k)

    ship(docs.sparkSession)
    return with_next(docs).mapInArrow(
        compare,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, "
        "contained_edited double, shingles double",
    )


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a bounded number of bytes, or single rows."""
    ends = np.frombuffer(batch.column(4).buffers()[1], np.int32 if pa.types.is_string(batch.column(4).type) else np.int64)
    ends = ends[batch.column(4).offset :][: len(batch) + 1]
    begin = 0
    while begin < len(batch):
        end = int(np.searchsorted(ends, ends[begin] + BATCH_CHARS, "right")) - 1
        end = min(max(end, begin + 1), len(batch))
        yield batch.slice(begin, end - begin)
        begin = end


def _compared(pairs: list[tuple[tuple, tuple]], k: int) -> pa.RecordBatch:
    edits = []
    for (_, _, _, text, _), (_, _, _, following, _) in pairs:
        cut = len(text) // 4
        edits.append(text[: len(text) - cut] + following[:cut])
    edited = sketches(pa.array(edits, pa.large_string()), k)
    own = [a[4] for a, _ in pairs]
    columns = [
        pa.array([a[1] for a, _ in pairs], pa.int64()),
        pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edits]),
        pa.array([to_text(s) for s in own]),
        pa.array([to_text(s) for s in edited]),
        pa.array([resemblance(a, b, k) for a, b in zip(own, edited)]),
        pa.array([resemblance(a[4], b[4], k) for a, b in pairs]),
        pa.array([containment(a, b, k) for a, b in zip(own, edited)]),
        pa.array([distinct_shingles(a, k) for a in own]),
    ]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "contained_edited", "shingles"]
    return pa.RecordBatch.from_arrays(columns, names)
