"""Token ids as Parquet list columns, in document order, read selectively.

A file holds one row per document: `doc_id`, `part` (the file's place),
`part_start` (ids before the document in its file), `n_tokens` and `ids`. The
ids are dictionary-encoded (a vocabulary fits in one dictionary page); the other
columns, which only grow or are small, are delta-encoded. Row groups are of a
set size and pages have indexes, so that a read of some documents or of the
counts alone touches few pages.

Documents are ordered by `doc_id` (null first), equal ids by their text's hash.
A null text is empty and has the end id alone. An empty table gives a folder
without rows. Other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rowtide.llm.tokens import ids_with_end
from rowtide.llm.workers import ship
from rowtide.operators.sizes import broadcast_if_small

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
#: Ids in an Arrow batch that leaves a task.
BATCH_IDS = 1 << 20

SCHEMA = "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("part", pa.int32()),
        ("part_start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def encoded(docs: DataFrame, tokenizer: str, words_apart: bool = True) -> DataFrame:
    """Rows of the token files, in order within and across partitions.

    The texts are dealt by ranges of (doc_id, hash), so that rows which share an
    id are spread too, and encoded after that: ids are made once.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        rows: list[tuple[int | None, int, np.ndarray]] = []
        held = 0
        for batch in batches:
            all_ids = ids_with_end(tokenizer, batch.column(1), words_apart)
            for doc_id, ids in zip(batch.column(0).to_pylist(), all_ids):
                rows.append((doc_id, start, ids))
                start += len(ids)
                held += len(ids)
                if held >= BATCH_IDS:
                    yield _batch(part, rows)
                    rows, held = [], 0
        if rows:
            yield _batch(part, rows)

    ship(docs.sparkSession)
    order = ("doc_id", "_tie")
    return (
        docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(encode, SCHEMA)
    )


def _batch(part: int, rows: list[tuple[int | None, int, np.ndarray]]) -> pa.RecordBatch:
    lengths = np.array([len(r[2]) for r in rows], np.int64)
    ids = np.concatenate([r[2] for r in rows]).view(np.int32)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    columns = [
        pa.array([r[0] for r in rows], pa.int64()),
        pa.array(np.full(len(rows), part, np.int32)),
        pa.array(np.array([r[1] for r in rows], np.int64)),
        pa.array(lengths),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, words_apart: bool = True
) -> None:
    """Encode documents and write their token files."""
    writer = encoded(docs, tokenizer, words_apart).write.mode("overwrite")
    for name in ("doc_id", "part", "part_start", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    (
        writer.option("parquet.writer.version", "v2")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Token files, or some columns and documents of them.

    A condition on `doc_id` skips row groups and pages; leaving out `ids` reads
    the counts alone.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    rows = rows if where is None else rows.filter(where)
    return rows.select(*columns) if columns else rows


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each file: one row per file, from the counts alone."""
    totals = read_token_files(spark, path, ("part", "n_tokens")).groupBy("part").agg(
        F.sum("n_tokens").alias("n")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: its place, size and the crc32 of its ids.

    The crc32 is over the ids as little-endian unsigned 32-bit integers.
    """

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = lists.offsets.to_numpy()
            crcs = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            kept = [batch.column(i) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(crcs, pa.int64())],
                names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"],
            )

    rows = read_token_files(spark, path).mapInArrow(
        checked, "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return rows.join(broadcast_if_small(part_starts(spark, path)), "part").select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
