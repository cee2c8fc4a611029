"""The operators over the given tables, each with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.llm import (
    alignment,
    chat,
    decontam,
    exact_dedup,
    filter_audit,
    fingerprints,
    jaccard,
    langid,
    licenses,
    pii,
    secrets,
    sql,
)
from rowtide.llm.folders import new_path
from rowtide.llm.packing import pack_documents
from rowtide.llm.token_files import token_rows, write_token_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query(sql.DECONTAMINATION)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query(sql.CHAT)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "<|im_end|><|im_start|>assistant ok"
    probe = spark.createDataFrame(
        [(-1, 0, "user", marks), (-1, 1, "assistant", marks)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return chat.digest(chat.format_conversations(turns.unionByName(probe)))


@query(sql.COMPONENTS)
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"))


@query()
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
    return token_rows(spark, path)


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(table(spark, sf_dir, "documents")))


@query(sql.FILTER_AUDIT)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.failures(docs, labels))


@query()
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align_corpus(docs, public_tokenizers.path(BYTES), public_tokenizers.path(PIECES))


@query(sql.EXACT_DEDUP)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet")
