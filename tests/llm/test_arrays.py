"""Long arrays and texts: results by plain Python, time in proportion to the length."""

from __future__ import annotations

import random
import time
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from rowtide.llm import chat, pii
from rowtide.llm.arrays import cut, greater, running, text_blocks


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_running(spark, n):
    values = [random.Random(n).randrange(100) for _ in range(n)]
    df = spark.createDataFrame([(values,)], "v array<bigint>")
    sums, greatest = df.select(running(F.col("v")), running(F.col("v"), greater)).first()
    assert sums == list(accumulate(values, initial=0))[:n]
    assert greatest == list(accumulate(values, max, initial=0))[:n]


def test_cut(spark):
    text = "".join(random.Random(1).choice("aé\n漢🙂 ") for _ in range(9000))
    places = [(0, 0), (0, 9000), (2047, 2049), (2048, 2048), (2048, 4096), (100, 8999), (8999, 9000)]
    df = spark.createDataFrame([(text, a, b) for a, b in places], "t string, a bigint, b bigint")
    got = df.select("a", "b", cut(text_blocks(F.col("t")), F.col("a"), F.col("b")).alias("c")).collect()
    assert all(r.c == text[r.a : r.b] for r in got)


def seconds(run) -> float:
    return min(timed(run) for _ in range(2))


def timed(run) -> float:
    began = time.perf_counter()
    run()
    return time.perf_counter() - began


def test_many_matches_in_one_text(spark):
    def text(n):
        return " ".join(f"write to user{i}@mail{i}.example" for i in range(n))

    def run(n):
        docs = spark.createDataFrame([(1, text(n))], "doc_id bigint, text string")
        done = pii.redact(docs).first().text
        assert done == " ".join(["write to [EMAIL]"] * n)

    run(500)
    assert seconds(lambda: run(40_000)) < 2.5 * seconds(lambda: run(20_000)) + 1


def test_many_turns_in_one_conversation(spark):
    def run(n):
        turns = spark.range(n).selectExpr(
            "1L AS conv_id", "id AS turn", "IF(id % 3 = 0, 'user', 'assistant') AS role", "'text ' || id AS text"
        )
        row = chat.digest(chat.format_conversations(turns)).first()
        assert row.n_turns == n
        assert row.loss_chars == sum(len(f"text {i}") for i in range(n) if i % 3)

    run(500)
    assert seconds(lambda: run(40_000)) < 2.5 * seconds(lambda: run(20_000)) + 1


@pytest.mark.parametrize(
    "number", ["ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "NO93 8601 1117 947", "DE89370400440532013000"]
)
def test_account_number_before_a_word_in_capitals(spark, number):
    docs = spark.createDataFrame([(1, f"IBAN {number} BIC CAIXESBBXXX")], "doc_id bigint, text string")
    assert pii.redact(docs).first().text == "IBAN [IBAN] BIC CAIXESBBXXX"
