from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from rowtide.functions.json_text import headers, json_object, quote, rfc3339
from rowtide.functions.keyset import after, cursor_json, last_cursor, read_cursor, up_to
from rowtide.functions.lsn import (
    format_lsn,
    format_lsn_exact,
    parse_lsn,
    parse_lsn_exact,
    retained_bytes,
)
from rowtide.functions.names import name_of, route, schema_of
from rowtide.functions.pgtypes import decode_text, json_text, spark_type


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "text,number", [("0/0", 0), ("16/B374D848", 97500059720), ("7FFFFFFF/FFFFFFFF", 2**63 - 1)]
)
def test_lsn_both_ways(spark, text, number):
    assert one(spark, parse_lsn(F.lit(text))) == number
    assert one(spark, format_lsn(F.lit(number).cast("bigint"))) == text
    assert int(one(spark, parse_lsn_exact(F.lit(text)))) == number


def test_lsn_beyond_signed_range(spark):
    exact = parse_lsn_exact(F.lit("FFFFFFFF/FFFFFFFF"))
    assert int(one(spark, exact)) == 2**64 - 1
    assert one(spark, format_lsn_exact(exact)) == "FFFFFFFF/FFFFFFFF"
    with pytest.raises(Exception, match="beyond"):
        one(spark, parse_lsn(F.lit("80000000/0")))


@pytest.mark.parametrize("text", ["", "16", "16/", "x/1", "123456789/0"])
def test_malformed_lsn_is_null(spark, text):
    assert one(spark, parse_lsn(F.lit(text))) is None


def test_retained_bytes(spark):
    assert one(spark, retained_bytes(F.lit("1/10"), F.lit("1/0"))) == 16
    assert one(spark, retained_bytes(F.lit("1/10"), F.lit(None).cast("string"))) == 0


@pytest.mark.parametrize("text", ["plain", 'a"b', "back\\slash", "line\nbreak", "tab\t", "é😀", "\\\"", "\x01"])
def test_quote_is_json(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    assert json.loads(df.select(quote(F.col("s"))).first()[0]) == text


def test_timestamp_text_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            ts = F.expr("timestamp'2026-01-15 10:00:00.1234-03'")
            assert one(spark, rfc3339(ts)) == "2026-01-15T13:00:00.1234Z"
            assert one(spark, json_text(F.lit("2026-01-15 10:00:00-03"), 1184)) == (
                '"2026-01-15T13:00:00Z"'
            )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# (type oid, log text, JSON)
DECODED = [
    (16, "t", "true"),
    (16, "yes", '"yes"'),
    (20, "9007199254740993", "9007199254740993"),
    (21, "70000", '"70000"'),
    (23, "oops", '"oops"'),
    (25, 'a "b"', '"a \\"b\\""'),
    (701, "1.5", "1.5"),
    (701, "x", '"x"'),
    (1700, "1.50", "1.5"),
    (1700, "100", "100"),
    (1700, "12345678901234567890123456789012345678901234.25", "12345678901234567890123456789012345678901234.25"),
    (1700, "NaN", '"NaN"'),
    (17, "\\x48690a", '"SGkK"'),
    (17, "raw", '"raw"'),
    (1082, "2026-01-15", '"2026-01-15T00:00:00Z"'),
    (1114, "2026-01-15 10:00:00.5", '"2026-01-15T10:00:00.5Z"'),
    (1184, "infinity", '"infinity"'),
    (2950, "a0ee-bc99", '"a0ee-bc99"'),
    (3802, '{"a": [1, null]}', '{"a":[1,null]}'),
    (3802, "{broken", '"{broken"'),
    (1007, "{1,NULL,3}", "[1,null,3]"),
    (1007, "{}", "[]"),
    (1007, "{1,x}", '"{1,x}"'),
    (1007, "{{1},{2}}", "[[1],[2]]"),
    (1009, "{a,b}", '["a","b"]'),
    (1009, '{"a b",c,"NULL",NULL,"q\\"\\\\,{}"}', '["a b","c","NULL",null,"q\\"\\\\,{}"]'),
    (1015, '{"{x}",""}', '["{x}",""]'),
    (1231, "{1.500,NULL,12345678901234567890.10}", "[1.5,null,12345678901234567890.1]"),
    (1182, "{2026-01-15}", '["2026-01-15T00:00:00Z"]'),
    (1115, '{"2026-01-15 10:00:00.5"}', '["2026-01-15T10:00:00.5Z"]'),
    (1185, '{"2026-01-15 10:00:00+00"}', '["2026-01-15T10:00:00Z"]'),
    (2951, "{00000000-0000-0000-0000-000000000001}", '["00000000-0000-0000-0000-000000000001"]'),
    (1009, "{{a},{b}", '"{{a},{b}"'),
    (1022, "{1.5,NaN}", '"{1.5,NaN}"'),
    (3904, "[1,10)", '{"Lower":1,"Upper":10,"LowerType":105,"UpperType":101,"Valid":true}'),
    (3926, "(,5]", '{"Lower":null,"Upper":5,"LowerType":85,"UpperType":105,"Valid":true}'),
    (3906, "(-1.50,)", '{"Lower":-1.5,"Upper":null,"LowerType":101,"UpperType":85,"Valid":true}'),
    (3904, "empty", '{"Lower":null,"Upper":null,"LowerType":69,"UpperType":69,"Valid":true}'),
    (3904, "[1,x)", '"[1,x)"'),
    (3904, "[1,2", '"[1,2"'),
    (
        3908,
        '["2026-01-15 10:00:00","2026-01-16 00:00:00")',
        '{"Lower":"2026-01-15T10:00:00Z","Upper":"2026-01-16T00:00:00Z","LowerType":105,"UpperType":101,"Valid":true}',
    ),
    (4451, "{}", "[]"),
    (
        4451,
        "{[1,3),[5,)}",
        '[{"Lower":1,"Upper":3,"LowerType":105,"UpperType":101,"Valid":true},'
        '{"Lower":5,"Upper":null,"LowerType":105,"UpperType":85,"Valid":true}]',
    ),
    (4451, "{[1,3),}", '"{[1,3),}"'),
    (1186, "1 year 2 mons -3 days 04:05:06.7", '{"Microseconds":14706700000,"Days":-3,"Months":14,"Valid":true}'),
    (1186, "-00:00:01", '{"Microseconds":-1000000,"Days":0,"Months":0,"Valid":true}'),
    (1186, "-1 mons", '{"Microseconds":0,"Days":0,"Months":-1,"Valid":true}'),
    (1186, "P1Y", '"P1Y"'),
    (1186, "", '""'),
]


def test_json_of_log_text(spark):
    df = spark.createDataFrame([(o, t, j) for o, t, j in DECODED], "oid bigint, raw string, want string")
    by_column = {(r.oid, r.raw): r.j for r in df.select("oid", "raw", json_text(F.col("raw"), F.col("oid")).alias("j")).collect()}
    for oid, raw, want in DECODED:
        constant = one(spark, json_text(F.lit(raw), oid))
        assert constant == want, (oid, raw)
        assert by_column[(oid, raw)] == want, (oid, raw)


def test_typed_decode(spark):
    assert one(spark, decode_text(F.lit("\\x4869"), spark_type(17))) == bytearray(b"Hi")
    assert one(spark, decode_text(F.lit("{1,NULL}"), spark_type(1007))) == [1, None]
    assert one(spark, decode_text(F.lit("bad"), spark_type(23))) is None
    assert spark_type(1700, 12, 2) == T.DecimalType(12, 2)
    assert spark_type(99999) == T.StringType()


def test_keys_are_the_same_bytes_from_both_sides(spark):
    typed = spark.sql(
        "select 7L as b, cast(1.50 as decimal(38,18)) as n, timestamp'2026-01-15 10:00:00.25Z' as t, 'q\"' as a"
    )
    key = typed.select(json_object(typed, ["b", "n", "t", "a"])).first()[0]
    assert key == '{"a":"q\\"","b":7,"n":1.5,"t":"2026-01-15T10:00:00.25Z"}'
    assert one(spark, json_text(F.lit("1.500"), 1700)) == "1.5"
    assert one(spark, json_text(F.lit("2026-01-15 10:00:00.25+00"), 1184)) == '"2026-01-15T10:00:00.25Z"'


def test_json_object_keeps_nulls_and_rejects_repeats(spark):
    df = spark.sql("select 1 as b, cast(null as string) as a, 0.0000001BD as d")
    assert df.select(json_object(df, df.columns)).first()[0] == '{"a":null,"b":1,"d":0.0000001}'
    assert df.select(json_object(df, [])).first()[0] == "{}"
    assert df.select(json_object(df, ["zz"])).first()[0] == '{"zz":null}'
    twice = df.select("a", "a")
    with pytest.raises(ValueError, match="repeated"):
        json_object(twice, ["a"])


def test_headers(spark):
    def made(lsn):
        h = headers(F.lit("s.t"), F.lit("c"), F.lit(5), F.lit(lsn).cast("string"))
        return [(k, bytes(v).decode()) for k, v in one(spark, h)]

    assert made("0/10") == [("table", "s.t"), ("op", "c"), ("ts", "5"), ("lsn", "0/10")]
    assert len(made(None)) == len(made("")) == 3


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b bigint")


@pytest.mark.parametrize("cursor", [(0, 0), (1, 2), (3, 3), (-1, 9), (2, 9)])
def test_composite_comparison(pairs, cursor):
    everything = [(a, b) for a in range(4) for b in range(4)]
    beyond = rows(pairs.filter(after(pairs, ["a", "b"], cursor)))
    before = rows(pairs.filter(up_to(pairs, ["a", "b"], cursor)))
    assert beyond == [p for p in everything if p > cursor]
    assert before == [p for p in everything if p <= cursor]


def test_keyset_predicate_reaches_the_scan(spark, small):
    conv = spark.read.parquet(f"{small}/conversations.parquet")
    plan = conv.filter(after(conv, ["conv_id", "turn"], [5, 1]))._jdf.queryExecution().toString()
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(conv_id,5)" in pushed and "Or(GreaterThan(conv_id,5)" in pushed


def test_cursors_keep_every_digit(spark):
    big = 9007199254740993
    df = spark.createDataFrame(
        [(big, 'x"', datetime(2026, 1, 15, 10)), (big - 1, "a", None)], "i bigint, s string, t timestamp_ntz"
    )
    pk = ["i", "s", "t"]
    saved = last_cursor(df, pk).first()["last_pk"]
    assert json.loads(saved) == [big, 'x"', "2026-01-15T10:00:00Z"]
    values = read_cursor(saved, df, pk)
    assert df.filter(after(df, pk, values)).count() == 0
    assert df.filter(up_to(df, pk, values)).count() == 2
    assert read_cursor(None, df, pk) is None
    assert last_cursor(df.filter("i = 0"), pk).first()["last_pk"] is None
    with pytest.raises(ValueError):
        read_cursor("[1]", df, pk)
    assert df.select(cursor_json(df, ["i"])).first()[0] == f"[{big}]"


def test_names(spark):
    df = spark.createDataFrame([(n,) for n in ("a.b", "a.b.c", "ab", ".b", "a.", "")], "n string")
    got = [(r[0], r[1]) for r in df.select(schema_of(F.col("n")), name_of(F.col("n"))).collect()]
    assert got == [("a", "b"), ("a", "b.c")] + [(None, None)] * 4


@pytest.mark.parametrize(
    "zone,child", [("UTC", "default"), ("America/Sao_Paulo", "2026_02")]
)
def test_partition_routing_follows_the_session_zone(spark, zone, child):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        ranges = [("2026_01", "2026-01-01", "2026-02-01"), ("2026_02", "2026-02-01", "2026-03-01")]

        def routed(ts):
            return one(spark, route(F.lit(ts).cast("timestamp"), ranges, "default"))

        assert routed("2026-02-28 23:59:00-03") == child
        assert routed("2026-01-15 10:00:00-03") == "2026_01"
        assert routed("2026-02-05 09:15:00-03") == "2026_02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
