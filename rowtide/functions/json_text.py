"""JSON text of keys and values.

A column's JSON is the same text whether it comes from a typed snapshot column
or was decoded from log text, so a row keeps its key bytes, and with them its
topic partition, across both paths.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

_FLOATS = (T.FloatType, T.DoubleType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)

_CONTROL = r"[\x00-\x1f]"


def quote(text: Column) -> Column:
    """A JSON string; the JSON writer runs only where control characters do."""
    wrapped = F.to_json(F.array(text))
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when(
        text.rlike(_CONTROL), F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)
    ).otherwise(F.concat(F.lit('"'), escaped, F.lit('"')))


def rfc3339(ts: Column, zoned: bool = True) -> Column:
    """UTC timestamp text, independent of the session's time zone."""
    if zoned:
        ts = F.timestamp_add(
            "MICROSECOND", F.unix_micros(ts), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        )
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def plain_decimal(text: Column) -> Column:
    """Decimal text without the zeros that only show the declared scale."""
    return F.when(
        text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    ).otherwise(text)


def decimal_text(col: Column) -> Column:
    """Plain digits of a decimal.

    Outside ANSI mode a cast writes small numbers with an exponent: their digits
    are put back behind as many zeros.
    """
    text = col.cast("string")
    digits = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), "[-.]", "")
    zeros = F.repeat(F.lit("0"), -F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int") - 1)
    sign = F.when(text.startswith("-"), "-").otherwise("")
    return F.when(text.contains("E"), F.concat(sign, F.lit("0."), zeros, digits)).otherwise(text)


def json_scalar(col: Column, dtype: T.DataType) -> Column:
    """JSON text of a column, NULL where the column is NULL.

    NaN and infinite floats have no JSON form and come out NULL; they are
    separated before encoding by `unencodable`.
    """
    if isinstance(dtype, _WHOLE):
        return col.cast("string")
    if isinstance(dtype, _FLOATS):
        return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col.cast("string"))
    if isinstance(dtype, T.DecimalType):
        return plain_decimal(decimal_text(col))
    if isinstance(dtype, T.StringType):
        return quote(col)
    if isinstance(dtype, T.TimestampType):
        return F.concat(F.lit('"'), rfc3339(col), F.lit('"'))
    if isinstance(dtype, T.TimestampNTZType):
        return F.concat(F.lit('"'), rfc3339(col, zoned=False), F.lit('"'))
    if isinstance(dtype, T.DateType):
        return F.concat(F.lit('"'), col.cast("string"), F.lit('T00:00:00Z"'))
    if isinstance(dtype, T.BinaryType):
        return F.concat(F.lit('"'), F.base64(col), F.lit('"'))
    if isinstance(dtype, T.ArrayType):
        items = F.transform(col, lambda x: F.coalesce(json_scalar(x, dtype.elementType), F.lit("null")))
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    return F.to_json(col, {"ignoreNullFields": "false"})


def json_object(df: DataFrame, columns: Sequence[str]) -> Column:
    """Flat JSON object over the named columns: sorted names, NULLs kept."""
    duplicates = {c for c in df.columns if df.columns.count(c) > 1}
    if duplicates:
        raise ValueError(f"repeated column names: {sorted(duplicates)}")
    parts: list[Column] = []
    for i, name in enumerate(sorted(columns, key=lambda c: c.encode())):
        label = ("," if i else "{") + json.dumps(name, ensure_ascii=False) + ":"
        if name in df.columns:
            value = json_scalar(df[f"`{name}`"], df.schema[name].dataType)
        else:
            value = F.lit(None).cast("string")
        parts += [F.lit(label), F.coalesce(value, F.lit("null"))]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


def unencodable(df: DataFrame) -> Column:
    """True where a float, also one in an array, is NaN or infinite: JSON cannot carry it."""
    result = F.lit(False)
    for f in df.schema.fields:
        test = _bad_floats(F.col(f"`{f.name}`"), f.dataType)
        if test is not None:
            result = result | F.coalesce(test, F.lit(False))
    return result


def _bad_floats(col: Column, dtype: T.DataType) -> Column | None:
    if isinstance(dtype, _FLOATS):
        return F.isnan(col) | (F.abs(col) == float("inf"))
    if isinstance(dtype, T.ArrayType) and _bad_floats(F.lit(None), dtype.elementType) is not None:
        return F.exists(col, lambda x: F.coalesce(_bad_floats(x, dtype.elementType), F.lit(False)))
    return None


def headers(table: Column, op: Column, ts: Column, lsn: Column) -> Column:
    """Message headers in Kafka's layout; `lsn` only where there is one."""

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), F.to_binary(value, F.lit("utf-8")).alias("value"))

    fixed = F.array(header("table", table), header("op", op), header("ts", ts.cast("string")))
    return F.when(F.coalesce(lsn, F.lit("")) == "", fixed).otherwise(
        F.concat(fixed, F.array(header("lsn", lsn)))
    )
