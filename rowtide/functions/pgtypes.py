"""PostgreSQL column types: declared oids, text decoding, JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from rowtide.functions.json_text import json_scalar, plain_decimal, quote

# Public type oids and the Spark type each decodes to. Types not
# listed (uuid, inet, enum, composite ...) stay text.
SPARK_TYPES = {
    16: T.BooleanType(),
    17: T.BinaryType(),
    20: T.LongType(),
    21: T.ShortType(),
    23: T.IntegerType(),
    25: T.StringType(),
    114: T.VariantType(),
    700: T.FloatType(),
    701: T.DoubleType(),
    1042: T.StringType(),
    1043: T.StringType(),
    1082: T.DateType(),
    1114: T.TimestampNTZType(),
    1184: T.TimestampType(),
    1700: T.DecimalType(38, 18),
    3802: T.VariantType(),
}
# Array types and the types of their elements.
ELEMENTS = {
    1000: 16,
    1001: 17,
    1005: 21,
    1007: 23,
    1009: 25,
    1014: 1042,
    1015: 1043,
    1016: 20,
    1021: 700,
    1022: 701,
    1115: 1114,
    1182: 1082,
    1185: 1184,
    1231: 1700,
    2951: 2950,
}
SPARK_TYPES |= {oid: T.ArrayType(SPARK_TYPES.get(of, T.StringType())) for oid, of in ELEMENTS.items()}
# Range and multirange types and the types of their bounds.
RANGES = {3904: 23, 3906: 1700, 3908: 1114, 3910: 1184, 3912: 1082, 3926: 20}
MULTIRANGES = {4451: 23, 4532: 1700, 4533: 1114, 4534: 1184, 4535: 1082, 4536: 20}
INTERVAL = 1186
TEXT_OIDS = (25, 1042, 1043)
FLOAT_OIDS = (700, 701, 1021, 1022)
NUMERIC = 1700

_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
# A quoted element, a mark, or a bare element.
_ARRAY_PART = r'"(?:[^"\\]|\\[\s\S])*+"|[{},]|[^{},"]++'
_ARRAY = r"^\{[\s\S]*\}$"
# A range's text: brackets and two bounds, each bare, quoted or left out.
_BOUND = r'("(?:[^"\\]|\\[\s\S]|"")*+"|[^,"()\[\]{}]*+)'
_RANGE = rf"([\[(]){_BOUND},{_BOUND}([\])])"
_MULTIRANGE = rf"^\{{(?:{_RANGE}(?:,{_RANGE})*+)?\}}$"
# Years, months, days, and a signed time of day, each left out where it is zero.
_INTERVAL = (
    r"^(?=.)(?:([+-]?\d+) years?)?(?:(?:^| )([+-]?\d+) mons?)?(?:(?:^| )([+-]?\d+) days?)?"
    r"(?:(?:^| )([+-]?)(\d+):(\d\d):(\d\d)(?:\.(\d{1,6}))?)?$"
)
_HEX_BYTES = r"^\\x([0-9A-Fa-f]{2})*$"


def spark_type(oid: int, precision: int | None = None, scale: int = 0) -> T.DataType:
    """Spark type of a declared column type."""
    if oid == NUMERIC and precision is not None and precision <= 38:
        return T.DecimalType(precision, scale)
    return SPARK_TYPES.get(oid, T.StringType())


def decode_text(raw: Column, dtype: T.DataType) -> Column:
    """Typed value of a column's log text; NULL where it does not parse."""
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.BooleanType):
        return F.when(raw == "t", True).when(raw == "f", False)
    if isinstance(dtype, T.BinaryType):
        return F.when(raw.rlike(_HEX_BYTES), F.unhex(F.substr(raw, F.lit(3))))
    if isinstance(dtype, T.VariantType):
        return F.try_parse_json(raw)
    if isinstance(dtype, T.ArrayType):
        parts = array_parts(raw)
        items = F.filter(parts, lambda p: ~p.isin("{", "}", ","))
        typed = F.transform(items, lambda p: F.when(~_is_null(p), decode_text(_unquoted(p), dtype.elementType)))
        # An element that is neither NULL nor parses spoils the whole array.
        broken = F.exists(
            F.arrays_zip(items.alias("t"), typed.alias("v")), lambda z: ~_is_null(z["t"]) & z["v"].isNull()
        )
        flat = F.size(F.filter(parts, lambda p: p == "{")) == 1
        empty = F.array().cast(dtype)
        return F.when(raw == "{}", empty).when(raw.rlike(_ARRAY) & flat & ~broken, typed)
    return raw.try_cast(dtype)


def array_parts(raw: Column) -> Column:
    """Marks and elements of an array's text, in order."""
    return F.regexp_extract_all(raw, F.lit(_ARRAY_PART), F.lit(0))


def _is_null(part: Column) -> Column:
    return F.upper(part) == "NULL"


def _unquoted(part: Column) -> Column:
    inner = F.substring(part, F.lit(2), F.length(part) - 2)
    return F.when(part.startswith('"'), F.regexp_replace(inner, r"\\([\s\S])", "$1")).otherwise(part)


def _array_json(raw: Column, element: Column) -> Column:
    """JSON of an array of any depth; an element that does not parse spoils it."""
    parts = array_parts(raw)
    marks = F.create_map(*[F.lit(x) for pair in (("{", "["), ("}", "]"), (",", ",")) for x in pair])

    def text(part: Column) -> Column:
        # The word NULL in quotes is text.
        whole = F.when(_is_null(part), "null").otherwise(_element_json(_unquoted(part), element))
        return F.coalesce(F.element_at(marks, part), whole)

    texts = F.transform(parts, text)
    levels = F.size(F.filter(parts, lambda p: p == "{")) == F.size(F.filter(parts, lambda p: p == "}"))
    good = raw.rlike(_ARRAY) & levels & ~F.exists(texts, lambda t: t.isNull())
    return F.when(good, F.array_join(texts, "")).otherwise(quote(raw))


def _element_json(raw: Column, oid: Column) -> Column:
    """JSON of an element, NULL where it does not parse."""
    result = F.when(F.lit(False), "")
    for kind in sorted(set(ELEMENTS.values()) - set(TEXT_OIDS)):
        dtype = spark_type(kind)
        if kind == NUMERIC:
            value = F.when(raw.rlike(_NUMBER), plain_decimal(raw))
        elif isinstance(dtype, T.StringType):
            continue
        else:
            value = json_scalar(decode_text(raw, dtype), dtype)
        result = result.when(oid == kind, value)
    return result.otherwise(quote(raw))


def _bound_json(bound: Column, element: Column) -> Column:
    """JSON of one bound, the word null where it is left out, NULL where it does not parse."""
    inner = F.replace(F.substring(bound, F.lit(2), F.length(bound) - 2), F.lit('""'), F.lit('"'))
    plain = F.regexp_replace(inner, r"\\([\s\S])", "$1")
    value = _element_json(F.when(bound.startswith('"'), plain).otherwise(bound), element)
    return F.when(bound == "", "null").otherwise(value)


def _range_texts(raw: Column, element: Column) -> Column:
    """JSON of each range in a text, NULL for one that does not parse.

    Kinds of bounds are the codes of the letters i(nclusive), e(xclusive) and
    U(nbounded).
    """

    def kind(bound: Column, bracket: Column, inclusive: str) -> Column:
        return F.when(bound == "null", str(ord("U"))).when(bracket == inclusive, str(ord("i"))).otherwise(str(ord("e")))

    def made(text: Column, bounds: Column) -> Column:
        low, high = F.get(bounds, F.lit(0)), F.get(bounds, F.lit(1))
        return F.concat(
            F.lit('{"Lower":'), low,
            F.lit(',"Upper":'), high,
            F.lit(',"LowerType":'), kind(low, F.substring(text, 1, 1), "["),
            F.lit(',"UpperType":'), kind(high, F.substring(text, -1, 1), "]"),
            F.lit(',"Valid":true}'),
        )

    def one(text: Column) -> Column:
        bounds = F.array(*[F.regexp_extract(text, _RANGE, i) for i in (2, 3)])
        values = F.transform(bounds, lambda b: _bound_json(b, element))
        return F.get(F.transform(F.array(values), lambda v: made(text, v)), F.lit(0))

    return F.transform(F.regexp_extract_all(raw, F.lit(_RANGE), F.lit(0)), one)


def _range_json(raw: Column, element: Column, many: Column) -> Column:
    """JSON of a range, or of a multirange as an array; NULL where it does not parse."""
    empty = str(ord("E"))
    nothing = f'{{"Lower":null,"Upper":null,"LowerType":{empty},"UpperType":{empty},"Valid":true}}'

    def whole(texts: Column) -> Column:
        joined = F.array_join(texts, ",")
        good = ~F.exists(texts, lambda t: t.isNull())
        return F.when(~many & raw.rlike(f"^{_RANGE}$") & good, joined).when(
            many & raw.rlike(_MULTIRANGE) & good, F.concat(F.lit("["), joined, F.lit("]"))
        )

    found = F.get(F.transform(F.array(_range_texts(raw, element)), whole), F.lit(0))
    return F.when(~many & (raw == "empty"), nothing).otherwise(found)


def _interval_json(raw: Column) -> Column:
    """JSON of an interval: microseconds, days and months, which do not convert into each other."""

    def number(group: int) -> Column:
        text = F.regexp_extract(raw, _INTERVAL, group)
        return F.when(text == "", F.lit(0)).otherwise(text.try_cast("bigint")).cast("bigint")

    seconds = (number(5) * 60 + number(6)) * 60 + number(7)
    fraction = F.rpad(F.regexp_extract(raw, _INTERVAL, 8), 6, "0").cast("bigint")
    sign = F.when(F.regexp_extract(raw, _INTERVAL, 4) == "-", -1).otherwise(1)
    parts = {
        "Microseconds": (seconds * 1_000_000 + fraction) * sign,
        "Days": number(3),
        "Months": number(1) * 12 + number(2),
    }
    members = [F.concat(F.lit(f'"{name}":'), value.cast("string")) for name, value in parts.items()]
    return F.when(
        raw.rlike(_INTERVAL), F.concat(F.lit("{"), F.concat(*[x for m in members for x in (m, F.lit(","))]), F.lit('"Valid":true}'))
    )


def json_text(raw: Column, oid: int | Column) -> Column:
    """JSON text of a column's log text by its declared type.

    An unknown type, or text that does not parse as its type, is published as
    the raw text. NaN and infinite floats yield NULL (see `is_unencodable`).
    The type may be a column, as where one expression serves all relations.
    """
    if isinstance(oid, int):
        return _json_text(raw, oid)
    # Most frequent types first: the cases are tried in order.
    kinds = [25, 20, 23, NUMERIC, 1184, 1043, 701, 16, 1114, 1082, 3802]
    kinds += [k for k in SPARK_TYPES if k not in kinds and k not in ELEMENTS]
    result = F.when(oid.isin(*TEXT_OIDS), quote(raw))
    for kind in kinds:
        if kind not in TEXT_OIDS:
            result = result.when(oid == kind, _json_text(raw, kind))
    elements = F.create_map(*[F.lit(x) for pair in ELEMENTS.items() for x in pair])
    result = result.when(oid.isin(*ELEMENTS), _array_json(raw, F.element_at(elements, oid.cast("int"))))
    bounds = F.create_map(*[F.lit(x) for pair in (RANGES | MULTIRANGES).items() for x in pair])
    ranges = _range_json(raw, F.element_at(bounds, oid.cast("int")), oid.isin(*MULTIRANGES))
    result = result.when(oid.isin(*RANGES, *MULTIRANGES), F.coalesce(ranges, quote(raw)))
    result = result.when(oid == INTERVAL, F.coalesce(_interval_json(raw), quote(raw)))
    return result.otherwise(quote(raw))


def _json_text(raw: Column, oid: int) -> Column:
    dtype = spark_type(oid)
    if oid in RANGES or oid in MULTIRANGES:
        element = (RANGES | MULTIRANGES)[oid]
        return F.coalesce(_range_json(raw, F.lit(element), F.lit(oid in MULTIRANGES)), quote(raw))
    if oid == INTERVAL:
        return F.coalesce(_interval_json(raw), quote(raw))
    if isinstance(dtype, T.StringType):
        return quote(raw)
    if oid == NUMERIC:
        # The number's own digits, so precision beyond 38 digits survives.
        return F.when(raw.rlike(_NUMBER), plain_decimal(raw)).otherwise(quote(raw))
    if oid in ELEMENTS:
        return _array_json(raw, F.lit(ELEMENTS[oid]))
    value = decode_text(raw, dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(value.isNull(), quote(raw)).otherwise(json_scalar(value, dtype))
    return F.coalesce(json_scalar(value, dtype), quote(raw))


def is_unencodable(raw: Column) -> Column:
    """True for the text of a float, or of an array with one, that JSON cannot carry."""
    return raw.rlike(r"(?:^|[{,])(?:NaN|-?Infinity)(?:[,}]|$)")
