"""Running values and cuts over long arrays and texts, as Spark expressions.

Appending to an array copies it, and a substring is sought from the start of its
text. Both are done in blocks here, so that their cost grows with the length and
not with its square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Values in a block of a running array, characters in a block of a text.
VALUES = 128
CHARACTERS = 2048


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def added(a: Column, b: Column) -> Column:
    return a + b


def greater(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def running(values: Column, combine: Callable[[Column, Column], Column] = added) -> Column:
    """What stands before each value: the values before it combined, 0 for the first.

    `values` are longs; 0 must be neutral, as for sums and for the greatest of
    values that are not negative.
    """
    zero = F.lit(0).cast("bigint")
    numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / VALUES).cast("int"))
    blocks = F.transform(numbers, lambda b: F.slice(values, b * VALUES + 1, F.lit(VALUES)))

    def spread(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, zero, combine))
        return F.flatten(F.zip_with(blocks, _before(totals, zero, combine), lambda b, at: _before(b, at, combine)))

    return let(blocks, spread)


def _before(values: Column, first: Column, combine: Callable[[Column, Column], Column]) -> Column:
    begin = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("seen"))
    return F.aggregate(
        values,
        begin,
        lambda acc, v: F.struct(
            combine(acc["at"], v).alias("at"), F.concat(acc["seen"], F.array(acc["at"])).alias("seen")
        ),
        lambda acc: acc["seen"],
    )


def text_blocks(text: Column) -> Column:
    """A text in blocks of as many characters each, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHARACTERS}}}"), F.lit(0))


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """Characters `start` to `end`, exclusive, of a text in blocks."""
    first = F.floor(start / CHARACTERS).cast("int")
    last = F.floor((end - 1) / CHARACTERS).cast("int")
    joined = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    place = (start - first * CHARACTERS + 1).cast("int")
    return F.when(end > start, F.substring(joined, place, (end - start).cast("int"))).otherwise("")
