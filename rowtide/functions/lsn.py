"""Log positions: the text form `X/Y` (two hex words) and its number."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_TEXT = r"^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"
_WORD = 4294967296


def _words(text: Column) -> tuple[Column, Column]:
    def word(i: int) -> Column:
        return F.conv(F.split_part(text, F.lit("/"), F.lit(i)), 16, 10).cast("bigint")

    return word(1), word(2)


def parse_lsn(text: Column) -> Column:
    """Position as bigint; NULL for NULL or malformed text.

    Positions of 2^63 and above (8 EiB of log) raise: use `parse_lsn_exact`.
    """
    high, low = _words(text)
    number = (
        F.when(high < 2**31, F.shiftleft(high, 32).bitwiseOR(low))
        .otherwise(F.raise_error(F.concat(F.lit("log position beyond 2^63: "), text)).cast("bigint"))
    )
    return F.when(text.rlike(_TEXT), number)


def parse_lsn_exact(text: Column) -> Column:
    """Position as decimal(20,0), exact over the whole unsigned range."""
    high, low = _words(text)
    number = high.cast("decimal(10,0)") * F.lit(_WORD).cast("decimal(10,0)") + low
    return F.when(text.rlike(_TEXT), number.cast("decimal(20,0)"))


def format_lsn(position: Column) -> Column:
    """Text form of a bigint position: upper-case hex without padding."""
    return F.concat(
        F.hex(F.shiftrightunsigned(position, 32)),
        F.lit("/"),
        F.hex(position.bitwiseAND(F.lit(_WORD - 1))),
    )


def format_lsn_exact(position: Column) -> Column:
    """Text form of a decimal(20,0) position."""
    high = F.floor(position / F.lit(_WORD).cast("decimal(10,0)"))
    low = position - high * F.lit(_WORD).cast("decimal(10,0)")
    return F.concat(F.hex(high.cast("bigint")), F.lit("/"), F.hex(low.cast("bigint")))


def retained_bytes(current: Column, restart: Column) -> Column:
    """Bytes between two text positions, 0 where either is unknown."""
    distance = parse_lsn_exact(current) - parse_lsn_exact(restart)
    return F.coalesce(distance.cast("bigint"), F.lit(0).cast("bigint"))
