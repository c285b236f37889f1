"""Key columns that depend on the row alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_YEAR_DAYS = 365
_HASH_DIGITS = 64  # hexadecimal digits of a 256-bit hash
_PIECE_DIGITS = 15  # the most that surely fit a bigint


def sparse_id() -> Column:
    """Unique but neither dense nor stable across layouts; jumps at every partition."""
    return F.monotonically_increasing_id()


def hash_key(*cols: Column | str) -> Column:
    """64-bit hash key."""
    return F.xxhash64(*cols)


def prefixed_id(prefix: str, c: Column, width: int) -> Column:
    """`prefix` + zero-padded number. Numbers wider than `width` keep all their digits, so ids never collide."""
    text = c.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def date_by_modulo(id_col: Column, start: str, days: int) -> Column:
    """Deterministic date: `start` + `id % days`. Feed dense ids; sparse ones bunch up."""
    return F.date_add(F.to_date(F.lit(start)), F.pmod(id_col, F.lit(days)).cast("int"))


def date_key(d: Column) -> Column:
    """Date as the integer yyyymmdd."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def date_by_hash(id_col: Column, year: int) -> Column:
    """Stable pseudo-random date key: day `sha256(id) mod 365` of the year, as yyyymmdd.

    The remainder of the 256-bit number is folded from pieces of 60 bits, so it stays inside generated code.
    """
    digest = F.sha2(id_col.cast("string"), _HASH_DIGITS * 4)
    remainder = F.lit(0).cast("bigint")
    for start in range(0, _HASH_DIGITS, _PIECE_DIGITS):
        digits = min(_PIECE_DIGITS, _HASH_DIGITS - start)
        piece = F.conv(F.substring(digest, start + 1, digits), 16, 10).cast("bigint")
        remainder = (remainder * (16**digits % _YEAR_DAYS) + piece) % _YEAR_DAYS
    return date_key(F.date_add(F.make_date(F.lit(year), F.lit(1), F.lit(1)), remainder.cast("int")))
