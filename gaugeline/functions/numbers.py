"""Decimal text to whole units of 10^-scale (tenths at scale 1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# |t| stays below 10^18 < 2^60, which `operators.stats` relies on for overflow-free sums.
DIGITS = 18

# Units below this come out whole when a double is multiplied and rounded.
_DOUBLE = 10**14

# Sign, digits with an optional point, exponent.
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Numbers this short skip the pattern.
SHORT = 6


def is_number(name: str) -> Column:
    """True for decimal text in column `name`. Ordinary short numbers are settled by byte tests alone.

    The decimal cast itself trims control characters and takes any Unicode digit, so the short
    route asks for ASCII without an exponent or an outer byte below '+'.
    """
    return F.expr(
        f"""(octet_length({name}) <= {SHORT} AND char_length({name}) = octet_length({name})
             AND {name} >= '+' AND substring(cast({name} AS BINARY), -1, 1) >= X'2B'
             AND NOT contains({name}, 'e') AND NOT contains({name}, 'E'))
            OR {name} RLIKE r'{NUMBER}'"""
    )


def decimal(name: str, scale: int) -> Column:
    """Text known to be a number as DECIMAL, rounded half up; NULL if it has too many digits.

    The cast builds a number with as many digits as the exponent says. An exponent beyond the
    mantissa's length by more than 40 makes 0 or something far too large, so the cast never sees one.
    """
    mantissa = f"substring_index(lower({name}), 'e', 1)"
    power = f"substring_index(trim(lower({name})), 'e', -1)"
    exponent = f"coalesce(try_cast({power} AS INT), if(contains({name}, 'e-') OR contains({name}, 'E-'), -1, 1) * 2000000000)"
    room = f"octet_length({mantissa}) + 40"
    text = f"""CASE WHEN NOT contains({name}, 'e') AND NOT contains({name}, 'E') THEN {name}
                    WHEN {mantissa} RLIKE r'^\\s*[+-]?[0.]+$' THEN '0'
                    WHEN {exponent} < -({room}) THEN '0'
                    WHEN {exponent} <= {room} THEN {name} END"""
    return F.expr(f"try_cast({text} AS DECIMAL({DIGITS},{scale}))")


def units_of(decimal_sql: str, scale: int) -> str:
    """SQL for the units of a DECIMAL(DIGITS, scale).

    Where the product is far below 2^53, `rint` of the double restores the exact whole number; a
    decimal product would be several times slower and is kept for the large ones.
    """
    return f"""if(abs({decimal_sql}) < {_DOUBLE // 10**scale}, cast(rint(cast({decimal_sql} AS DOUBLE) * {10**scale}D) AS BIGINT),
                  cast({decimal_sql} * {10**scale} AS BIGINT))"""


def wide(name: str, decimal_name: str) -> Column:
    """The number in text column `name` as DOUBLE where its `decimal` (column `decimal_name`) is NULL; NULL beyond doubles.

    Only rows without a decimal, which are few, meet the pattern (the short route of `is_number` leaves some
    tests to the decimal).
    """
    value = F.col(name).try_cast("double")
    finite = F.when(F.abs(value) < float("inf"), value)
    return F.when(F.col(decimal_name).isNull(), F.when(F.col(name).rlike(NUMBER), finite))


def to_units(name: str, scale: int = 1) -> Column:
    """Units as BIGINT, rounded half up to `scale` digits.

    NULL when the text is no number, or one of 10^18 units and more.
    """
    value = F.when(is_number(name), decimal(name, scale))
    small = F.rint(value.cast("double") * float(10**scale)).cast("bigint")
    return F.when(F.abs(value) < _DOUBLE // 10**scale, small).otherwise((value * 10**scale).cast("bigint"))


def units_from_digits(name: str) -> Column:
    """Tenths by dropping the point: `12.3` is 123, `100` is 1000. Only for `-?d+` or `-?d+.d` that fit BIGINT."""
    text = F.col(name)
    digits = F.replace(text, F.lit("."), F.lit("")).try_cast("bigint")
    return F.when(text.rlike("^-?[0-9]+[.][0-9]$"), digits).when(
        text.rlike("^-?[0-9]+$"), F.try_multiply(digits, F.lit(10).cast("bigint"))
    )


def units_truncated(name: str) -> Column:
    """Tenths through a double, cut toward zero; NULL where they don't fit BIGINT."""
    return F.when(is_number(name), F.expr(f"try_cast(try_cast({name} AS DOUBLE) * 10D AS BIGINT)"))
