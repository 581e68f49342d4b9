"""Number expressions: rounding rules, forgiving parses and safe ratios."""

from __future__ import annotations

from hackney.functions.text import strip

# Texts (any case) that a forgiving parse reads as zero.
MISSING_TEXTS = ("", "null", "na", "nan")


def round_half_even(value: str, digits: int = 2) -> str:
    scale = f"1e{digits}D"
    return f"(rint(({value}) * {scale}) / {scale})"


def amount(value: str) -> str:
    """A value as a decimal of twelve places, so that sums do not depend on their order; null from 1e16 on, see `vast`.

    NaN and infinities are no amounts and count as missing.
    """
    return f"try_cast({value} AS decimal(28, 12))"


def vast(value: str) -> str:
    """Finite values that no decimal of sixteen whole digits holds, for plain sums of their own."""
    real = f"CAST({value} AS double)"
    return f"CASE WHEN abs({real}) >= 1e16D AND abs({real}) < double('Infinity') THEN {real} END"


def _with_vast(exact: str, value: str) -> str:
    """An exact result, and the sum of vast values on top of it where there are any."""
    return f"coalesce({exact} + sum({vast(value)}), sum({vast(value)}), {exact})"


def total(value: str, digits: int = 2) -> str:
    """An exact sum, rounded half up once."""
    return _with_vast(f"CAST(round(sum({amount(value)}), {digits}) AS double)", value)


def mean(value: str, digits: int = 2) -> str:
    """An exact sum over its number of values, rounded half up once."""
    exact = f"CAST(round(try_divide(sum({amount(value)}), count({amount(value)})), {digits}) AS double)"
    several = f"{whole_sum(value)} / (count({amount(value)}) + count({vast(value)}))"
    return f"CASE WHEN sum({vast(value)}) IS NULL THEN {exact} ELSE {several} END"


def whole_sum(value: str) -> str:
    """An exact sum as a double, for ratios."""
    return _with_vast(f"CAST(sum({amount(value)}) AS double)", value)


def number(value: str) -> str:
    return f"try_cast({value} AS double)"


def lenient_double(text: str) -> str:
    """Missing markers, NaN and infinities become 0.0; other junk becomes null.

    A null result marks a record to skip, so it must not be averaged over.
    """
    word = strip(f"coalesce({text}, '')")
    missing = ", ".join(f"'{marker}'" for marker in MISSING_TEXTS)
    parsed = f"coalesce({number(word)}, CASE WHEN lower({word}) IN ({missing}) THEN 0D END)"
    # Adding 0 * x keeps finite numbers and turns infinities into NaN, so one
    # parse serves the usual case. The cast also takes spellings such as `inf`;
    # only `Infinity` is a number.
    loose = f"({word} RLIKE '(?i)inf' AND NOT {word} RLIKE '^[+-]?Infinity$')"
    return f"nanvl({parsed} + {parsed} * 0D, CASE WHEN NOT {loose} THEN 0D END)"


def zero_filled(value: str) -> str:
    """The typed counterpart of `lenient_double`: null, NaN, infinite -> 0.0."""
    cast = f"CAST({value} AS double)"
    return f"coalesce(nanvl({cast} + {cast} * 0D, 0D), 0D)"


def strict_int(text: str) -> str:
    """Whole numbers only: `5` parses, `5.0` gives null."""
    return f"try_cast({strip(text)} AS int)"


def truncated_int(value: str) -> str:
    """Text or number to int through double, cutting the fraction."""
    return f"try_cast({number(value)} AS int)"


def percent(part: str, whole: str) -> str:
    return f"(try_divide({part}, {whole}) * 100D)"


def percent_or_zero(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {percent(part, whole)} ELSE 0D END"
