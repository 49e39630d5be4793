"""Column expressions that render a visibility score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsmith.functions.text import col_
from docsmith.schema import STAR


def star_count(score: Column | str) -> Column:
    """Stars out of five: ``score * 5`` rounded half-to-even."""
    return F.bround(col_(score) * 5, 0).cast("int")


def stars(score: Column | str) -> Column:
    """SCL7: the star glyph repeated ``star_count`` times (none if negative)."""
    return F.repeat(F.lit(STAR), F.greatest(star_count(score), F.lit(0)))


def one_decimal(score: Column | str) -> Column:
    """SCL8: ``score`` printed with one decimal, rounded half-to-even on the
    exact binary value (as C ``printf("%.1f")`` does).

    ``format_string('%.1f')`` rounds the shortest decimal form half-up and so
    prints 0.25 as 0.3 and 0.35 as 0.4.  Here the value is scaled by a power of
    two (exact in binary floating point) into a 64-bit integer and the decimal
    digit is rounded in integer arithmetic.  Exact for |score| < 2**49, which
    covers every score; larger magnitudes fall back to ``format_string``.
    """
    v = col_(score).cast("double")
    a = F.abs(v)
    e = F.floor(F.log2(a))
    s = (F.lit(57) - e).cast("int")
    n = (a * F.pow(F.lit(2.0), s)).cast("bigint")
    t = n * 10
    # t / 2**s and its remainder, in integer arithmetic only
    q = F.call_function("shiftright", t, s)
    r = t - F.call_function("shiftleft", q, s)
    half = F.call_function("shiftleft", F.lit(1).cast("bigint"), s - 1)
    up = (r > half) | ((r == half) & ((q % 2) == 1))
    q2 = q + F.when(up, 1).otherwise(0)
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    digit = q2 % 10
    # (q2 - digit) / 10 is exact in double while q2 < 2**53
    exact = F.concat(sign, ((q2 - digit) / 10).cast("bigint").cast("string"), F.lit("."), digit.cast("string"))
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(v), F.lit("nan"))
        .when(v == float("inf"), F.lit("inf"))
        .when(v == float("-inf"), F.lit("-inf"))
        .when(a < 0.03125, F.concat(sign, F.lit("0.0")))
        .when(a >= 2.0**49, F.format_string("%.1f", v))
        .otherwise(exact)
    )
