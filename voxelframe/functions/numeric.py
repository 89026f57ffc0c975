"""Numeric helpers shared by queries, formulas and models."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values that define protected division in formula search:
# a denominator within this distance of zero yields this value.
PDIV_EPS = 0.001
PDIV_FALLBACK = 1.0

ROUND_DIGITS = 6


def r6(c: Column, digits: int = ROUND_DIGITS) -> Column:
    """Round for cross-engine comparison; ``+ 0.0`` turns -0.0 into 0.0."""
    return F.round(c, digits) + F.lit(0.0)


def sql_r6(e: str, digits: int = ROUND_DIGITS) -> str:
    return f"(round({e}, {digits}) + 0.0)"


def pdiv(n: Column, d: Column) -> Column:
    """Protected division: n / d, or 1.0 when |d| <= 0.001."""
    return F.when(F.abs(d) > F.lit(PDIV_EPS), n / d).otherwise(F.lit(PDIV_FALLBACK))


def register_sql_functions(spark: SparkSession) -> None:
    """SQL functions used by formula text (``F.expr``)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION pdiv(n DOUBLE, d DOUBLE) RETURNS DOUBLE "
        f"RETURN CASE WHEN abs(d) > {PDIV_EPS} THEN n / d ELSE {PDIV_FALLBACK} END")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION softplus(x DOUBLE) RETURNS DOUBLE "
        "RETURN CASE WHEN x > 20 THEN x ELSE log1p(exp(x)) END")


def softplus(x: Column) -> Column:
    """log(1 + e^x); returns x itself above 20 where the two agree in double."""
    return F.when(x > F.lit(20.0), x).otherwise(F.log1p(F.exp(x)))


def half_even(c: Column, digits: int) -> Column:
    """Round half to even (NumPy's rounding), not half up."""
    return F.bround(c, digits)


DRAW_BITS = 52


def draw(seed: int, *ids: Column) -> Column:
    """A 52-bit integer drawn from the seed and the identity columns (MD5 of
    their text): the same in every engine, partitioning and run."""
    text = F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def sql_draw(seed: int, *ids: str) -> str:
    text = ", ".join([f"'{seed}'", *[f"CAST({i} AS VARCHAR)" for i in ids]])
    return f"CAST('0x' || substr(md5(concat_ws(':', {text})), 1, {DRAW_BITS // 4}) AS BIGINT)"


def uniform_constant(seed: int, *ids: Column, low: float = -2.0, high: float = 2.0, digits: int = 2) -> Column:
    """A seeded uniform constant per row identity, rounded half-even."""
    return F.bround(draw(seed, *ids) / F.lit(float(1 << DRAW_BITS)) * F.lit(high - low) + F.lit(low), digits)


def random_int(seed: int, *ids: Column, low: int, high: int) -> Column:
    """A seeded integer in [low, high] per row identity."""
    return F.pmod(draw(seed, *ids), F.lit(high - low + 1)) + F.lit(low)
