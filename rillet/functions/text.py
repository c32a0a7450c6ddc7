"""String functions with Java semantics, written as native Spark expressions.

All of these compile to JVM expressions (higher-order ``aggregate`` over the
characters of a string, ``regexp_replace``/``split``), so no Python runs per
row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The distinct-visitor offset hash multiplies by 61 and keeps
# the low 29 bits (a 2^29-bit bitmap); Java's String.hashCode multiplies by 31.
POLY_SEED = 61
POLY_CAP = 1 << 29
JAVA_HASH_SEED = 31
# Url suffixes treated as static assets by the hot-pages job.
ASSET_SUFFIXES = ("css", "js", "png", "ico")


_REGEX_META = set(".^$|?*+()[]{}\\")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c, sep: str) -> Column:
    """``String.split(sep)`` semantics: trailing empty strings are removed.

    ``''`` gives one empty token, an all-separator string gives none, and
    inner empty tokens are kept.  ``sep`` is a Java regular expression.
    """
    c = _col(c)
    if len(sep) == 1 and sep not in _REGEX_META:
        # one literal character: strip the trailing run without a regex
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, f"(?:{sep})+\\z", "")
    return (F.when(c == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, sep, -1)))


def java_split_sql(expr: str, sep: str) -> str:
    """Same as :func:`java_split`, as a Spark SQL expression string."""
    s = sep.replace("'", "\\'")
    return (f"CASE WHEN {expr} = '' THEN array('') "
            f"WHEN regexp_replace({expr}, '(?:{s})+\\\\z', '') = '' THEN CAST(array() AS ARRAY<STRING>) "
            f"ELSE split(regexp_replace({expr}, '(?:{s})+\\\\z', ''), '{s}', -1) END")


def utf16_length(c) -> Column:
    """``String.length()``: UTF-16 units, so a character beyond U+FFFF counts twice."""
    c = _col(c)
    return F.length(c) + F.length(F.regexp_replace(c, "[\\x00-\\x{FFFF}]", ""))


def _fold_hash(c: Column, seed: int, mask: int) -> Column:
    """``h = h*seed + unit`` over the string's UTF-16 units, reduced by ``mask``.

    A character beyond U+FFFF adds its two surrogates.  Masking after every
    step keeps the accumulator below 2^37, so ANSI overflow checks never fire,
    and equals masking once at the end.
    """
    def step(h: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        high, low = F.shiftright(code - 0x10000, 10) + 0xD800, (code - 0x10000).bitwiseAND(F.lit(0x3FF)) + 0xDC00
        first = (h * seed + F.when(code < 0x10000, code).otherwise(high)).bitwiseAND(F.lit(mask))
        return F.when(code < 0x10000, first).otherwise((first * seed + low).bitwiseAND(F.lit(mask)))

    return F.aggregate(F.split(c, ""), F.lit(0).cast("bigint"), step)


def poly_hash(c, seed: int = POLY_SEED, cap: int = POLY_CAP) -> Column:
    """``h = h*seed + char`` over the string, reduced to ``[0, cap)``; cap is a power of two."""
    if cap & (cap - 1):
        raise ValueError("cap must be a power of two")
    return _fold_hash(_col(c), seed, cap - 1)


def poly_hash_of_integer(name: str, seed: int = POLY_SEED, cap: int = POLY_CAP) -> Column:
    """:func:`poly_hash` of ``cast(name AS STRING)`` for a non-negative integral
    column, as plain arithmetic: with digits d_j counted from the right,
    ``sum((48 + d_j) * seed^j) mod cap`` over the digits present.

    No per-row array or string is built, so it stays inside whole-stage
    codegen.  Negative values (a leading '-') fall back to the string form.
    """
    if cap & (cap - 1):
        raise ValueError("cap must be a power of two")
    u = F.col(name).cast("bigint")
    total = None
    for j in range(19):  # a bigint has at most 19 digits
        digit = F.expr(f"(CAST(`{name}` AS BIGINT) div {10 ** j}) % 10")
        term = (F.lit(48) + digit) * F.lit(pow(seed, j, cap))
        if j:
            term = F.when(u >= F.lit(10 ** j), term).otherwise(F.lit(0))
        total = term if total is None else total + term
    arithmetic = total.bitwiseAND(F.lit(cap - 1))
    return F.when(u >= 0, arithmetic).otherwise(poly_hash(u.cast("string"), seed, cap))


def java_string_hash(c) -> Column:
    """``String.hashCode()`` as a signed 32-bit int, over UTF-16 units."""
    u = _fold_hash(_col(c), JAVA_HASH_SEED, 0xFFFFFFFF)
    return _to_int32(u)


def scaled_hash_code(c, factor: int = 23) -> Column:
    """``str.hashCode() * factor`` with 32-bit wrap-around, as ``int``."""
    u = _fold_hash(_col(c), JAVA_HASH_SEED, 0xFFFFFFFF)
    factor_u = factor & 0xFFFFFFFF
    if factor_u >= 1 << 26:  # keep the product below 2^63 under ANSI mode
        raise ValueError("factor too large")
    return _to_int32((u * factor_u).bitwiseAND(F.lit(0xFFFFFFFF)))


def _to_int32(u: Column) -> Column:
    return F.when(u >= F.lit(1 << 31), u - F.lit(1 << 32)).otherwise(u).cast("int")


def asset_url(c, suffixes=ASSET_SUFFIXES) -> Column:
    """True when the url ends in a static-asset suffix (``.css`` ``.js`` ...)."""
    alt = "|".join(re.escape(s) for s in suffixes)
    return _col(c).rlike(f"\\.({alt})$")


def register_sql_functions(spark: SparkSession, hash_factor: int = 23) -> None:
    """Register SQL scalar functions; they are inlined, so they stay native."""
    def fold(seed: int, mask: int) -> str:
        first = (f"((a * {seed} + IF(ascii(c) < 65536, ascii(c), shiftright(ascii(c) - 65536, 10) + 55296)) "
                 f"& {mask}L)")
        return (f"(a, c) -> IF(ascii(c) < 65536, {first}, "
                f"({first} * {seed} + ((ascii(c) - 65536) & 1023) + 56320) & {mask}L)")

    u = f"((a * {hash_factor}) & 4294967295L)"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION hash_code(s STRING) RETURNS INT RETURN "
        f"aggregate(split(s, ''), 0L, {fold(JAVA_HASH_SEED, 0xFFFFFFFF)}, "
        f"a -> CAST({u} - shiftright({u}, 31) * 4294967296L AS INT))")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION poly_offset(s STRING) RETURNS BIGINT RETURN "
        f"aggregate(split(s, ''), 0L, {fold(POLY_SEED, POLY_CAP - 1)})")
