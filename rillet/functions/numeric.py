"""Numeric helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_digits(c: Column, digits: int = 6) -> Column:
    """Round half up on the binary value: ``floor(x * 10^d + 0.5) / 10^d``.

    Plain IEEE arithmetic, so every engine that evaluates the same formula
    produces the same double (unlike decimal-string based rounding).  Values
    too large to have such digits, infinities and NaN stay as they are.
    """
    scale = float(10 ** digits)
    scaled = c * F.lit(scale)
    return F.when(F.abs(scaled) < F.lit(float(1 << 52)), F.floor(scaled + F.lit(0.5)) / F.lit(scale)).otherwise(c)
