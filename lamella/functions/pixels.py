"""Column expressions on pixel values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def subtract_background(v: Column, lo: int = 100, hi: int = 65535) -> Column:
    """Values outside [lo, hi] become lo, then lo is taken off."""
    return F.when((v < lo) | (v > hi), 0).otherwise(v - lo)


def log_intensity(v: Column, as_byte: bool = False) -> Column:
    """Clamp of (ln v - 4.6) * 39.4 to [0, 255]; 0 for v of 0. As a byte, rounded half to even."""
    out = F.when(v > 0, F.greatest(F.lit(0.0), F.least(F.lit(255.0), (F.ln(v) - 4.6) * 39.4))).otherwise(F.lit(0.0))
    return F.bround(out, 0).cast("int") if as_byte else out


def quantize(v: Column) -> Column:
    """Multiple of 16 nearest to a 16-bit value, no more than 65520."""
    return F.least(F.shiftleft(F.shiftright(v + 8, 4), 4), F.lit(65520))
