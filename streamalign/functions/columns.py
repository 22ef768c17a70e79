"""Column functions: missing values, names and simple formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def finite(x: Column) -> Column:
    """x, or NULL for NaN and infinities, since Spark's aggregates carry NaN along."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def dff(df: Column, f0: Column, eps: float = 1e-6) -> Column:
    """Relative change over the baseline; NULL where the sum f0 + eps is 0."""
    return F.try_divide(df, f0 + F.lit(eps))


def plane_number(name: Column) -> Column:
    """The number of a plane named path3, DMD3 or alike, in any case; NULL if there is none."""
    digits = F.regexp_extract(name, r"(?i)(?:path|dmd)_?(\d+)", 1)
    return F.when(digits != "", digits.cast("int"))


def plane_name(name: Column) -> Column:
    return F.concat(F.lit("DMD"), plane_number(name).cast("string"))


def is_dff_series(name: Column) -> Column:
    """Whether a series' name says that it holds relative changes."""
    return F.regexp_replace(F.lower(name), " ", "_").rlike("dff|dfoverf|df_over_f|delta_f_over_f")


def is_f0_series(name: Column) -> Column:
    return F.contains(F.concat(F.lit("_"), F.regexp_replace(F.lower(name), " ", "_"), F.lit("_")), F.lit("_f0_"))


def degrees(angle: Column) -> Column:
    """Radians as degrees in [0, 360)."""
    return F.pmod(F.degrees(angle), F.lit(360.0))


def wrapped_difference(d: Column, bits: int = 16) -> Column:
    """A counter's difference d as the least step that gives it modulo 2**bits, from -half up to half - 1."""
    half, m = 1 << (bits - 1), 1 << bits
    return F.pmod(d + F.lit(half), F.lit(m)) - F.lit(half)
