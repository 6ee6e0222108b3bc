"""Cells: fill values, validity, bounds. Missing is NaN inside a cube, never null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
DECLARED_FILL = -9999.0


def fill_values(undeclared: Sequence[float]) -> list[float]:
    """The declared fill value and those that a source uses without declaring them."""
    return [DECLARED_FILL, *undeclared]


def _same_type(values: Sequence[float], kind: str) -> list[Column]:
    return [F.lit(float(x)).cast(kind) for x in values]


def is_fill(v: Column, fills: Sequence[float], kind: str = "float") -> Column:
    return v.isin(*_same_type(fills, kind)) if fills else F.lit(False)


def mask_fill(v: Column, fills: Sequence[float], kind: str = "float") -> Column:
    """``v`` with every fill value as NaN, of the same type; unchanged without fill values."""
    return F.when(is_fill(v, fills, kind), F.lit(NAN).cast(kind)).otherwise(v) if fills else v


def is_valid(v: Column, fills: Sequence[float] = (), kind: str = "float") -> Column:
    return v.isNotNull() & ~F.isnan(v) & ~is_fill(v, fills, kind)


def is_finite(v: Column) -> Column:
    return ~F.isnan(v) & (F.abs(v) < float("inf"))


def same_cell(a: Column, b: Column) -> Column:
    """Bit-level agreement of values: NaN only agrees with NaN."""
    return F.when(F.isnan(a) | F.isnan(b), F.isnan(a) & F.isnan(b)).otherwise(a == b)
