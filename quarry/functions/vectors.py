"""Vector helpers (Q16-Q19) for array columns; the long-table forms live in the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sublinear(n) -> Column:
    """0 for 0, else 1 + log10(n) (Q16)."""
    n = _col(n)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.lit(1.0) + F.log10(n.cast("double")))


def sublinear_array(v) -> Column:
    return F.transform(_col(v), lambda x: F.when(x == 0, F.lit(0.0)).otherwise(F.lit(1.0) + F.log10(x.cast("double"))))


def _same_length(a: Column, b: Column, out: Column) -> Column:
    return F.when(F.size(a) == F.size(b), out).otherwise(F.raise_error(F.lit("array lengths differ")))


def dot(a, b) -> Column:
    """Dot product of equal-length arrays; unequal lengths raise like the reference (Q17)."""
    a, b = _col(a), _col(b)
    prod = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return _same_length(a, b, prod)


def vec_diff(a, b) -> Column:
    """Element-wise a - b; unequal lengths raise (Q18)."""
    a, b = _col(a), _col(b)
    return _same_length(a, b, F.zip_with(a, b, lambda x, y: x - y))


def vec_scale(v, norm) -> Column:
    """Float division of every element by ``norm`` (Q19)."""
    norm = _col(norm) if not isinstance(norm, (int, float)) else F.lit(float(norm))
    return F.transform(_col(v), lambda x: x.cast("double") / norm)


def idiv(a, b) -> Column:
    """Floor division of non-negative integers (Python 2 ``/`` on ints), exact in integer arithmetic."""
    a, b = _col(a), (_col(b) if not isinstance(b, int) else F.lit(b))
    return ((a - F.pmod(a, b)) / b).cast("bigint")
