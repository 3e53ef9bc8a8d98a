"""Vector functions on arrays of floats; sums are doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda total, x: total + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda total, x: total + x.cast("double") * x.cast("double")))


def is_usable(v: Column, dims: int | None = None) -> Column:
    """Finite, not null, not zero and, if told, of the right length."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    good = v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    return F.coalesce(good & (F.size(v) == dims) if dims else good, F.lit(False))


def normalize(v: Column) -> Column:
    """Length one; null where the vector is not usable."""
    return F.when(is_usable(v), F.transform(F.array(norm(v)), lambda n: F.transform(v, lambda x: x.cast("double") / n)).getItem(0))
