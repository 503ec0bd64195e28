"""Vector arithmetic on array columns, for pairs that are already side by side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
