"""Dense-vector expressions on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sq_norm(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays zero.

    The squared norm is the accumulator of one ``aggregate`` and the division
    happens in its finish step, so the norm is computed once per row (an
    outer norm expression inside the element lambda would be re-evaluated
    for every element)."""
    return F.aggregate(
        v, F.lit(0.0).cast("double"),
        lambda acc, x: acc + x.cast("double") * x.cast("double"),
        lambda acc: F.transform(v, lambda x: F.when(acc > 0, x.cast("double") / F.sqrt(acc))
                                .otherwise(x.cast("double"))))


def dot(a: Column, b: Column) -> Column:
    """Inner product; equals cosine similarity on unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)
