"""Vector and loss expressions over ARRAY<FLOAT> columns, accumulated in double."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def mean(a: Column) -> Column:
    return _sum(F.transform(a, lambda x: x.cast("double"))) / F.size(a)


def sample_std(a: Column) -> Column:
    """Unbiased standard deviation of the components (divides by n - 1)."""
    centred = F.transform(F.array(mean(a)), lambda m: _sum(
        F.transform(a, lambda x: (x.cast("double") - m) * (x.cast("double") - m))))[0]
    return F.sqrt(centred / (F.size(a) - 1))


def profile(a: Column, head: int = 10) -> list[Column]:
    """Mean, sample deviation, length and leading components of a vector."""
    return [mean(a).alias("mean"), sample_std(a).alias("std"), norm(a).alias("norm"),
            F.slice(a, 1, head).alias("head")]


def sigmoid(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def predicted(score: Column) -> Column:
    """1 where the sigmoid exceeds one half, which is where the score is positive."""
    return (score > 0).cast("int")


def logistic_loss(score: Column, label: Column) -> Column:
    """Binary cross-entropy from a raw score, in the form that cannot overflow."""
    return F.greatest(score, F.lit(0.0)) - score * label + F.log1p(F.exp(-F.abs(score)))
