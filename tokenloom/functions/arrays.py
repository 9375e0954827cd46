"""Column expressions over arrays of numbers, in double precision."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(values: Column) -> Column:
    return values.cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def sum_of_squares(values: Column) -> Column:
    return F.aggregate(doubles(values), F.lit(0.0), lambda acc, x: acc + x * x)


def rms_normalized(values: Column, gain: list[float] | None = None, eps: float = 1e-5) -> Column:
    """``x / sqrt(mean(x^2) + eps) * gain``."""
    scale = F.sqrt(sum_of_squares(values) / F.size(values) + F.lit(eps))
    if gain is None:
        return F.transform(doubles(values), lambda x: x / scale)
    weights = F.lit([float(g) for g in gain])
    return F.zip_with(doubles(values), weights, lambda x, g: x / scale * g)


def log_sum_exp(values: Column) -> Column:
    """Overflow-safe: the maximum is taken out first."""
    top = F.array_max(doubles(values))
    return top + F.log(F.aggregate(doubles(values), F.lit(0.0), lambda acc, x: acc + F.exp(x - top)))


def softmax(values: Column) -> Column:
    """Softmax inside one array."""
    shifted = log_sum_exp(values)
    return F.transform(doubles(values), lambda x: F.exp(x - shifted))
