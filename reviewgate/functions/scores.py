"""Score-vector expressions: softmax, temperature, top label, top-k, Wilson.

Scores are ARRAY<DOUBLE> columns, one row per record; every function is a
Catalyst expression, so they run inside the executor JVM.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def _broadcast_op(values: Column, scalar: Column, op) -> Column:
    """Apply op(x, scalar) to every element. The row scalar is passed next to
    the array instead of being captured by the lambda, so it is computed once
    per row rather than once per element."""
    return F.zip_with(values, F.array_repeat(scalar, F.size(values)), op)


def exp_shifted(logits: Column) -> Column:
    """exp(z - max z), the numerically stable numerator of softmax."""
    return _broadcast_op(logits, F.array_max(logits), lambda x, m: F.exp(x - m))


def normalise(weights: Column) -> Column:
    """Divide by the row sum (summed left to right, as NumPy does for short rows)."""
    total = F.aggregate(weights, F.lit(0.0), lambda acc, x: acc + x)
    return _broadcast_op(weights, total, lambda x, s: x / s)


def softmax(logits: Column) -> Column:
    """Stable row softmax."""
    return normalise(exp_shifted(logits))


def softmax_fixed(logits: Column, n_classes: int, temperature=1.0) -> Column:
    """softmax(logits / T) for vectors of known length K, unrolled into K
    scalar expressions so it runs in generated code. Rows of another length
    give null (validate_score_shape reports them)."""
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    x = [F.get(logits, i) / t for i in range(n_classes)]
    top = F.greatest(*x) if n_classes > 1 else x[0]
    e = [F.exp(xi - top) for xi in x]
    total = e[0]
    for ei in e[1:]:
        total = total + ei
    return F.when(F.size(logits) == n_classes, F.array(*[ei / total for ei in e]))


def scale(logits: Column, temperature) -> Column:
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    return F.transform(logits, lambda x: x / t)


def temperature_softmax(logits: Column, temperature) -> Column:
    """softmax(logits / T)."""
    return softmax(scale(logits, temperature))


def confidence(probs: Column) -> Column:
    return F.array_max(probs)


def arg_max(probs: Column) -> Column:
    """First index of the maximum, 0-based (as NumPy argmax)."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def top_k(probs: Column, k: int, labels: list[str] | tuple[str, ...] | None = None) -> Column:
    """Top-k (label, probability) by probability descending, ties by class index."""
    keyed = F.transform(probs, lambda x, i: F.struct((-x).alias("neg"), i.alias("class_id")))
    best = F.slice(F.array_sort(keyed), 1, k)
    if labels is None:
        return F.transform(best, lambda s: F.struct(
            s["class_id"].alias("class_id"), (-s["neg"]).alias("probability")))
    names = F.array(*[F.lit(x) for x in labels])
    return F.transform(best, lambda s: F.struct(
        s["class_id"].alias("class_id"),
        F.get(names, s["class_id"]).alias("label"),
        (-s["neg"]).alias("probability")))


def wilson_z(confidence_level: float = 0.95) -> float:
    return NormalDist().inv_cdf(0.5 + confidence_level / 2)


def wilson_bounds(successes: Column, total: Column, confidence_level: float = 0.95):
    """Wilson score interval clipped to [0, 1] (B15). Null when total <= 0."""
    z = F.lit(wilson_z(confidence_level))
    n = total.cast("double")
    valid = (total > 0) & (successes >= 0) & (successes <= total)
    p = successes.cast("double") / n
    denom = F.lit(1.0) + z * z / n
    center = (p + z * z / (F.lit(2.0) * n)) / denom
    margin = z * F.sqrt(p * (F.lit(1.0) - p) / n + z * z / (F.lit(4.0) * n * n)) / denom
    low = F.when(valid, F.greatest(F.lit(0.0), center - margin))
    high = F.when(valid, F.least(F.lit(1.0), center + margin))
    return low, high


def linspace_edges(n_bins: int) -> list[float]:
    """Bin edges exactly as numpy.linspace(0, 1, n_bins + 1) computes them."""
    step = 1.0 / n_bins
    edges = [i * step + 0.0 for i in range(n_bins + 1)]
    edges[-1] = 1.0
    return edges


def bin_index(conf: Column, n_bins: int) -> Column:
    """Right-closed equal-width bin (first bin also left-closed); null outside [0, 1].

    A CASE chain over literal edges keeps it in generated code (no lambda)."""
    edges = linspace_edges(n_bins)
    expr = F.when(conf.isNull() | F.isnan(conf) | (conf < F.lit(edges[0])), F.lit(None))
    for i in range(n_bins):
        expr = expr.when(conf <= F.lit(edges[i + 1]), F.lit(i))
    return expr.otherwise(F.lit(None)).cast("int")
