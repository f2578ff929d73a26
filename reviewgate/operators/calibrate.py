"""Calibration: NLL, NLL over a temperature grid, temperature fit, ECE,
reliability bins, before/after (F1-F5, F9)."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import scores


def _clipped_nll(p_label: Column) -> Column:
    # least/greatest skip nulls, so keep a missing probability null explicitly
    return F.when(p_label.isNotNull(),
                  -F.log(F.greatest(F.least(p_label, F.lit(1.0)), F.lit(config.NLL_CLIP))))


def negative_log_likelihood(df: DataFrame, probs_col: str = "probs",
                            label_col: str = "label_id") -> DataFrame:
    """Mean -ln(clip(p[label], 1e-12, 1)) (F1). A label outside the score
    vector gives a null probability; such rows are counted in bad_label_count
    and excluded (NumPy would silently wrap a negative index)."""
    p = F.get(F.col(probs_col), F.col(label_col))
    return df.agg(
        F.avg(_clipped_nll(p)).alias("nll"),
        F.count_if(p.isNull()).alias("bad_label_count"),
        F.count(F.lit(1)).alias("n"),
    )


def _nll_at(logits: Column, label: Column, t: Column, n_classes: int | None = None) -> Column:
    """Row NLL at temperature t with the same arithmetic as softmax(z / t).

    With a known class count the score vector is unrolled into K scalar
    expressions, which stay in generated code; otherwise lambdas are used."""
    if n_classes:
        z = [F.get(logits, i) / t for i in range(n_classes)]
        top = F.greatest(*z) if n_classes > 1 else z[0]
        denom = None
        for zi in z:
            term = F.exp(zi - top)
            denom = term if denom is None else denom + term
        p = F.exp(F.get(logits, label) / t - top) / denom
        return F.when(F.size(logits) == n_classes, _clipped_nll(p))
    top = F.array_max(logits) / t
    denom = F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x / t - top))
    p = F.exp(F.get(logits, label) / t - top) / denom
    return _clipped_nll(p)


def nll_grid(df: DataFrame, temperatures, logits_col: str = "logits",
             label_col: str = "label_id", n_classes: int | None = None) -> DataFrame:
    """NLL at many temperatures in one scan (F2): one aggregate with an average for each
    temperature, so every row is read once and none is repeated; one row comes out, turned
    into a row per temperature at the end."""
    temps = [float(t) for t in temperatures]
    data = df.select(F.col(logits_col).alias("_z"), F.col(label_col).alias("_y"))
    sums = data.agg(*[F.avg(_nll_at(F.col("_z"), F.col("_y"), F.lit(t), n_classes)).alias(f"n{i}")
                      for i, t in enumerate(temps)])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(t).alias("temperature"), F.col(f"n{i}").alias("nll"))
                                           for i, t in enumerate(temps)])).alias("p")).select("p.*")


def class_count(df: DataFrame, logits_col: str = "logits") -> int | None:
    """Score-vector length when all rows agree (one cheap aggregate), else None."""
    r = df.agg(F.min(F.size(logits_col)).alias("a"), F.max(F.size(logits_col)).alias("b")).first()
    return int(r["a"]) if r["a"] is not None and r["a"] == r["b"] and r["a"] > 0 else None


def _newton_terms(logits: Column, label: Column, beta: float, n_classes: int | None):
    """Per-row gradient and curvature of the clipped NLL in beta = 1 / T.
    Rows whose label probability is clipped contribute zero (the clipped
    loss is flat there)."""
    b = F.lit(float(beta))
    if n_classes:
        z = [F.get(logits, i) for i in range(n_classes)]
        x = [b * zi for zi in z]
        top = F.greatest(*x) if n_classes > 1 else x[0]
        e = [F.exp(xi - top) for xi in x]
        total = e[0]
        for ei in e[1:]:
            total = total + ei
        ez = e[0] * z[0]
        ez2 = e[0] * z[0] * z[0]
        for ei, zi in zip(e[1:], z[1:]):
            ez = ez + ei * zi
            ez2 = ez2 + ei * zi * zi
        ez, ez2 = ez / total, ez2 / total
        zy = F.get(logits, label)
        py = F.exp(b * zy - top) / total
        ok = (F.size(logits) == n_classes) & zy.isNotNull()
    else:
        top = F.array_max(logits) * b
        e = F.transform(logits, lambda v: F.exp(v * b - top))
        total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
        ez = F.aggregate(F.zip_with(e, logits, lambda ei, zi: ei * zi), F.lit(0.0),
                         lambda a, v: a + v) / total
        ez2 = F.aggregate(F.zip_with(e, logits, lambda ei, zi: ei * zi * zi), F.lit(0.0),
                          lambda a, v: a + v) / total
        zy = F.get(logits, label)
        py = F.exp(b * zy - top) / total
        ok = zy.isNotNull()
    live = ok & (py >= F.lit(config.NLL_CLIP))
    g = F.when(live, ez - zy).otherwise(F.lit(0.0))
    h = F.when(live, ez2 - ez * ez).otherwise(F.lit(0.0))
    return g, h


def fit_temperature(df: DataFrame, lower: float = config.MIN_TEMPERATURE,
                    upper: float = config.MAX_TEMPERATURE, points: int = 16,
                    tolerance: float = 1e-6, max_steps: int = 40,
                    logits_col: str = "logits", label_col: str = "label_id") -> float:
    """Minimise the clipped NLL over T in [lower, upper].

    One grid pass over ``points`` values of 1/T (NLL is convex in 1/T away
    from the clip) brackets the minimum; a safeguarded Newton iteration on
    1/T then converges in a few passes, each one aggregate of gradient and
    curvature over the persisted (logits, label) rows. Steps that leave the
    bracket fall back to bisection."""
    if not 0 < lower < upper:
        raise ValueError(f"temperatures {lower} to {upper} are no positive range")
    data = df.select(logits_col, label_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if data.limit(1).count() == 0:
            raise ValueError("at least one observation is required")
        k = class_count(data, logits_col)
        b_min, b_max = 1.0 / upper, 1.0 / lower
        betas = [b_min + (b_max - b_min) * i / (points - 1) for i in range(points)]
        temps = [1.0 / b for b in betas]
        rows = {r["temperature"]: r["nll"]
                for r in nll_grid(data, temps, logits_col, label_col, k).collect()}
        values = [rows[t] for t in temps]
        j = min(range(points), key=lambda i: (values[i], i))
        lo, hi = betas[max(j - 1, 0)], betas[min(j + 1, points - 1)]
        beta = betas[j]
        for _ in range(max_steps):
            g, h = _newton_terms(F.col(logits_col), F.col(label_col), beta, k)
            r = data.agg(F.avg(g).alias("g"), F.avg(h).alias("h")).first()
            grad, curv = r["g"], r["h"]
            if grad is None or not math.isfinite(grad):
                raise RuntimeError("temperature fitting failed")
            if grad > 0:
                hi = beta
            elif grad < 0:
                lo = beta
            else:
                break
            step = grad / curv if curv and curv > 0 else None
            nxt = beta - step if step is not None else None
            if nxt is None or not lo < nxt < hi:
                nxt = (lo + hi) / 2
            done = abs(1.0 / nxt - 1.0 / beta) < tolerance or (1.0 / lo - 1.0 / hi) < tolerance
            beta = nxt
            if done:
                break
        else:
            raise RuntimeError(f"no convergence in {max_steps} steps")
        t = 1.0 / beta
        if not math.isfinite(t):
            raise RuntimeError("temperature fitting failed")
        return float(min(max(t, lower), upper))
    finally:
        data.unpersist()


def binned(scored: DataFrame, n_bins: int) -> DataFrame:
    """Per-bin count, accuracy and mean confidence over equal-width bins. The bin is an
    aggregate output: a predicate on the grouping key would be pushed below the scoring
    projection and inline the softmax into a filter once for each edge."""
    return scored.withColumn("_bin", scores.bin_index(F.col("confidence"), n_bins)).groupBy("_bin").agg(
        F.max("_bin").alias("bin"),
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("correct").cast("double")).alias("accuracy"),
        F.avg("confidence").alias("mean_confidence"),
    ).drop("_bin")


def expected_calibration_error(scored: DataFrame, n_bins: int = config.ECE_BINS) -> DataFrame:
    """Sum over bins of share x |accuracy - mean confidence| (F4). The share's
    denominator counts all rows, also those in no bin."""
    if n_bins <= 0:
        raise ValueError("positive n_bins is required")
    b = binned(scored, n_bins)
    return b.agg(
        (F.sum(F.when(F.col("bin").isNotNull(),
                      F.col("n") * F.abs(F.col("accuracy") - F.col("mean_confidence"))))
         / F.sum("n")).alias("ece"),
        F.sum("n").alias("n"),
    ).select(F.coalesce(F.col("ece"), F.lit(0.0)).alias("ece"), "n")


def reliability_table(scored: DataFrame, n_bins: int = config.RELIABILITY_BINS) -> DataFrame:
    """Non-empty bins with centre, accuracy and mean confidence."""
    edges = scores.linspace_edges(n_bins)
    centres = F.array(*[F.lit((edges[i] + edges[i + 1]) / 2) for i in range(n_bins)])
    return binned(scored, n_bins).where(F.col("bin").isNotNull()).select(
        "bin", F.get(centres, F.col("bin")).alias("centre"), "accuracy", "mean_confidence",
        F.col("n").alias("count"))


def calibration_before_after(df: DataFrame, temperature: float, n_bins: int = config.ECE_BINS,
                             logits_col: str = "logits", label_col: str = "label_id") -> DataFrame:
    """NLL and ECE of the same rows at T = 1 and at the given T.

    One scan: each row fans out to its two stages, then one partial
    aggregate per (stage, bin) and a tiny final fold."""
    stages = F.array(*[
        F.struct(F.lit(tag).alias("stage"), F.lit(t).alias("temperature"),
                 scores.temperature_softmax(F.col(logits_col), t).alias("probs"))
        for tag, t in (("before", 1.0), ("after", float(temperature)))])
    s = df.select(F.col(label_col).alias("label_id"), F.inline(stages))
    s = s.select(
        "stage", "temperature", "label_id",
        _clipped_nll(F.get(F.col("probs"), F.col("label_id"))).alias("row_nll"),
        scores.confidence(F.col("probs")).alias("confidence"),
        F.coalesce(scores.arg_max(F.col("probs")) == F.col("label_id"),
                   F.lit(False)).alias("correct"))
    bins = s.groupBy("stage", "temperature",
                     scores.bin_index(F.col("confidence"), n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("row_nll").alias("nll_sum"),
        F.avg(F.col("correct").cast("double")).alias("accuracy"),
        F.avg("confidence").alias("mean_confidence"))
    return bins.groupBy("stage", "temperature").agg(
        (F.sum("nll_sum") / F.sum("n")).alias("nll"),
        F.coalesce(F.sum(F.when(F.col("bin").isNotNull(), F.col("n") * F.abs(
            F.col("accuracy") - F.col("mean_confidence")))) / F.sum("n"),
            F.lit(0.0)).alias("ece"))
