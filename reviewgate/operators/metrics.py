"""Evaluation metrics from confusion cells.

Everything starts from ``groupBy(label, pred).count()``: a partial aggregate
whose output has at most K^2 rows, so the metric arithmetic after it never
touches row-level data again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .. import config
from .prefix import ordered_positions
from .row_weights import weighted_cells
from .rowkeys import written


def confusion_cells(df: DataFrame, label_col: str = "label_id",
                    pred_col: str = "pred_id") -> DataFrame:
    return df.groupBy(F.col(label_col).alias("label_id"), F.col(pred_col).alias("pred_id")) \
        .agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, classes: DataFrame, label_col: str = "label_id",
                     pred_col: str = "pred_id") -> DataFrame:
    """Dense K x K counts over a fixed class list, zeros kept (G1). Cells of
    ids outside the list are dropped here; per_class_metrics still sees them."""
    a = classes.select(F.col("class_id").alias("label_id"), F.col("label").alias("true_label"))
    b = classes.select(F.col("class_id").alias("pred_id"), F.col("label").alias("pred_label"))
    grid = a.crossJoin(b)  # K^2 rows from the fixed class list
    # the join asks for keys that are not null: on grouping keys that test would be pushed below
    # the scoring projection, with the softmax inlined
    cells = confusion_cells(df, label_col, pred_col).groupBy(F.struct("label_id", "pred_id").alias("_cell")).agg(
        F.max("label_id").alias("label_id"), F.max("pred_id").alias("pred_id"), F.sum("count").alias("count"))
    return grid.join(cells, ["label_id", "pred_id"], "left").select(
        "label_id", "pred_id", "true_label", "pred_label",
        F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count"))


def per_class_from_cells(cells: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per observed class (labels or
    predictions); 0 on zero division. ``cells`` has label_id, pred_id, count
    (plus optional group columns, e.g. a replicate id). One aggregate: each
    cell counts once for its true class and once for its predicted class."""
    g = list(group_cols)
    roles = F.array(
        F.struct(F.col("label_id").alias("class_id"), F.col("count").alias("s"),
                 F.lit(0).cast("long").alias("p"),
                 F.when(F.col("label_id") == F.col("pred_id"), F.col("count"))
                 .otherwise(F.lit(0).cast("long")).alias("t")),
        F.struct(F.col("pred_id").alias("class_id"), F.lit(0).cast("long").alias("s"),
                 F.col("count").alias("p"), F.lit(0).cast("long").alias("t")))
    per = cells.select(*g, F.inline(roles)).groupBy(*g, "class_id").agg(
        F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("t").alias("tp"))
    s, pr, t = F.col("support"), F.col("predicted"), F.col("tp")
    return per.select(
        *g, "class_id",
        F.coalesce(F.try_divide(t, pr), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(t, s), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * t, s + pr), F.lit(0.0)).alias("f1"),
        s.alias("support"), pr.alias("predicted"), t.alias("tp"),
    )


def per_class_metrics(df: DataFrame, label_col: str = "label_id",
                      pred_col: str = "pred_id") -> DataFrame:
    """(G2)"""
    return per_class_from_cells(confusion_cells(df, label_col, pred_col))


def summary_from_per_class(per_class: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    return per_class.groupBy(*group_cols).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("n"),
        F.count(F.lit(1)).alias("class_count"),
    )


def classification_metrics(df: DataFrame, label_col: str = "label_id",
                           pred_col: str = "pred_id") -> DataFrame:
    """Accuracy, macro-F1, support-weighted F1 over observed classes."""
    return summary_from_per_class(per_class_metrics(df, label_col, pred_col))


def _macro_f1_np(cells: np.ndarray) -> float:
    tp = np.diag(cells).astype(np.float64)
    support = cells.sum(axis=1).astype(np.float64)
    predicted = cells.sum(axis=0).astype(np.float64)
    denom = support + predicted
    f1 = np.divide(2 * tp, denom, out=np.zeros_like(tp), where=denom > 0)
    return float(f1.mean())


def bootstrap_replicates(df: DataFrame, n_resamples: int = config.BOOTSTRAP_RESAMPLES,
                         seed: int = config.SEED, label_col: str = "label_id",
                         pred_col: str = "pred_id", cells: DataFrame | None = None) -> DataFrame:
    """Macro-F1 of ``n_resamples`` row resamples with replacement.

    Resampling n rows is one multinomial draw over the confusion cells, so
    the rows are aggregated once on Spark (at most K^2 cells reach the
    driver; give ``cells`` where they are known) and the replicates run as ``spark.range(B)`` tasks, each seeded
    from (seed, replicate) so partitioning cannot change a draw."""
    spark = df.sparkSession
    cells = (confusion_cells(df, label_col, pred_col) if cells is None else cells).collect()
    if not cells:
        raise ValueError("labels and predictions must be non-empty")
    classes = sorted({r["label_id"] for r in cells} | {r["pred_id"] for r in cells},
                     key=lambda v: (v is None, v))
    index = {c: i for i, c in enumerate(classes)}
    k = len(classes)
    flat_idx = np.array([index[r["label_id"]] * k + index[r["pred_id"]] for r in cells])
    counts = np.array([r["count"] for r in cells], dtype=np.float64)
    total = int(counts.sum())
    probs = counts / counts.sum()

    def run(batches):
        for b in batches:
            out = np.empty(len(b), dtype=np.float64)
            for i, rep in enumerate(b["id"].to_numpy()):
                rng = np.random.default_rng([seed, int(rep)])
                draw = rng.multinomial(total, probs)
                grid = np.zeros(k * k)
                np.add.at(grid, flat_idx, draw)
                out[i] = _macro_f1_np(grid.reshape(k, k))
            yield pd.DataFrame({"replicate": b["id"].to_numpy(), "macro_f1": out})

    schema = StructType([StructField("replicate", LongType()), StructField("macro_f1", DoubleType())])
    parts = max(1, min(n_resamples // 50, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, n_resamples, numPartitions=parts).mapInPandas(run, schema)


def bootstrap_macro_f1(df: DataFrame, n_resamples: int = config.BOOTSTRAP_RESAMPLES,
                       seed: int = config.SEED, confidence_level: float = config.BOOTSTRAP_CONFIDENCE,
                       label_col: str = "label_id", pred_col: str = "pred_id",
                       cells: DataFrame | None = None) -> DataFrame:
    """Percentile interval (linear interpolation, as numpy.quantile)."""
    if n_resamples <= 0 or not 0 < confidence_level < 1:
        raise ValueError(f"{n_resamples} resamples at confidence {confidence_level} give no interval")
    alpha = (1 - confidence_level) / 2
    cells = confusion_cells(df, label_col, pred_col) if cells is None else cells
    reps = bootstrap_replicates(df, n_resamples, seed, label_col, pred_col, cells)
    est = summary_from_per_class(per_class_from_cells(cells)).select("macro_f1")
    q = reps.agg(F.percentile("macro_f1", F.lit(alpha)).alias("low"),
                 F.percentile("macro_f1", F.lit(1 - alpha)).alias("high"))
    return est.crossJoin(q).select(
        F.col("macro_f1").alias("estimate"), "low", "high",
        F.lit(float(confidence_level)).alias("confidence"),
        F.lit(int(n_resamples)).alias("resamples"))


def poisson_cut_points(max_k: int = 16) -> list[float]:
    """Cumulative Poisson(1) probabilities P(X <= k), k = 0..max_k."""
    out, term, acc = [], np.exp(-1.0), 0.0
    for k in range(max_k + 1):
        if k > 0:
            term = term / k
        acc += term
        out.append(float(acc))
    return out


def poisson_weight(id_col: str, replicate) -> F.Column:
    """Poisson(1) weight of a row in a replicate from md5(id-replicate)."""
    u = F.conv(F.substring(F.md5(F.concat_ws("-", F.col(id_col), replicate.cast("string"))),
                           1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    cuts = poisson_cut_points()
    expr = None
    for k, c in enumerate(cuts):
        expr = F.when(u < F.lit(c), F.lit(k)) if expr is None else expr.when(u < F.lit(c), F.lit(k))
    return expr.otherwise(F.lit(len(cuts)))


def poisson_cells(df: DataFrame, n_resamples: int = config.BOOTSTRAP_RESAMPLES, id_col: str = "id",
                  label_col: str = "label_id", pred_col: str = "pred_id") -> DataFrame:
    """``replicate, label_id, pred_id, count``, written: confusion cells with row-hash Poisson(1)
    weights per replicate, and as the replicate null without weights (``confusion_cells``).

    Each row contributes to every replicate in one pass: rows are dealt evenly, a task hashes
    its ids for all replicates and hands on B x K^2 sums. The tasks are many, as their time lies
    in the hashes and not in the bytes they read."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("string").alias("_id"), F.col(label_col).alias("label_id"),
                     F.col(pred_col).alias("pred_id")).repartition(parts, F.monotonically_increasing_id() % 65536)
    schema = StructType([StructField("replicate", LongType()), rows.schema["label_id"], rows.schema["pred_id"],
                         StructField("w", LongType())])
    return written(rows.mapInArrow(weighted_cells(n_resamples, poisson_cut_points(), plain=True), schema)
                   .groupBy("replicate", "label_id", "pred_id").agg(F.sum("w").alias("count"))
                   .where(F.col("count") > 0), "replicate-cells")  # at most (B + 1) x K^2 rows, read a few times


def plain_cells(weighed: DataFrame) -> DataFrame:
    """The confusion cells among ``poisson_cells``."""
    return weighed.where(F.col("replicate").isNull()).drop("replicate")


def poisson_bootstrap_replicates(df: DataFrame, n_resamples: int = config.BOOTSTRAP_RESAMPLES,
                                 id_col: str = "id", label_col: str = "label_id",
                                 pred_col: str = "pred_id", weighed: DataFrame | None = None) -> DataFrame:
    """Macro-F1 per replicate with row-hash Poisson(1) weights (G5); give ``weighed``
    (``poisson_cells``) where it is known."""
    if weighed is None:
        weighed = poisson_cells(df, n_resamples, id_col, label_col, pred_col)
    return _replicate_macro_f1(weighed.where(F.col("replicate").isNotNull()), plain_cells(weighed))


def _replicate_macro_f1(cells: DataFrame, full: DataFrame) -> DataFrame:
    """``replicate, macro_f1`` from weighted cells. The classes observed in the full data stay in
    every replicate (zero F1 when absent)."""
    observed = full.select(F.col("label_id").alias("class_id")).union(
        full.select(F.col("pred_id").alias("class_id"))).distinct()
    pc = per_class_from_cells(cells, ["replicate"])
    grid = cells.select("replicate").distinct().crossJoin(observed)
    f1 = grid.join(pc.select("replicate", "class_id", "f1"), ["replicate", "class_id"], "left")
    return f1.groupBy("replicate").agg(F.avg(F.coalesce(F.col("f1"), F.lit(0.0))).alias("macro_f1"))


def poisson_bootstrap_macro_f1(df: DataFrame, n_resamples: int = config.BOOTSTRAP_RESAMPLES,
                               confidence_level: float = config.BOOTSTRAP_CONFIDENCE,
                               id_col: str = "id", label_col: str = "label_id",
                               pred_col: str = "pred_id", weighed: DataFrame | None = None) -> DataFrame:
    alpha = (1 - confidence_level) / 2
    if weighed is None:  # the rows are read here and nowhere else
        weighed = poisson_cells(df, n_resamples, id_col, label_col, pred_col)
    reps = poisson_bootstrap_replicates(df, n_resamples, id_col, label_col, pred_col, weighed)
    est = summary_from_per_class(per_class_from_cells(plain_cells(weighed))).select("macro_f1")
    q = reps.agg(F.percentile("macro_f1", F.lit(alpha)).alias("low"),
                 F.percentile("macro_f1", F.lit(1 - alpha)).alias("high"),
                 F.count(F.lit(1)).alias("resamples"))
    return est.crossJoin(q).select(F.col("macro_f1").alias("estimate"), "low", "high",
                                   F.lit(float(confidence_level)).alias("confidence"), "resamples")


def blocked_poisson_bootstrap(df: DataFrame, n_resamples: int = config.BOOTSTRAP_RESAMPLES,
                              confidence_level: float = config.BOOTSTRAP_CONFIDENCE, id_col: str = "id",
                              label_col: str = "label_id", pred_col: str = "pred_id") -> DataFrame:
    """G5 in two levels: rows fall into 256 fixed blocks by the hash of their id, and a replicate
    weighs whole blocks with Poisson(1) draws from md5(block-replicate).

    Rows are read once, for the confusion cells of the blocks (at most 256 K^2, written);
    replicates multiply those. The cost is n + B, where weighing each row costs n * B.
    A null id is a block key like any other."""
    alpha = (1 - confidence_level) / 2
    block = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 2)
    cells = written(df.groupBy(block.alias("block"), F.col(label_col).alias("label_id"), F.col(pred_col).alias("pred_id"))
                    .agg(F.count(F.lit(1)).alias("count")), "block-cells")
    draws = cells.select("block").distinct().withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(n_resamples - 1)))) \
        .withColumn("w", poisson_weight("block", F.col("replicate"))).where("w > 0")
    weighed = cells.join(draws, "block").groupBy("replicate", "label_id", "pred_id") \
        .agg(F.sum(F.col("count") * F.col("w")).cast("long").alias("count"))
    full = cells.groupBy("label_id", "pred_id").agg(F.sum("count").alias("count"))
    reps = _replicate_macro_f1(weighed, full)
    q = reps.agg(F.percentile("macro_f1", F.lit(alpha)).alias("low"),
                 F.percentile("macro_f1", F.lit(1 - alpha)).alias("high"), F.count(F.lit(1)).alias("resamples"))
    est = summary_from_per_class(per_class_from_cells(full)).select("macro_f1")
    return est.crossJoin(q).select(F.col("macro_f1").alias("estimate"), "low", "high",
                                   F.lit(float(confidence_level)).alias("confidence"), "resamples")


def risk_coverage_curve(scored: DataFrame, id_col: str = "id") -> DataFrame:
    """For m = n..1: coverage m/n, risk of the m most confident rows, and the
    m-th confidence (G6). Ties on confidence are ordered by id. Rows whose confidence is
    null or NaN rank last: they count in n and give no point."""
    # dropped after ranking: a filter here would be pushed into the scoring expressions
    base = scored.select(F.col(id_col).alias("id"), "confidence",
                         F.col("correct").cast("long").alias("ok"),
                         (F.col("confidence").isNull() | F.isnan("confidence")).alias("_no_conf"))
    ranked = ordered_positions(base, [F.col("_no_conf"), F.col("confidence").desc(), F.col("id")],
                               sums=["ok"]).where(~F.col("_no_conf"))
    return ranked.select(
        F.col("rank").alias("accepted_count"),
        (F.col("rank") / F.col("group_count")).alias("coverage"),
        (F.lit(1.0) - F.col("cum_ok") / F.col("rank")).alias("risk"),
        F.col("confidence").alias("threshold"),
    )


def compare_models(df: DataFrame, label_col: str = "label_id", pred_a: str = "pred_id",
                   pred_b: str = "pred_b", required_gain: float = config.REQUIRED_GAIN) -> DataFrame:
    """Macro-F1 difference b - a and whether it reaches the required gain."""
    a = classification_metrics(df, label_col, pred_a).select(F.col("macro_f1").alias("macro_f1_a"))
    b = classification_metrics(df, label_col, pred_b).select(F.col("macro_f1").alias("macro_f1_b"))
    j = a.crossJoin(b)
    diff = F.col("macro_f1_b") - F.col("macro_f1_a")
    return j.select("macro_f1_a", "macro_f1_b", diff.alias("improvement"),
                    F.lit(float(required_gain)).alias("required_improvement"),
                    (diff >= F.lit(float(required_gain))).alias("supported"))


def class_level_comparison(df: DataFrame, label_col: str = "label_id", pred_a: str = "pred_id",
                           pred_b: str = "pred_b") -> DataFrame:
    """F1 per class for two models and the difference."""
    a = per_class_metrics(df, label_col, pred_a).select("class_id", F.col("f1").alias("f1_a"),
                                                         "support")
    b = per_class_metrics(df, label_col, pred_b).select("class_id", F.col("f1").alias("f1_b"))
    j = a.join(b, "class_id", "full_outer")
    return j.select("class_id", F.coalesce("f1_a", F.lit(0.0)).alias("f1_a"),
                    F.coalesce("f1_b", F.lit(0.0)).alias("f1_b"),
                    (F.coalesce("f1_b", F.lit(0.0)) - F.coalesce("f1_a", F.lit(0.0))).alias("f1_diff"),
                    F.coalesce("support", F.lit(0).cast("long")).alias("support"))


def dominant_confusions(df: DataFrame, k: int = 4, label_col: str = "label_id",
                        pred_col: str = "pred_id") -> DataFrame:
    """Top-k off-diagonal cells with their share of the true class."""
    cells = confusion_cells(df, label_col, pred_col)
    w = Window.partitionBy("label_id")
    shares = cells.select("label_id", "pred_id", "count",
                          F.sum("count").over(w).alias("support"))
    off = shares.where(F.col("label_id") != F.col("pred_id"))
    return off.orderBy(F.col("count").desc(), "label_id", "pred_id").limit(k).select(
        "label_id", "pred_id", "count", "support",
        (F.col("count") / F.col("support")).alias("share"))
