"""Experiment report: one nested row assembled from the operators (A10).

The test rows are read once for the joint confusion cells of both models
(label x prediction x prediction, at most K^3 rows): every metric, interval
and confusion of the report comes from those. Calibration figures and the
policy come from the operators over the scored rows. Lists in the report are
bounded by the classes, the bins or the curve points; it holds no text and no
ids. ``report_json`` serialises it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import calibrate, metrics, policy
from ..sources import fixtures as fx

CURVE_POINTS = 20


def _one(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.struct(*df.columns).alias(name))


def _many(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """All rows of a bounded table as one sorted list."""
    fields = order + [c for c in df.columns if c not in order]
    return df.agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def curve_points(curve: DataFrame, points: int = CURVE_POINTS) -> DataFrame:
    """The risk of a threshold curve at evenly spaced coverages: in each step of
    1 / ``points`` the point of largest coverage."""
    step = F.ceil(F.col("coverage") * points).cast("int")
    best = F.max_by(F.struct("threshold", "coverage", "accepted_accuracy"), "accepted_count")
    return curve.groupBy(step.alias("step")).agg(best.alias("b")).select(
        "step", "b.threshold", "b.coverage", (F.lit(1.0) - F.col("b.accepted_accuracy")).alias("risk"))


def report_of(scored: DataFrame, temperature: float,
              target: float = config.TARGET_ACCURACY) -> DataFrame:
    """The report of rows scored at ``temperature`` (columns of the scored-lines
    fixture and of ``policy.with_scores``; ``split`` is calibration or test)."""
    cal = scored.where(F.col("split") == "calibration")
    test = scored.where(F.col("split") == "test")
    joint = test.groupBy("label_id", "pred_id", "pred_b").agg(
        F.count(F.lit(1)).alias("count")).checkpoint(eager=True)  # at most K^3 rows
    cells, classes = {}, {}
    for model, column in (("model", "pred_id"), ("baseline", "pred_b")):
        cells[model] = joint.groupBy("label_id", F.col(column).alias("pred_id")).agg(
            F.sum("count").alias("count"))
        classes[model] = metrics.per_class_from_cells(cells[model])
    summary = {m: metrics.summary_from_per_class(c) for m, c in classes.items()}
    gain = (F.col("b.macro_f1") - F.col("a.macro_f1")).alias("improvement")
    hypothesis = summary["model"].alias("a").crossJoin(summary["baseline"].alias("b")).select(
        F.col("a.macro_f1").alias("macro_f1_a"), F.col("b.macro_f1").alias("macro_f1_b"), gain,
        F.lit(config.REQUIRED_GAIN).alias("required_improvement"),
        (F.col("b.macro_f1") - F.col("a.macro_f1") >= F.lit(config.REQUIRED_GAIN)).alias("supported"))
    chosen = policy.select_confidence_threshold(cal, target)
    confused = cells["model"].where(F.col("label_id") != F.col("pred_id")) \
        .orderBy(F.col("count").desc(), "label_id", "pred_id").limit(4)
    parts = [
        scored.groupBy().agg(F.struct(*[
            F.count_if(F.col("split") == name).alias(name) for name in ("calibration", "test")])
            .alias("sample_counts")),
        _one(hypothesis, "primary_hypothesis"),
        _many(calibrate.calibration_before_after(cal, temperature), "calibration", ["stage"]),
        _many(calibrate.calibration_before_after(test, temperature), "calibration_test", ["stage"]),
        _many(calibrate.reliability_table(test), "reliability", ["bin"]),
        _one(chosen, "review_policy_calibration"),
        _one(policy.apply_policy(test, chosen), "review_policy_test"),
        _many(curve_points(policy.threshold_curve(test)), "risk_coverage", ["step"]),
        _many(confused, "dominant_confusions", ["label_id", "pred_id"]),
    ]
    for model in ("model", "baseline"):
        interval = metrics.bootstrap_macro_f1(test, cells=cells[model])
        parts += [_one(summary[model], model),
                  _many(classes[model], f"{model}_classes", ["class_id"]),
                  _one(interval, f"{model}_macro_f1_interval")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # every part is a single row
    return out.select(F.lit(2).alias("schema_version"), F.lit(float(temperature)).alias("temperature"), "*")


def experiment_report(spark: SparkSession, sf_dir: str, temperature: float | None = None,
                      target: float = config.TARGET_ACCURACY) -> DataFrame:
    """Fits the temperature on the calibration rows unless one is given."""
    lines = fx.scored_lines(spark, sf_dir)
    t = temperature if temperature is not None else calibrate.fit_temperature(
        lines.where(F.col("split") == "calibration"))
    return report_of(policy.with_scores(lines, t), t, target)


def report_json(report: DataFrame) -> DataFrame:
    return report.select(F.to_json(F.struct(*report.columns)).alias("report"))
