"""Scoring columns, threshold curve, threshold choice, routing."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StructField,
                               StructType)

from .. import config
from ..functions import scores
from ..functions.labels import decode_label
from .prefix import ordered_positions

POLICY_SCHEMA = StructType([
    StructField("threshold", DoubleType(), False),
    StructField("accepted_count", LongType(), False),
    StructField("coverage", DoubleType(), False),
    StructField("accepted_accuracy", DoubleType(), True),
    StructField("target_met", BooleanType(), False),
])


def with_scores(df: DataFrame, temperature=1.0, logits_col: str = "logits",
                label_col: str | None = "label_id", n_classes: int | None = None) -> DataFrame:
    """probs = softmax(logits / T), confidence, pred_id and correct, computed once.

    The softmax is staged in two projections so the shifted exponentials are
    evaluated once per row (Catalyst keeps a projection whose non-trivial
    output is used twice). ``n_classes`` unrolls it into scalar expressions; these are
    inlined wherever the confidence is used, so it is for plans that use it a few times (the
    15 bins of a calibration error grew beyond the 64 KB that generated code may have)."""
    if n_classes:
        out = df.withColumn("probs", scores.softmax_fixed(F.col(logits_col), n_classes, temperature))
    else:
        out = df.withColumn("_e", scores.exp_shifted(scores.scale(F.col(logits_col), temperature)))
        out = out.withColumn("probs", scores.normalise(F.col("_e"))).drop("_e")
    out = out.withColumn("confidence", scores.confidence(F.col("probs"))) \
             .withColumn("pred_id", scores.arg_max(F.col("probs")))
    if label_col is not None:
        out = out.withColumn("correct", F.coalesce(F.col("pred_id") == F.col(label_col),
                                                   F.lit(False)))
    return out


def threshold_curve(scored: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """For each distinct confidence t: rows with confidence >= t, their correct
    count, coverage and accuracy (F6), optionally per group (one policy per
    model or segment).

    Rows collapse to distinct confidences first (map-side combine); the
    descending prefix sums come from the distributed range-prefix helper."""
    g = list(group_cols)
    # Rows without a usable confidence rank last, so they count in the totals
    # (the denominator of apply_policy) and are never accepted. The test is an
    # aggregate output: a predicate on the grouping key would be pushed below
    # the scoring projection and inline the softmax into the filter.
    per_value = scored.groupBy(*g, "confidence").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("correct").cast("long")).alias("k"),
        F.max(F.col("confidence").isNull() | F.isnan("confidence")).alias("_no_conf"))
    ranked = ordered_positions(per_value, [F.col("_no_conf"), F.col("confidence").desc()], g,
                               sums=["n", "k"]).where(~F.col("_no_conf"))
    return ranked.select(
        *g,
        F.col("confidence").alias("threshold"),
        F.col("cum_n").alias("accepted_count"),
        F.col("cum_k").alias("correct_count"),
        (F.col("cum_n") / F.col("total_n")).alias("coverage"),
        (F.col("cum_k") / F.col("cum_n")).alias("accepted_accuracy"),
        F.col("total_n").alias("total_count"),
    )


def select_threshold(curve: DataFrame, target_accuracy: float = config.TARGET_ACCURACY,
                     min_coverage: float = 0.0, group_cols: list[str] = ()) -> DataFrame:
    """Largest coverage whose accepted accuracy meets the target.

    Accuracy is not monotone in the threshold, so every point is checked.
    When none qualifies the policy fails closed: threshold 1.0, nothing
    accepted, null accuracy, target_met false. One row out (per group)."""
    if not 0 <= target_accuracy <= 1 or not 0 <= min_coverage <= 1:
        raise ValueError(f"target accuracy {target_accuracy} and coverage {min_coverage} are shares from 0 to 1")
    g = list(group_cols)
    required = F.ceil(F.lit(float(min_coverage)) * F.col("total_count"))
    qualifies = ((F.col("accepted_count") >= required) & (F.col("accepted_count") > 0)
                 & (F.col("accepted_accuracy") + F.lit(config.TARGET_SLACK)
                    >= F.lit(float(target_accuracy))))
    cand = F.when(qualifies, F.struct("threshold", "accepted_count", "coverage",
                                      "accepted_accuracy"))
    # max_by ignores rows whose value is null only when the ordering is null,
    # so order non-candidates below every candidate.
    order = F.when(qualifies, F.struct(F.lit(1).alias("q"), F.col("accepted_count").alias("n"),
                                       (-F.col("threshold")).alias("t"))) \
        .otherwise(F.struct(F.lit(0).alias("q"), F.lit(0).cast("long").alias("n"),
                            F.lit(0.0).alias("t")))
    best = curve.groupBy(*g).agg(F.max_by(cand, order).alias("b")) if g \
        else curve.agg(F.max_by(cand, order).alias("b"))
    return best.select(
        *g,
        F.coalesce(F.col("b.threshold"), F.lit(1.0)).alias("threshold"),
        F.coalesce(F.col("b.accepted_count"), F.lit(0).cast("long")).alias("accepted_count"),
        F.coalesce(F.col("b.coverage"), F.lit(0.0)).alias("coverage"),
        F.col("b.accepted_accuracy").alias("accepted_accuracy"),
        F.col("b").isNotNull().alias("target_met"),
    )


def select_confidence_threshold(scored: DataFrame,
                                target_accuracy: float = config.TARGET_ACCURACY,
                                min_coverage: float = 0.0, group_cols: list[str] = ()) -> DataFrame:
    return select_threshold(threshold_curve(scored, group_cols), target_accuracy, min_coverage,
                            group_cols)


def policy_frame(spark: SparkSession, threshold: float, target_met: bool) -> DataFrame:
    return spark.createDataFrame([(float(threshold), 0, 0.0, None, bool(target_met))],
                                 POLICY_SCHEMA)


def _one_policy(policy: DataFrame) -> DataFrame:
    """``_t, _met`` in exactly one row: null where there is no policy, so joining
    it never loses a row; more than one policy is an error."""
    one = policy.agg(F.max("threshold").alias("_t"), F.max("target_met").alias("_met"),
                     F.count(F.lit(1)).alias("_n"))
    return one.select("_t", F.when(F.col("_n") > 1, F.raise_error(F.lit("more than one policy row")).cast("boolean"))
                      .otherwise(F.col("_met")).alias("_met"))


def frozen_policy(policy: DataFrame) -> DataFrame:
    """The policy as a row that plans carry themselves: computed once, not by each micro-batch
    of a stream. No policy stays none, and more than one is the error of ``_one_policy``."""
    row = _one_policy(policy).first()
    kept = [] if row["_t"] is None and row["_met"] is None else [(row["_t"], row["_met"])]
    return policy.sparkSession.createDataFrame(kept, "threshold DOUBLE, target_met BOOLEAN")


def apply_policy(scored: DataFrame, policy: DataFrame, confidence_level: float = 0.95) -> DataFrame:
    """Held-out outcome of a frozen policy (F8): accepted count, coverage,
    accuracy and its Wilson interval; the null block when the target was not
    met or nothing is accepted. One row out; the policy is one row."""
    j = scored.crossJoin(F.broadcast(_one_policy(policy)))
    acc = F.coalesce((F.col("confidence") >= F.col("_t")) & ~F.isnan("confidence"), F.lit(False))
    agg = j.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(acc).alias("acc_n"),
        F.count_if(acc & F.col("correct")).alias("acc_k"),
        F.max("_met").alias("met"),
    )
    live = F.coalesce(F.col("met"), F.lit(False)) & (F.col("acc_n") > 0)
    low, high = scores.wilson_bounds(F.col("acc_k"), F.col("acc_n"), confidence_level)
    return agg.select(
        F.when(live, F.col("acc_n")).otherwise(F.lit(0).cast("long")).alias("accepted_count"),
        F.when(live, F.col("acc_n") / F.col("n")).otherwise(F.lit(0.0)).alias("coverage"),
        F.when(live, F.col("acc_k") / F.col("acc_n")).alias("accepted_accuracy"),
        F.when(live, low).alias("wilson_low"),
        F.when(live, high).alias("wilson_high"),
        F.col("n").alias("evaluated_count"),
    )


#: Columns of the input that a routing decision carries: names and outcomes, no content.
CARRIED = ("id", "doc_id", "model", "split", "label_id", "pred_id", "pred_b", "confidence", "correct",
           "input_status")


def _carried(df: DataFrame, keep) -> list[str]:
    return [c for c in df.columns if c in CARRIED or c in tuple(keep)]


def route(scored: DataFrame, policy: DataFrame, labels, k: int = config.TOP_K,
          route_action: str = config.ROUTE_ACTION, keep: list[str] = ()) -> DataFrame:
    """Per-row routing decision (B13). The policy row is broadcast; a missing
    policy, an unmet target, and scores that are missing, not finite or not one
    for each label all end in human review. Of the input it carries the columns
    ``CARRIED`` and those named in ``keep``, so no text leaves by another name."""
    j = scored.crossJoin(F.broadcast(_one_policy(policy).withColumnRenamed("_t", "review_threshold")))
    met = F.coalesce(F.col("_met"), F.lit(False))
    usable = F.coalesce(~F.isnan("confidence") & F.col("confidence").between(0.0, 1.0)
                        & (F.size("probs") == len(list(labels))), F.lit(False))
    meets = met & usable & F.coalesce(F.col("confidence") >= F.col("review_threshold"), F.lit(False))
    action = F.when(meets, F.lit(route_action)).otherwise(F.lit(config.REVIEW_ACTION))
    reason = (F.when(meets, F.lit(config.REASON_MEETS))
              .when(met & ~usable, F.lit(config.REASON_BAD_SCORES))
              .when(~met, F.lit(config.REASON_FAILS_CLOSED))
              .otherwise(F.lit(config.REASON_BELOW)))
    return j.select(
        *_carried(scored, keep),
        decode_label(F.col("pred_id"), labels).alias("predicted_label"),
        action.alias("recommended_action"),
        reason.alias("review_reason"),
        "review_threshold",
        scores.top_k(F.col("probs"), k, labels).alias("top_predictions"),
    )


def route_models(rows: DataFrame, registry: DataFrame, k: int = config.TOP_K,
                 route_action: str = config.ROUTE_ACTION, keep: list[str] = ()) -> DataFrame:
    """Routing of rows of many models, each by its own temperature, policy and labels.

    ``rows``: ``model, logits`` and what is carried; ``registry``: see
    ``sources.model_registry``. The join fails closed: every row comes out, and a row
    whose model is unknown or not usable, or whose scores are missing, not finite or not
    one for each label, has no prediction and goes to human review. Rows of one model may
    be any share of the table: the registry is the small side, one row a model."""
    names = {"usable": "_usable", "temperature": "_t", "threshold": "review_threshold", "target_met": "_met",
             "labels": "_labels"}
    side = registry.select(F.col("model").alias("_model"), *[F.col(a).alias(b) for a, b in names.items()])
    j = rows.join(side, F.col("model") == F.col("_model"), "left")
    usable = F.coalesce(F.col("_usable"), F.lit(False))
    shaped = usable & F.coalesce(F.size("logits") == F.size("_labels"), F.lit(False))
    j = j.withColumn("_e", F.when(shaped, scores.exp_shifted(scores.scale(F.col("logits"), F.col("_t")))))
    j = j.withColumn("_p", scores.normalise(F.col("_e")))
    j = j.withColumns({"_c": scores.confidence(F.col("_p")), "_i": scores.arg_max(F.col("_p"))})
    sound = shaped & F.coalesce(~F.isnan("_c") & F.col("_c").between(0.0, 1.0)
                                & ~F.exists("_p", lambda x: x.isNull() | F.isnan(x)), F.lit(False))
    met = usable & F.coalesce(F.col("_met"), F.lit(False))
    meets = met & sound & F.coalesce(F.col("_c") >= F.col("review_threshold"), F.lit(False))
    reason = (F.when(meets, F.lit(config.REASON_MEETS))
              .when(~usable, F.lit(config.REASON_BAD_MODEL))
              .when(~met, F.lit(config.REASON_FAILS_CLOSED))
              .when(~sound, F.lit(config.REASON_BAD_SCORES))
              .otherwise(F.lit(config.REASON_BELOW)))
    kept = [c for c in _carried(rows, keep) if c not in ("confidence", "pred_id")]
    top = scores.top_k(F.col("_p"), k)
    return j.select(
        *kept, F.when(sound, F.col("_c")).alias("confidence"), F.when(sound, F.col("_i")).alias("pred_id"),
        F.when(sound, F.get(F.col("_labels"), F.col("_i"))).alias("predicted_label"),
        F.when(meets, F.lit(route_action)).otherwise(F.lit(config.REVIEW_ACTION)).alias("recommended_action"),
        reason.alias("review_reason"), F.when(usable, F.col("review_threshold")).alias("review_threshold"),
        F.when(sound, F.transform(top, lambda x: F.struct(
            x["class_id"].alias("class_id"), F.get(F.col("_labels"), x["class_id"]).alias("label"),
            x["probability"].alias("probability")))).alias("top_predictions"))


def present_routes(routed: DataFrame, id_col: str = "id") -> DataFrame:
    """Display strings of a routed row (B14): percentages with one decimal,
    route headline and detail. ``id_col`` names the row (``doc_id`` for texts)."""
    def pct(c: Column) -> Column:
        return F.format_string("%.1f%%", c * F.lit(100.0))
    review = F.col("recommended_action") == F.lit(config.REVIEW_ACTION)
    headline = F.when(review, F.lit(config.ROUTE_HEADLINE_REVIEW)) \
        .otherwise(F.lit(config.ROUTE_HEADLINE_ROUTE))
    tail = F.when(review, F.lit(config.ROUTE_DETAIL_REVIEW)) \
        .otherwise(F.lit(config.ROUTE_DETAIL_ROUTE))
    detail = F.concat(F.col("review_reason"), F.lit(" Threshold: "),
                      pct(F.col("review_threshold")), F.lit(". "), tail)
    top = F.transform(F.col("top_predictions"),
                      lambda s: F.concat(s["label"], F.lit(": "), pct(s["probability"])))
    return routed.select(
        id_col, "predicted_label",
        pct(F.col("confidence")).alias("confidence_text"),
        headline.alias("route"),
        detail.alias("route_detail"),
        F.array_join(top, "; ").alias("top_text"),
    )


def deferral_summary(routed: DataFrame, route_action: str = config.ROUTE_ACTION) -> DataFrame:
    """Accepted / deferred counts and shares per predicted class and in total."""
    accepted = F.col("recommended_action") == F.lit(route_action)
    agg = routed.rollup("predicted_label").agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(accepted).alias("accepted_count"),
        F.count_if(~accepted).alias("deferred_count"),
        F.grouping("predicted_label").alias("_total_row"),
    )
    return agg.select(
        F.when(F.col("_total_row") == 1, F.lit("__all__"))
        .otherwise(F.col("predicted_label")).alias("predicted_label"),
        "total_count", "accepted_count", "deferred_count",
        (F.col("accepted_count") / F.col("total_count")).alias("accepted_share"),
        (F.col("deferred_count") / F.col("total_count")).alias("deferred_share"),
    )
