import math

from pyspark.sql import functions as F

from reviewgate.functions import scores
from reviewgate.operators import calibrate, policy


def _scored(spark, rows):
    df = spark.createDataFrame(rows, "probs ARRAY<DOUBLE>, label_id INT")
    return df.select("label_id", "probs", scores.confidence(F.col("probs")).alias("confidence"),
                     scores.arg_max(F.col("probs")).alias("pred_id")) \
        .withColumn("correct", F.col("pred_id") == F.col("label_id"))


def test_softmax_rows_sum_to_one(spark):
    df = spark.createDataFrame([([2.0, 1.0],), ([0.0, 0.0],)], "z ARRAY<DOUBLE>")
    sums = [sum(r["p"]) for r in df.select(scores.softmax(F.col("z")).alias("p")).collect()]
    assert all(abs(s - 1.0) < 1e-12 for s in sums)


def test_temperature_fit_reduces_nll_and_finds_optimum(spark):
    df = spark.createDataFrame([([8.0, 0.0], 0), ([8.0, 0.0], 1), ([0.0, 8.0], 1), ([8.0, 0.0], 0)],
                               "logits ARRAY<DOUBLE>, label_id INT")
    t = calibrate.fit_temperature(df)
    assert 0.05 <= t <= 10.0
    assert abs(t - 8 / math.log(3)) < 1e-4
    ba = {r["stage"]: r["nll"] for r in calibrate.calibration_before_after(df, t).collect()}
    assert ba["after"] < ba["before"]


def test_policy_and_ece(spark):
    s = _scored(spark, [([0.95, 0.05], 0), ([0.90, 0.10], 0), ([0.40, 0.60], 0), ([0.45, 0.55], 1)])
    ece = calibrate.expected_calibration_error(s, 4).first()["ece"]
    assert 0.0 <= ece <= 1.0
    p = policy.select_confidence_threshold(s, 0.9).first()
    assert p["target_met"] is True and p["threshold"] == 0.9
    assert p["accepted_count"] == 2 and p["coverage"] == 0.5 and p["accepted_accuracy"] == 1.0


def test_policy_fails_closed(spark):
    s = _scored(spark, [([0.9, 0.1], 1), ([0.8, 0.2], 1)])
    p = policy.select_confidence_threshold(s, 1.0).first()
    assert p["target_met"] is False and p["accepted_count"] == 0 and p["coverage"] == 0.0
    assert p["threshold"] == 1.0 and p["accepted_accuracy"] is None


def test_bin_edges_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.30000000000000004,), (1.0,), (1.5,)], "c DOUBLE")
    got = [r["b"] for r in df.select(scores.bin_index(F.col("c"), 10).alias("b")).collect()]
    edges = scores.linspace_edges(10)
    assert got[0] == 0 and got[3] == 9 and got[4] is None
    assert got[1] == (2 if 0.3 <= edges[3] else 3)


def test_nll_rejects_out_of_range_labels(spark):
    s = _scored(spark, [([0.9, 0.1], 0), ([0.9, 0.1], 5)])
    r = calibrate.negative_log_likelihood(s).first()
    assert r["bad_label_count"] == 1 and abs(r["nll"] + math.log(0.9)) < 1e-12
