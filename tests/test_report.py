import json

from reviewgate.plans.report import curve_points, experiment_report, report_json

SF = "/root/testdata/sf0.001"


def test_report_json_holds_every_part(spark):
    got = json.loads(report_json(experiment_report(spark, SF, temperature=0.9)).first().report)
    assert {"sample_counts", "primary_hypothesis", "model", "baseline", "model_classes", "baseline_classes",
            "model_macro_f1_interval", "baseline_macro_f1_interval", "calibration", "calibration_test",
            "reliability", "risk_coverage", "dominant_confusions", "review_policy_calibration",
            "review_policy_test"} <= set(got)
    assert [c["class_id"] for c in got["model_classes"]] == [0, 1, 2]
    assert got["model"]["n"] == got["sample_counts"]["test"] == sum(c["support"] for c in got["model_classes"])
    assert [s["stage"] for s in got["calibration"]] == ["after", "before"]
    low, high = (got["model_macro_f1_interval"][k] for k in ("low", "high"))
    assert low <= got["model"]["macro_f1"] <= high
    assert len(got["risk_coverage"]) <= 20


def test_curve_points_keep_the_widest_of_each_step(spark):
    curve = spark.createDataFrame(
        [(0.9, 1, 0.1, 1.0), (0.8, 4, 0.4, 0.75), (0.7, 5, 0.5, 0.8), (0.1, 10, 1.0, 0.6)],
        "threshold DOUBLE, accepted_count LONG, coverage DOUBLE, accepted_accuracy DOUBLE")
    got = [(r.step, r.threshold, round(r.risk, 9)) for r in curve_points(curve, 2).orderBy("step").collect()]
    assert got == [(1, 0.7, 0.2), (2, 0.1, 0.4)]
