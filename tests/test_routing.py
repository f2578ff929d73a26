import pytest
import math

from pyspark.sql import functions as F

from reviewgate import config
from reviewgate.operators import policy
from reviewgate.sources import validate

LABELS = ("Credit card", "Mortgage", "Debt collection")


def _routes(spark, threshold, met):
    df = spark.createDataFrame([("r1", [2.0, 1.0, 0.0])], "id STRING, logits ARRAY<DOUBLE>")
    s = policy.with_scores(df, 2.0, label_col=None)
    return policy.route(s, policy.policy_frame(spark, threshold, met), LABELS).first()


def test_route_three_ways(spark):
    e = [math.exp(x - 1.0) for x in (1.0, 0.5, 0.0)]
    expected = e[0] / sum(e)
    r = _routes(spark, 0.5, True)
    assert abs(r["confidence"] - expected) < 1e-9
    assert r["predicted_label"] == "Credit card" and len(r["top_predictions"]) == 3
    assert r["recommended_action"] == config.ROUTE_ACTION
    assert "text" not in r.asDict()
    below = _routes(spark, 0.99, True)
    assert below["recommended_action"] == config.REVIEW_ACTION and "below" in below["review_reason"]
    closed = _routes(spark, 0.0, False)
    assert closed["recommended_action"] == config.REVIEW_ACTION and "fails closed" in closed["review_reason"]


def test_null_confidence_fails_closed(spark):
    df = spark.createDataFrame([("r1", None)], "id STRING, logits ARRAY<DOUBLE>")
    s = policy.with_scores(df, 1.0, label_col=None)
    r = policy.route(s, policy.policy_frame(spark, 0.0, True), LABELS).first()
    assert r["recommended_action"] == config.REVIEW_ACTION


def test_policy_artifacts(spark):
    rows = [("a", "temperature", '{"temperature": 1.5}'),
            ("a", "review_policy", '{"threshold": 0.8, "target_met": true}'),
            ("b", "temperature", '{"temperature": NaN}'),
            ("b", "review_policy", '{"threshold": 1.1, "target_met": true}'),
            ("c", "review_policy", '{"threshold": 0.5, "target_met": "yes"}'),
            ("d", "temperature", '{"temperature": true}'),
            ("e", "temperature", '[1]')]
    out = validate.validate_policies(spark.createDataFrame(rows, "model STRING, kind STRING, payload STRING")).collect()
    assert [r["valid"] for r in out] == [True, True, False, False, False, False, False]
    assert out[2]["violations"] == [validate.MSG_TEMP_RANGE]
    assert out[3]["violations"] == [validate.MSG_THRESHOLD_RANGE]
    assert out[4]["violations"] == [validate.MSG_FLAG]
    assert out[5]["violations"] == [validate.MSG_TEMP_NUMERIC]


def test_label_map(spark):
    rows = [("ok", "0", "Credit card"), ("ok", "1", "Mortgage"), ("ok", "2", "Debt collection"),
            ("bad", "1", "A"), ("bad", "2", "B"), ("bad", "3", "C")]
    out = {r["model"]: r for r in validate.validate_label_map(
        spark.createDataFrame(rows, "model STRING, key STRING, label STRING")).collect()}
    assert out["ok"]["valid"] and not out["bad"]["valid"]


def test_score_shape(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1.0, 2.0],), ([1.0, float("nan"), 0.0],), (None,)],
                               "logits ARRAY<DOUBLE>")
    got = [r["score_status"] for r in validate.validate_score_shape(df, 3).collect()]
    assert got == ["ok", "wrong_class_count", "non_finite_scores", "missing_scores"]


def test_bad_scores_and_missing_policy_go_to_review(spark):
    from pyspark.sql import functions as F

    from reviewgate import config
    from reviewgate.operators import policy as pol
    nan, inf = float("nan"), float("inf")
    rows = [("ok", [9.0, 0.0, 0.0]), ("nan", [nan, 1.0, 0.0]), ("inf", [inf, 1.0, 0.0]), ("short", [9.0, 0.0]),
            ("null", None), ("hole", [9.0, None, 0.0])]
    scored = pol.with_scores(spark.createDataFrame(rows, "id STRING, logits ARRAY<DOUBLE>"), label_col=None)
    one = spark.createDataFrame([(0.9, True)], "threshold DOUBLE, target_met BOOLEAN")
    got = {r.id: (r.recommended_action, r.review_reason) for r in pol.route(scored, one, ["a", "b", "c"]).collect()}
    assert got.pop("ok") == (config.ROUTE_ACTION, config.REASON_MEETS)
    assert set(got.values()) == {(config.REVIEW_ACTION, config.REASON_BAD_SCORES)} and len(got) == 5
    none = pol.route(scored, one.where(F.lit(False)), ["a", "b", "c"]).collect()
    assert len(none) == 6 and {r.recommended_action for r in none} == {config.REVIEW_ACTION}
    with pytest.raises(Exception, match="more than one policy"):
        pol.route(scored, one.unionAll(one), ["a", "b", "c"]).collect()


def test_curve_counts_rows_without_a_confidence_but_never_accepts_them(spark):
    df = spark.createDataFrame([(0.9, True), (0.8, False), (float("nan"), True), (None, True)],
                               "confidence DOUBLE, correct BOOLEAN")
    got = sorted((r.threshold, r.accepted_count, r.correct_count, r.total_count)
                 for r in policy.threshold_curve(df).collect())
    assert got == [(0.8, 2, 1, 4), (0.9, 1, 1, 4)]


def test_presented_rows_keep_the_named_id(spark):
    df = spark.createDataFrame([(7, [2.0, 1.0, 0.0])], "doc_id LONG, logits ARRAY<DOUBLE>")
    routed = policy.route(policy.with_scores(df, label_col=None),
                          policy.policy_frame(spark, 0.1, True), LABELS)
    assert policy.present_routes(routed, id_col="doc_id").first().doc_id == 7


def test_payloads_that_only_look_valid(spark):
    """JSON decides, not patterns: trailing text, repeated keys, nesting, strings, NaN tokens."""
    t, p = "temperature", "review_policy"
    cases = [
        (p, '{"threshold": 0.8, "target_met": true}x}', [validate.MSG_OBJECT]),
        (p, '{"threshold": 0.8, "target_met": true}], [1', [validate.MSG_OBJECT]),
        (p, '{"threshold": 0.8, "target_met": true} {}', [validate.MSG_OBJECT]),
        (t, '{"temperature": 1.5, "temperature": true}', [validate.MSG_TEMP_NUMERIC]),
        (t, '{"temperature": true, "temperature": 1.5}', []),
        (t, '{"inner": {"temperature": 1.5}}', [validate.MSG_TEMP_NUMERIC]),
        (t, '{"note": "\\"temperature\\": 2", "temperature": "2"}', [validate.MSG_TEMP_NUMERIC]),
        (t, '{"note": "NaN, or -Infinity", "temperature": 2}', []),
        (t, '{"temperature": Infinity}', [validate.MSG_TEMP_RANGE]),
        (t, '{"temperature": -Infinity}', [validate.MSG_TEMP_RANGE]),
        (t, '{"temperature": null}', [validate.MSG_TEMP_NUMERIC]),
        (t, '{"temperature": 10}', []), (t, '{"temperature": 10.000001}', [validate.MSG_TEMP_RANGE]),
        (t, '{"temperature": 01}', [validate.MSG_OBJECT]), (t, '{"temperature": 1.5,}', [validate.MSG_OBJECT]),
        (t, '{"temperature: 1.5}', [validate.MSG_OBJECT]), (t, "", [validate.MSG_OBJECT]), (t, None, [validate.MSG_OBJECT]),
        (p, '{"target_met": true}', [validate.MSG_THRESHOLD_NUMERIC]),
        (p, '{"threshold": 1e0, "target_met": 1}', [validate.MSG_FLAG]),
        (p, '{"threshold": "0.5"}', [validate.MSG_THRESHOLD_NUMERIC, validate.MSG_FLAG]),
        ("other", '{"threshold": 0.5}', [validate.MSG_KIND])]
    rows = [(i, kind, payload) for i, (kind, payload, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i INT, kind STRING, payload STRING")
    got = {r.i: r.violations for r in validate.validate_policies(df).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") == "false"
    values = {r.i: (r.temperature, r.target_met) for r in validate.policy_values(df).collect()}
    assert values[4] == (1.5, None) and values[19][1] is None and values[0] == (None, None)


def test_label_map_branches(spark):
    rows = [("tab", "0", "a\t"), ("tab", "1", "a"), ("tab", "2", "b"),
            ("nbsp", "0", "\u00a0"), ("nbsp", "1", "a"), ("nbsp", "2", "b"),
            ("null", "0", None), ("null", "1", "a"), ("null", "2", "b"),
            ("word", "x", "a"), ("word", "1", "b"), ("word", "2", "c"),
            ("twice", "0", "a"), ("twice", "00", "b"), ("twice", "2", "c"),
            ("two", "0", "a"), ("two", "1", "b")]
    got = {r.model: r.violations for r in validate.validate_label_map(
        spark.createDataFrame(rows, "model STRING, key STRING, label STRING")).collect()}
    assert got == {"tab": [validate.MSG_UNIQUE], "nbsp": [validate.MSG_BLANK], "null": [validate.MSG_BLANK],
                   "word": [validate.MSG_KEYS], "twice": [validate.MSG_CONTIGUOUS], "two": [validate.MSG_CLASSES]}


def test_vectors_that_cannot_be_scored_go_to_review(spark):
    from reviewgate.operators import scoring
    rows = [("a", [1.0, 0.0]), ("b", None), ("c", [1.0]), ("d", [None, 1.0]), ("e", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id STRING, v ARRAY<DOUBLE>")
    centres = spark.createDataFrame([(k, j, float(k == j)) for k in range(3) for j in range(2)],
                                    "label INT, pos INT, mean DOUBLE")
    scored = scoring.score_batch(df, scoring.centroid_scorer(centres, [0, 1, 2]), "v")
    got = {r.id: r.logits for r in scored.collect()}
    assert got == {"a": [20.0, 0.0, 0.0], "b": None, "c": None, "d": None, "e": [0.0, 20.0, 0.0]}
    routed = policy.route(policy.with_scores(scored, label_col=None), policy.policy_frame(spark, 0.5, True), LABELS)
    assert {r.id for r in routed.collect() if r.recommended_action == config.REVIEW_ACTION} == {"b", "c", "d"}
    free = scoring.score_batch(df, lambda: lambda x: x[:, :1], "v")  # a scorer that takes any length
    assert {r.id: r.logits for r in free.collect()} == {"a": [1.0], "b": None, "c": [1.0], "d": None, "e": [0.0]}
    assert scoring.score_batch(df.limit(0), lambda: lambda x: x, "v").collect() == []


def test_stream_freezes_its_policy(spark, tmp_path):
    """No micro-batch chooses the policy again, and its decisions are those of the batch."""
    from reviewgate.streaming import route_stream as rs
    data = [(str(i), i % 3, [float(i % 7), 1.0, 0.5]) for i in range(40)] + [("none", 0, None)]
    rows = spark.createDataFrame(data, "id STRING, label_id INT, logits ARRAY<DOUBLE>")
    src, curve = str(tmp_path / "src"), str(tmp_path / "curve")
    rows.repartition(3).write.parquet(src)
    policy.with_scores(rows, 2.0).select("confidence", "correct").write.parquet(curve)
    chosen = policy.select_confidence_threshold(spark.read.parquet(curve), 0.3)
    plan = rs.route_stream(rows, chosen, LABELS, 2.0)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Window" not in plan
    for p in (chosen, chosen.limit(0), policy.policy_frame(spark, 0.5, False)):
        sink = str(tmp_path / f"sink-{id(p)}")
        rs.run_to_parquet(rs.route_stream(rs.read_stream(spark, src, rows.schema, 1), p, LABELS, 2.0), sink, sink + "-c")
        want = policy.route(policy.with_scores(rows, 2.0), p, LABELS)
        assert sorted(map(str, spark.read.parquet(sink).collect())) == sorted(map(str, want.collect()))
    two = chosen.unionByName(chosen)
    with pytest.raises(Exception, match="more than one policy row"):
        rs.route_stream(rows, two, LABELS, 2.0).collect()
