import json

import pytest

from reviewgate import config
from reviewgate.operators import policy
from reviewgate.sources import model_registry as mr
from reviewgate.sources import validate
from reviewgate.streaming import route_stream as rs

NAMES = ["red", "green", "blue"]


def artifacts(spark, rows):
    return spark.createDataFrame([(m, k, json.dumps(p) if not isinstance(p, str) else p) for m, k, p in rows],
                                 "model STRING, kind STRING, payload STRING")


def maps(spark, **labels):
    rows = [(m, str(i), x) for m, names in labels.items() for i, x in enumerate(names)]
    return spark.createDataFrame(rows, "model STRING, key STRING, label STRING")


def both(model, threshold=0.5, met=True, temperature=2.0):
    return [(model, "temperature", {"temperature": temperature}),
            (model, "review_policy", {"threshold": threshold, "target_met": met})]


@pytest.fixture(scope="module")
def registry(spark):
    rows = both("ok") + both("high", 0.99) + both("unmet", 0.0, False) + both("seven", 7.0) + both("nomap") + both("own") \
        + both("short") + [("half", "temperature", {"temperature": 1})] + both("twice") + both("twice") \
        + both("five", 0.3, True, 1.0) + [(None, "temperature", "{}")]
    labels = maps(spark, ok=NAMES, high=NAMES, unmet=NAMES, seven=NAMES, own=NAMES, short=NAMES, half=NAMES, twice=NAMES,
                  five=["a\t", " b", "c", "d", "e"], maponly=NAMES)
    own = spark.createDataFrame([("ok", NAMES), ("own", ["red", "blue", "green"]), ("short", ["red", "green"])],
                                "model STRING, own_labels ARRAY<STRING>")
    return mr.model_registry(artifacts(spark, rows), labels, own).cache()


def test_every_model_with_its_violations(registry):
    got = {r.model: r for r in registry.collect()}
    missing = [mr.MSG_MISSING.format(kind=k) for k in mr.KINDS]
    assert {m: r.violations for m, r in got.items() if r.violations} == {
        "seven": [validate.MSG_THRESHOLD_RANGE], "nomap": [mr.MSG_NO_MAP], "own": [mr.MSG_OWN_LABELS],
        "short": [mr.MSG_OUTPUTS], "half": missing[1:], "maponly": missing,
        "twice": [mr.MSG_REPEATED.format(kind=k) for k in mr.KINDS]}
    assert all(r.usable == (not r.violations) for r in got.values())
    assert got["five"].labels == ["a", "b", "c", "d", "e"] and None not in got


def rows(spark):
    nan = float("nan")
    data = [(f"{m}-{i}", m, z, "private words") for m in ("ok", "high", "unmet", "seven", "nomap", "own", "unknown", None)
            for i, z in enumerate([[9.0, 0.0, 0.0], [0.1, 0.0, 0.0], [nan, 1.0, 0.0], [9.0, 0.0], None, [9.0, None, 0.0]])]
    data.append(("five", "five", [0.0, 0.0, 0.0, 5.0, 0.0], "private words"))
    return spark.createDataFrame(data, "id STRING, model STRING, logits ARRAY<DOUBLE>, narrative STRING")


def decisions(routed):
    return {r.id: (r.recommended_action == config.ROUTE_ACTION, r.review_reason, r.predicted_label) for r in routed.collect()}


def test_rows_of_many_models_fail_closed(spark, registry):
    df = rows(spark)
    routed = policy.route_models(df, registry)
    got = decisions(routed)
    assert len(got) == df.count() and "narrative" not in routed.columns and "logits" not in routed.columns
    assert {i for i, (accepted, _, _) in got.items() if accepted} == {"ok-0", "five"}
    assert got["ok-0"] == (True, config.REASON_MEETS, "red") and got["five"][2] == "d"
    assert got["ok-1"] == (False, config.REASON_BELOW, "red") and got["high-0"][1] == config.REASON_BELOW
    assert got["unmet-0"] == (False, config.REASON_FAILS_CLOSED, "red")
    assert {got[f"ok-{i}"] for i in range(2, 6)} == {(False, config.REASON_BAD_SCORES, None)}
    for m in ("seven", "nomap", "own", "unknown", "None"):
        assert {got[f"{m}-{i}"] for i in range(6)} == {(False, config.REASON_BAD_MODEL, None)}
    assert policy.route_models(df, registry.limit(0)).where("recommended_action <> 'human_review'").isEmpty()
    assert "narrative" in policy.route_models(df, registry, keep=["narrative"]).columns


def test_one_model_equals_the_single_route(spark, registry):
    df = rows(spark).where("model = 'ok'")
    single = policy.route(policy.with_scores(df, 2.0, label_col=None), policy.policy_frame(spark, 0.5, True), NAMES)
    many = policy.route_models(df, registry)
    assert {i: v[0] for i, v in decisions(single).items()} == {i: v[0] for i, v in decisions(many).items()}
    assert "narrative" not in single.columns


def test_stream_equals_batch_and_a_replay_adds_nothing(spark, registry, tmp_path):
    df = rows(spark).where("id <> 'None-0'")
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    df.repartition(3).write.parquet(src)
    stream = rs.route_models_stream(rs.read_stream(spark, src, df.schema, 1), registry)
    rs.run_to_batches(stream, sink, str(tmp_path / "ckpt"))
    want = decisions(policy.route_models(df, registry))
    out = spark.read.parquet(sink)
    assert decisions(out) == want and out.count() == len(want)
    assert out.select("batch_id").distinct().count() == 3
    again = spark.createDataFrame(out.where("batch_id = 1").drop("batch_id").collect(), out.drop("batch_id").schema)
    rs.write_batch(again, 1, sink)  # the batch is replayed after a failure
    assert spark.read.parquet(sink).count() == len(want)
    rs.run_to_batches(stream, sink, str(tmp_path / "other"))  # all of it, from a lost checkpoint
    assert spark.read.parquet(sink).count() == len(want)


def test_no_micro_batch_plans_the_registry(spark, registry):
    plan = rs.route_models_stream(rows(spark), registry)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "InMemoryTableScan" not in plan and "FileScan" not in plan
    with pytest.raises(ValueError, match="more than 2 models"):
        mr.frozen_registry(registry, max_models=2)
