import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewgate.functions import scores
from reviewgate.functions.labels import class_dimension
from reviewgate.operators import calibrate, metrics, policy, row_weights
from reviewgate.operators.row_weights import weighted_cells

# Published 95 % Wilson bounds of 80/100 and 247/269.
WILSON = {(80, 100): (0.711171, 0.866633), (247, 269): (0.8793, 0.9454)}


def outcomes(spark, table):
    """(label, prediction) rows from counts by cell."""
    rows = [cell for cell, n in table.items() for _ in range(n)]
    return spark.createDataFrame(rows, "label_id INT, pred_id INT")


def macro_f1(table):
    classes = {c for cell in table for c in cell}
    total = 0.0
    for c in classes:
        hit = table.get((c, c), 0)
        wrong = sum(n for (a, b), n in table.items() if (a == c) != (b == c))
        total += 2 * hit / (2 * hit + wrong) if hit else 0.0
    return total / len(classes)


TABLE = {(0, 0): 7, (0, 1): 2, (1, 1): 5, (1, 2): 1, (2, 2): 4, (2, 0): 3}


def test_accuracy_and_macro_f1(spark):
    row = metrics.classification_metrics(outcomes(spark, TABLE)).first()
    assert row.accuracy == pytest.approx(16 / 22) and row.macro_f1 == pytest.approx(macro_f1(TABLE))
    assert metrics.per_class_metrics(outcomes(spark, TABLE)).count() == 3


@pytest.mark.parametrize("counts", list(WILSON))
def test_wilson_bounds(spark, counts):
    low, high = scores.wilson_bounds(F.col("k"), F.col("n"))
    row = spark.createDataFrame([counts], "k BIGINT, n BIGINT").select(low.alias("a"), high.alias("b")).first()
    assert (row.a, row.b) == pytest.approx(WILSON[counts], abs=5e-5)


def test_bootstrap_repeats_and_brackets_the_estimate(spark):
    df = outcomes(spark, TABLE)
    runs = [metrics.bootstrap_macro_f1(df, 200, seed).first() for seed in (5, 5, 6)]
    assert runs[0] == runs[1]
    for r in runs:
        assert 0 <= r.low <= r.estimate <= r.high <= 1 and r.estimate == pytest.approx(macro_f1(TABLE))
    rows = df.withColumn("id", F.monotonically_increasing_id().cast("string"))
    row = metrics.poisson_bootstrap_macro_f1(rows, 100).first()
    assert 0 <= row.low <= row.high <= 1


def test_risk_falls_as_unsure_rows_are_left_out(spark):
    answers = [True, True, False, True, False]
    rows = [(str(i), 1 - i / 10, ok) for i, ok in enumerate(answers)]
    curve = metrics.risk_coverage_curve(spark.createDataFrame(rows, "id STRING, confidence DOUBLE, correct BOOLEAN"))
    got = {round(r.coverage * 5): r.risk for r in curve.collect()}
    assert got == {k: pytest.approx(1 - sum(answers[:k]) / k) for k in range(1, 6)}


def test_rows_without_a_confidence_rank_last(spark):
    nan = float("nan")
    rows = [("a", 0.9, True), ("b", nan, False), ("c", 0.5, False), ("d", None, True)]
    curve = metrics.risk_coverage_curve(spark.createDataFrame(rows, "id STRING, confidence DOUBLE, correct BOOLEAN"))
    got = sorted((r.accepted_count, r.coverage, r.risk, r.threshold) for r in curve.collect())
    assert got == [(1, 0.25, 0.0, 0.9), (2, 0.5, 0.5, 0.5)]


def test_blocked_bootstrap_lies_near_the_row_bootstrap(spark):
    df = spark.range(6000).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("int").alias("label_id"),
        F.when(F.xxhash64("id") % 5 == 0, (F.col("id") + 1) % 3).otherwise(F.col("id") % 3).cast("int").alias("pred_id"))
    rows, blocks = metrics.bootstrap_macro_f1(df, 400).first(), metrics.blocked_poisson_bootstrap(df, 400).first()
    assert blocks.estimate == pytest.approx(rows.estimate) and blocks.low < blocks.estimate < blocks.high
    width = rows.high - rows.low
    assert abs(blocks.low - rows.low) < 0.35 * width and abs(blocks.high - rows.high) < 0.35 * width
    plan = metrics.blocked_poisson_bootstrap(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan  # the rows were read before, for the cells
    assert metrics.blocked_poisson_bootstrap(df.limit(0), 10).first().estimate is None


def test_row_weights_equal_the_column_function(spark):
    """Ids of all lengths, beyond one MD5 block, null and repeated: the same weights as md5(id-replicate) in Spark."""
    ids = [None, None, "", *("é" * (i % 3) + "x" * i for i in range(70)), "a", "a"]
    rows = [(x, i % 3 if i % 11 else None, i % 2) for i, x in enumerate(ids)]
    df = spark.createDataFrame(rows, "id STRING, label_id INT, pred_id INT")
    b = 12
    slow = df.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(b - 1)))) \
        .withColumn("w", metrics.poisson_weight("id", F.col("replicate"))) \
        .groupBy("replicate", "label_id", "pred_id").agg(F.sum("w").alias("n")).where("n > 0")
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=["_id", "label_id", "pred_id"])
    got = {tuple(r.values()) for x in weighted_cells(b, metrics.poisson_cut_points())(iter([batch.slice(0, 9), batch.slice(9)]))
           for r in x.to_pylist() if r["w"]}
    assert got == {tuple(r) for r in slow.collect()}
    plan = metrics.poisson_bootstrap_replicates(df, b)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(sequence" not in plan  # no row for each row and replicate


def test_no_softmax_in_filters(spark):
    """Tests of grouping keys stay above the aggregates."""
    rows = [([2.0, 0.0, 1.0], 0), ([0.0, 3.0, 1.0], 2), ([1.0, 1.0, 1.5], 1), ([5.0, 1.0, 0.0], None)]
    s = policy.with_scores(spark.createDataFrame(rows, "logits ARRAY<DOUBLE>, label_id INT"), 0.9)
    dim = class_dimension(spark, ("a", "b", "c"))
    for out in (metrics.confusion_matrix(s, dim), calibrate.reliability_table(s, 10)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in plan.split("\n") if "Filter" in x and "zip_with" in x]
    cells = {(r.label_id, r.pred_id): r["count"] for r in metrics.confusion_matrix(s, dim).collect()}
    assert len(cells) == 9 and {k: v for k, v in cells.items() if v} == {(0, 0): 1, (2, 1): 1, (1, 2): 1}
    table = calibrate.reliability_table(s, 10).collect()
    assert sum(r["count"] for r in table) == 4 and len({r.bin for r in table}) == len(table)


def test_rows_are_read_once_for_all_weights(spark):
    """Estimate, observed classes and replicates come from one pass over the rows: its cells, with
    and without weights, equal plain aggregates, also for null ids, labels and predictions."""
    df = spark.range(300).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") % 290).cast("string")).alias("id"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 3).cast("int").alias("label_id"),
        F.when(F.col("id") % 13 != 0, F.col("id") % 4).cast("int").alias("pred_id"))
    b = 7
    weighed = metrics.poisson_cells(df, b)
    slow = df.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(b - 1)))) \
        .withColumn("w", metrics.poisson_weight("id", F.col("replicate"))) \
        .groupBy("replicate", "label_id", "pred_id").agg(F.sum("w").alias("n")).where("n > 0")
    got = {tuple(r) for r in weighed.where("replicate IS NOT NULL").collect()}
    assert got == {tuple(r) for r in slow.collect()}
    plain = {tuple(r) for r in metrics.plain_cells(weighed).collect()}
    assert plain == {tuple(r) for r in metrics.confusion_cells(df).collect()}
    out = metrics.poisson_bootstrap_macro_f1(df, b)
    assert "Range" not in out._jdf.queryExecution().executedPlan().toString()  # as read above, for the cells
    assert out.first().estimate == pytest.approx(metrics.classification_metrics(df).first().macro_f1)
    again = metrics.bootstrap_macro_f1(df, 40, cells=metrics.plain_cells(weighed)).first()
    assert again.estimate == pytest.approx(out.first().estimate)


@pytest.mark.parametrize("size", [0, 3, 8, 31, 32, 50, 54, 60])
def test_first_words_against_hashlib(size):
    import hashlib
    ids = [(hashlib.sha512(str(i).encode()).hexdigest())[:size].encode() for i in range(9)]
    ends = [b"-%d" % i for i in range(1200)]
    seen, used = 0, 0
    for some, words in row_weights.first_words(ids, ends):
        for end, row in zip(ends[seen:seen + some], words):
            assert row.tolist() == [int.from_bytes(hashlib.md5(x + end).digest()[:4], "big") for x in ids]
        seen, used = seen + some, used + 1
    assert seen == len(ends) and (used < 20 or size > 50)  # many replicates in one array operation


def test_rows_wait_for_their_cell_over_batches(monkeypatch):
    ids = [f"id{i * i}" if i % 9 else None for i in range(400)]
    labels, preds = [i % 3 for i in range(400)], [i % 2 for i in range(400)]
    whole = pa.record_batch([pa.array(ids), pa.array(labels), pa.array(preds)], names=["_id", "label_id", "pred_id"])
    found = []
    for cells, held, step in ((65536, 10**6, 400), (16, 10**6, 50), (40, 60, 30)):
        monkeypatch.setattr(row_weights, "_CELLS", cells)
        monkeypatch.setattr(row_weights, "_HELD", held)
        out = weighted_cells(20, metrics.poisson_cut_points(), plain=True)(iter([whole.slice(i, step) for i in range(0, 400, step)]))
        found.append({tuple(r.values()) for x in out for r in x.to_pylist()})
    assert found[0] == found[1] == found[2] and len(found[0]) == 6 * 21
    assert sum(w for r, _, _, w in found[0] if r is None) == 400
