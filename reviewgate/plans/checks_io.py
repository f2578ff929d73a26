"""Registered checks of sources/sinks, artifact validation, streaming and
the end-to-end plans."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import config
from ..operators import policy
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import io, validate
from ..sources.model_registry import MSG_OUTPUTS, MSG_OWN_LABELS, model_registry
from ..streaming import route_stream as rs
from . import sql_fixtures as sq
from .checks_prepare import NAR, PREPARED_SQL, prepared
from .registry import SQL, T, _cal, _scored, _test, register, rounded, r

SPLIT_COLS = ["complaint_id", "date_received", "issue", "label", "narrative_hash", "text"]


@register("read_narratives_csv", NAR + " SELECT complaint_id, date_received, issue, label, text FROM nar")
def q_read_csv(spark, sf_dir):
    path = scratch_path(spark, "export-csv")
    io.write_export_csv(fx.narratives(spark, sf_dir), path)
    return io.read_narratives_csv(spark, path)


@register("read_export_blocks", NAR + " SELECT complaint_id, date_received, issue, label, text FROM nar")
def q_read_export_blocks(spark, sf_dir):
    """Blocks of 1 MB, so that files of ordinary size are read by many tasks."""
    path = scratch_path(spark, "export-csv")
    io.write_export_csv(fx.narratives(spark, sf_dir), path)
    return io.read_narratives_csv(spark, path, block_bytes=1 << 20)


@register("read_split_jsonl", NAR + " SELECT complaint_id, date_received, issue, label, text FROM nar")
def q_read_jsonl(spark, sf_dir):
    path = scratch_path(spark, "records-jsonl")
    io.write_jsonl(fx.narratives(spark, sf_dir), path)
    return io.read_jsonl(spark, path)


@register("write_splits", PREPARED_SQL
          + " SELECT complaint_id, date_received, issue, label, narrative_hash, split, text FROM splits")
def q_write_splits(spark, sf_dir):
    path = scratch_path(spark, "splits")
    io.write_jsonl(prepared(spark, sf_dir).select(*SPLIT_COLS, "split"), path, partition_by="split")
    schema = StructType(list(io.RECORD_SCHEMA.fields) + [
        StructField("narrative_hash", StringType()), StructField("split", StringType())])
    return io.read_jsonl(spark, path, schema).select(*SPLIT_COLS, "split")


_ROWSTR = ("concat_ws(chr(31), coalesce(complaint_id, ''), coalesce(strftime(date_received, '%Y-%m-%d'), ''), "
           "coalesce(issue, ''), coalesce(label, ''), coalesce(narrative_hash, ''), coalesce(text, ''))")


_DIGESTS = PREPARED_SQL + f""", rows AS (SELECT split, sha256({_ROWSTR}) AS d FROM splits),
  cnt AS (SELECT split, d, count(*) AS c FROM rows GROUP BY 1, 2),
  leaf AS (SELECT split, substr(d, 1, 4) AS p, sha256(string_agg(d || ':' || CAST(c AS VARCHAR), ',' ORDER BY d)) AS h
    FROM cnt GROUP BY 1, 2),
  l3 AS (SELECT split, substr(p, 1, 3) AS p, sha256(string_agg(p || '=' || h, ',' ORDER BY p)) AS h FROM leaf GROUP BY 1, 2),
  l2 AS (SELECT split, substr(p, 1, 2) AS p, sha256(string_agg(p || '=' || h, ',' ORDER BY p)) AS h FROM l3 GROUP BY 1, 2),
  l1 AS (SELECT split, substr(p, 1, 1) AS p, sha256(string_agg(p || '=' || h, ',' ORDER BY p)) AS h FROM l2 GROUP BY 1, 2),
  l0 AS (SELECT split, sha256(string_agg(p || '=' || h, ',' ORDER BY p)) AS h FROM l1 GROUP BY 1)"""


@register("content_fingerprint", _DIGESTS + """
  SELECT l0.split, h AS content_digest, n.count FROM l0 JOIN (SELECT split, count(*) AS count FROM splits GROUP BY 1) n
    ON l0.split = n.split""")
def q_fingerprint(spark, sf_dir):
    return io.content_fingerprint(prepared(spark, sf_dir).select(*SPLIT_COLS, "split"), SPLIT_COLS)


@register("preparation_manifest", _DIGESTS + """,
  st AS (SELECT (SELECT count(*) FROM nar) AS input_count, count(*) FILTER (WHERE mn = mx) AS output_count,
    CAST(coalesce(sum(n - 1) FILTER (WHERE mn = mx), 0) AS BIGINT) AS duplicate_count,
    CAST(coalesce(sum(n) FILTER (WHERE mn <> mx), 0) AS BIGINT) AS conflict_count,
    (SELECT count(*) FROM nar) - CAST(coalesce(sum(n), 0) AS BIGINT) AS dropped_count FROM grp),
  src AS (SELECT coalesce(label, '-') AS label, count(*) AS n FROM nar GROUP BY 1),
  sl AS (SELECT split, string_agg(label || '=' || n, ',' ORDER BY label) AS labels, sum(n) AS n
    FROM (SELECT split, label, count(*) AS n FROM splits GROUP BY 1, 2) GROUP BY 1)
  SELECT st.*, (SELECT string_agg(label || '=' || n, ',' ORDER BY label) FROM src) AS source_counts,
    (SELECT string_agg(split || ':' || sl.n || ':' || l0.h || ':' || labels, ' ' ORDER BY split)
     FROM l0 JOIN sl USING (split)) AS splits FROM st""")
def q_preparation_manifest(spark, sf_dir):
    """The manifest of the whole table, its lists written out as text."""
    m = io.split_manifest(fx.narratives(spark, sf_dir),
                          prepared(spark, sf_dir).select(*SPLIT_COLS, "split"), SPLIT_COLS)

    def counts(column):
        return F.array_join(F.transform(column, lambda e: F.concat(
            F.coalesce(e["label"], F.lit("-")), F.lit("="), e["count"].cast("string"))), ",")
    return m.select("deduplication.*", counts(F.col("source_counts")).alias("source_counts"), F.array_join(
        F.transform("splits", lambda e: F.concat_ws(
            ":", e["split"], e["count"].cast("string"), e["content_digest"], counts(e["labels"]))), " ").alias("splits"))


def _model_policies(spark, sf_dir):
    """One policy per model: the first hex digit of the row id names the model."""
    s = _cal(_scored(spark, sf_dir)).withColumn("model", F.concat(F.lit("m"), F.substring("id", 1, 1)))
    return policy.select_confidence_threshold(s, group_cols=["model"])


_MODEL_CURVE = f"""WITH sl AS ({sq.SCORED_LINES}), sc AS ({sq.scored(T)}),
  pv AS (SELECT 'm' || substr(id, 1, 1) AS model, confidence, count(*) AS n, sum(CAST(correct AS INTEGER)) AS k
    FROM sc WHERE split = 'calibration' GROUP BY 1, 2),
  cv AS (SELECT model, confidence AS threshold,
      sum(n) OVER (PARTITION BY model ORDER BY confidence DESC ROWS UNBOUNDED PRECEDING) AS an,
      sum(k) OVER (PARTITION BY model ORDER BY confidence DESC ROWS UNBOUNDED PRECEDING) AS ak FROM pv),
  best AS (SELECT model, threshold FROM cv WHERE CAST(ak AS DOUBLE) / an + 1e-12::DOUBLE >= {sq.dbl(config.TARGET_ACCURACY)}
    QUALIFY row_number() OVER (PARTITION BY model ORDER BY an DESC, threshold) = 1),
  models AS (SELECT DISTINCT model FROM pv),
  pol AS (SELECT models.model, coalesce(best.threshold, 1.0::DOUBLE) AS threshold FROM models LEFT JOIN best USING (model))"""


@register("validate_policies", _MODEL_CURVE + f""" SELECT model, 'review_policy' AS kind, {r('threshold', 'value')},
    true AS valid, 0 AS violation_count FROM pol
  UNION ALL SELECT model, 'temperature', {sq.dbl(T)}, true, 0 FROM models""")
def q_validate_policies(spark, sf_dir):
    pol = _model_policies(spark, sf_dir)
    payloads = pol.select("model", F.lit("review_policy").alias("kind"),
                          F.to_json(F.struct("threshold", "target_met")).alias("payload")).unionByName(
        pol.select("model", F.lit("temperature").alias("kind"),
                   F.to_json(F.struct(F.lit(float(T)).alias("temperature"))).alias("payload")))
    checked = validate.validate_policies(payloads)
    value = F.coalesce(F.get_json_object("payload", "$.threshold"),
                       F.get_json_object("payload", "$.temperature")).cast("double")
    return rounded(checked.select("model", "kind", value.alias("value"), "valid",
                                  F.size("violations").alias("violation_count")))


def _MODEL_POLICY_SQL() -> str:
    from .registry import _POLICY_CTE
    return _POLICY_CTE.lstrip().removeprefix("WITH")


def _label_maps(spark, sf_dir):
    """(model, key, label) label maps derived from categorical columns of the tables."""
    from pyspark.sql import Window
    srcs = [("lang", fx.table(spark, sf_dir, "documents").select(F.col("lang").alias("label"))),
            ("source", fx.table(spark, sf_dir, "documents").select(F.col("source").alias("label"))),
            ("priority", fx.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("label"))),
            ("returnflag", fx.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"))),
            ("linestatus", fx.table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("label")))]
    out = None
    for model, df in srcs:
        d = df.distinct().select(F.lit(model).alias("model"), "label")
        out = d if out is None else out.unionByName(d)
    # distinct values per model are few: the window runs over a small table
    w = Window.partitionBy("model").orderBy("label")
    return out.select("model", (F.dense_rank().over(w) - 1).cast("string").alias("key"), "label")


_LM_SQL = """WITH lm AS (
    SELECT 'lang' AS model, lang AS label FROM documents UNION SELECT 'source', source FROM documents
    UNION SELECT 'priority', o_orderpriority FROM orders UNION SELECT 'returnflag', l_returnflag FROM lineitem
    UNION SELECT 'linestatus', l_linestatus FROM lineitem),
  g AS (SELECT model, count(*) AS n FROM lm GROUP BY 1)
  SELECT model, n AS class_count, CASE WHEN n < 3 THEN 'At least three classes are required for top-three scores.' ELSE '' END AS violation_text,
    n >= 3 AS valid FROM g"""


@register("validate_label_map", _LM_SQL)
def q_validate_label_map(spark, sf_dir):
    v = validate.validate_label_map(_label_maps(spark, sf_dir))
    return v.select("model", "class_count", F.array_join("violations", " | ").alias("violation_text"),
                    "valid")


@register("validate_score_shape", f"""WITH sl AS ({sq.SCORED_LINES}),
  s AS (SELECT 'scored_lines' AS source, CASE WHEN logits IS NULL THEN 'missing_scores' WHEN len(logits) <> 3 THEN 'wrong_class_count'
      WHEN NOT list_bool_and(list_transform(logits, lambda x: x IS NOT NULL AND isfinite(x))) THEN 'non_finite_scores' ELSE 'ok' END AS score_status FROM sl
    UNION ALL
    SELECT 'embeddings', CASE WHEN embedding IS NULL THEN 'missing_scores' WHEN len(embedding) <> 64 THEN 'wrong_class_count'
      WHEN NOT list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) THEN 'non_finite_scores' ELSE 'ok' END FROM embeddings)
  SELECT source, score_status, count(*) AS rows FROM s GROUP BY 1, 2""")
def q_validate_score_shape(spark, sf_dir):
    a = validate.validate_score_shape(fx.scored_lines(spark, sf_dir), 3) \
        .select(F.lit("scored_lines").alias("source"), "score_status")
    b = validate.validate_score_shape(
        fx.scored_vecs(spark, sf_dir).select(F.col("embedding").cast("array<double>").alias("logits")), 64) \
        .select(F.lit("embeddings").alias("source"), "score_status")
    return a.unionByName(b).groupBy("source", "score_status").agg(F.count(F.lit(1)).alias("rows"))


@register("route_stream")
def q_route_stream(spark, sf_dir):
    lines = fx.scored_lines(spark, sf_dir)
    chosen = policy.select_confidence_threshold(_cal(_scored(spark, sf_dir)))
    src, rows = scratch_path(spark, "stream-src"), _test(lines)
    files = rows.rdd.getNumPartitions()  # grows with the table; still four micro-batches
    (rows if files >= 4 else rows.repartition(4)).write.mode("overwrite").parquet(src)
    stream = rs.read_stream(spark, src, rows.schema, max_files_per_trigger=math.ceil(max(files, 4) / 4))
    routed = rs.route_stream(stream, chosen, fx.RETURN_FLAG_NAMES, T, confidence_digits=12)
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    rs.run_to_parquet(routed, sink, ckpt)
    return rounded(spark.read.parquet(sink).drop("top_predictions"))


SQL["route_stream"] = SQL["route_reviews"]


#: Models of the gated routing check, by the first hex digit of the row id.
_MODEL_OF = {"good": "0-5", "broken": "6-8", "relabelled": "9-a", "unmapped": "b-c", "absent": "d-f"}


def _model_rows(spark, sf_dir):
    """Test lines dealt to five models, and the artifacts of four of them. ``good`` has the fitted
    policy; ``broken`` seven times its threshold (out of range); ``relabelled`` another label
    list of its own; ``unmapped`` one label too few; ``absent`` nothing at all."""
    lines = fx.scored_lines(spark, sf_dir)
    chosen = policy.select_confidence_threshold(_cal(_scored(spark, sf_dir)))
    digit, model = F.substring("id", 1, 1), None
    for name, digits in _MODEL_OF.items():
        hit = digit.rlike(f"[{digits}]")
        model = F.when(hit, name) if model is None else model.when(hit, name)
    named = [m for m in _MODEL_OF if m != "absent"]
    each = chosen.crossJoin(spark.createDataFrame([(m,) for m in named], "model STRING"))  # one row each
    times = F.when(F.col("model") == "broken", 7.0).otherwise(1.0)
    artifacts = each.select("model", F.lit("review_policy").alias("kind"), F.to_json(F.struct(
        (F.col("threshold") * times).alias("threshold"), "target_met")).alias("payload")).unionByName(
        each.select("model", F.lit("temperature").alias("kind"), F.lit(f'{{"temperature": {float(T)}}}').alias("payload")))
    maps = [(m, str(i), f" {x} ") for m in named for i, x in enumerate(fx.RETURN_FLAG_NAMES) if (m, i) != ("unmapped", 2)]
    own = [(m, list(fx.RETURN_FLAG_NAMES if m != "relabelled" else reversed(fx.RETURN_FLAG_NAMES))) for m in named]
    registry = model_registry(artifacts, spark.createDataFrame(maps, "model STRING, key STRING, label STRING"),
                              spark.createDataFrame(own, "model STRING, own_labels ARRAY<STRING>"))
    return _test(lines).withColumn("model", model), registry


def _routed_models_sql() -> str:
    from .registry import _ROUTE_SQL
    model = "CASE " + " ".join(f"WHEN regexp_matches(substr(id, 1, 1), '[{d}]') THEN '{m}'" for m, d in _MODEL_OF.items()) + " END"
    good = "model = 'good'"
    return _ROUTE_SQL + f""", rm AS (SELECT *, {model} AS model FROM routed)
  SELECT id, model, label_id, split, pred_b, CASE WHEN {good} THEN predicted_label END AS predicted_label,
    {r(f"CASE WHEN {good} THEN confidence END", "confidence")},
    CASE WHEN {good} AND meets THEN '{config.ROUTE_ACTION}' ELSE '{config.REVIEW_ACTION}' END AS recommended_action,
    CASE WHEN NOT ({good}) THEN 'bad model' WHEN meets THEN 'meets' WHEN NOT met THEN 'closed' ELSE 'below' END AS reason
  FROM rm"""


def _model_routes(routed):
    reason = F.col("review_reason")
    named = {config.REASON_BAD_MODEL: "bad model", config.REASON_MEETS: "meets", config.REASON_FAILS_CLOSED: "closed",
             config.REASON_BELOW: "below"}
    short = None
    for text, name in named.items():
        short = F.when(reason == text, name) if short is None else short.when(reason == text, name)
    return rounded(routed.select("id", "model", "label_id", "split", "pred_b", "predicted_label", "confidence",
                                 "recommended_action", short.alias("reason")))


@register("route_models", _routed_models_sql())
def q_route_models(spark, sf_dir):
    rows, registry = _model_rows(spark, sf_dir)
    return _model_routes(_quantised(policy.route_models(rows, _loose(registry))))


@register("route_models_stream")
def q_route_models_stream(spark, sf_dir):
    rows, registry = _model_rows(spark, sf_dir)
    src, sink, ckpt = (scratch_path(spark, f"models-{n}") for n in ("src", "sink", "ckpt"))
    files = max(3, rows.rdd.getNumPartitions())  # grows with the table; still three micro-batches
    rows.repartition(files).write.parquet(src)
    stream = rs.read_stream(spark, src, rows.schema, max_files_per_trigger=math.ceil(files / 3))
    rs.run_to_batches(rs.route_models_stream(stream, _loose(registry)), sink, ckpt)
    return _model_routes(_quantised(spark.read.parquet(sink)))


SQL["route_models_stream"] = SQL["route_models"]


def _loose(registry):
    """Thresholds of these checks were chosen on confidences of 12 digits; a 13th decides here."""
    return registry.withColumn("threshold", F.col("threshold") - F.lit(5e-13))


def _quantised(routed):
    return routed.withColumn("confidence", F.round("confidence", 12))


@register("model_registry", """WITH m AS (SELECT * FROM (VALUES ('good', 3, 1), ('broken', 3, 7), ('relabelled', 3, 1), ('unmapped', 2, 1)) v(model, n, times)),
  """ + _MODEL_POLICY_SQL() + f"""
  SELECT model, n AS class_count, {r("threshold * times", "threshold")}, {r(sq.dbl(T), "temperature")}, target_met,
    model = 'good' OR (model = 'broken' AND threshold * times <= 1) AS usable,
    concat_ws(' | ', CASE WHEN threshold * times > 1 THEN '{validate.MSG_THRESHOLD_RANGE}' END,
      CASE WHEN n < 3 THEN '{validate.MSG_CLASSES}' END, CASE WHEN n < 3 THEN '{MSG_OUTPUTS}' END,
      CASE WHEN model = 'relabelled' THEN '{MSG_OWN_LABELS}' END) AS violation_text FROM m CROSS JOIN pol""")
def q_model_registry(spark, sf_dir):
    _, registry = _model_rows(spark, sf_dir)
    return rounded(registry.select("model", F.size("labels").alias("class_count"), "threshold", "temperature", "target_met",
                                   "usable", F.array_join("violations", " | ").alias("violation_text")))


#: Temperature of the text-routing check: spreads the share model's confidences.
_TEXT_T = 0.2
_LABELS = "[" + ", ".join(f"'{lab}'" for lab in fx.LANG_CLASSES) + "]"


def _route_batch_sql() -> str:
    from .checks_features import SHARE_MARGINS_SQL
    status = f"""CASE WHEN text IS NULL THEN 'not_text' WHEN length({sq.collapse('text')}) < {config.MIN_INPUT_CHARS} THEN 'too_short'
         WHEN length({sq.collapse('text')}) > {config.MAX_INPUT_CHARS} THEN 'too_long' ELSE 'ok' END"""
    t = sq.dbl(_TEXT_T)
    return SHARE_MARGINS_SQL + f""",
  pr AS (SELECT doc_id, split, text, pred_id, coalesce(pred_id = label_id, false) AS correct,
      1.0 / list_sum(list_transform(logits, lambda z: exp((z - top) / {t}))) AS confidence FROM mg),
  cv AS (SELECT confidence AS threshold, sum(n) OVER w AS accepted, sum(good) OVER w AS right_
    FROM (SELECT confidence, count(*) AS n, count(*) FILTER (WHERE correct) AS good FROM pr
          WHERE split = 'calibration' GROUP BY 1)
    WINDOW w AS (ORDER BY confidence DESC ROWS UNBOUNDED PRECEDING)),
  pol AS (SELECT threshold FROM cv WHERE right_ / CAST(accepted AS DOUBLE) + 1e-12::DOUBLE >= {sq.dbl(config.TARGET_ACCURACY)}
    ORDER BY accepted DESC, threshold LIMIT 1),
  st AS (SELECT *, {status} AS input_status FROM pr WHERE split = 'test')
  SELECT doc_id, input_status,
    CASE WHEN input_status = 'ok' THEN {_LABELS}[pred_id + 1] END AS predicted_label,
    CASE WHEN input_status = 'ok' AND coalesce(confidence >= (SELECT threshold FROM pol), false)
         THEN '{config.ROUTE_ACTION}' ELSE '{config.REVIEW_ACTION}' END AS recommended_action
  FROM st"""


@register("route_batch", _route_batch_sql())
def q_route_batch(spark, sf_dir):
    from ..operators import linear
    from ..operators.features import ARRAYS
    from .checks_features import share_model
    from .routing import route_texts
    docs, model, weights, inter = share_model(spark, sf_dir)
    cal = docs.where(F.col("split") == "calibration")
    cal_logits = linear.ovr_margins(model.transform(cal, form=ARRAYS), cal, weights, inter) \
        .join(cal.select("doc_id", "label_id"), "doc_id")
    chosen = policy.select_confidence_threshold(policy.with_scores(cal_logits, _TEXT_T))
    test = docs.where(F.col("split") == "test").select("doc_id", "text")
    out = route_texts(test, model, weights, inter, _TEXT_T, chosen, fx.LANG_CLASSES)
    return out.select("doc_id", "input_status", "predicted_label", "recommended_action")


def _report_sql() -> str:
    """The report's scalars and its class lists, flattened, at a fixed temperature."""
    from .registry import _POLICY_CTE, _W
    nll = ("avg(-ln(greatest(least(CASE label_id WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 END, "
           "1.0::DOUBLE), 1e-12::DOUBLE)))")

    def rates(pred: str) -> str:
        return f"""SELECT class_id, CASE WHEN s + p > 0 THEN 2.0 * t / (s + p) ELSE 0.0 END AS f1, s, t
          FROM (SELECT class_id, count(*) FILTER (WHERE label_id = class_id) AS s,
                  count(*) FILTER (WHERE {pred} = class_id) AS p,
                  count(*) FILTER (WHERE label_id = class_id AND {pred} = class_id) AS t
                FROM sc CROSS JOIN (VALUES (0), (1), (2)) v(class_id) WHERE split = 'test' GROUP BY 1)"""
    bins = f"""SELECT sum(n * abs(acc - conf)) / sum(n) AS ece FROM (
        SELECT count(*) AS n, avg(CAST(correct AS DOUBLE)) AS acc, avg(confidence) AS conf FROM sc
        WHERE split = 'calibration' GROUP BY {sq.bin_case('confidence', 15)})"""
    return _POLICY_CTE + f""", ra AS ({rates('pred_id')}), rb AS ({rates('pred_b')}),
    ap AS (SELECT count(*) AS n, count(*) FILTER (WHERE confidence >= pol.threshold) AS acc_n,
        count(*) FILTER (WHERE confidence >= pol.threshold AND correct) AS acc_k
      FROM sc CROSS JOIN pol WHERE split = 'test' AND target_met)
  SELECT (SELECT count(*) FROM sc WHERE split = 'calibration') AS calibration_n,
    (SELECT count(*) FROM sc WHERE split = 'test') AS test_n,
    {r('(SELECT sum(t) / CAST(sum(s) AS DOUBLE) FROM ra)', 'accuracy')},
    {r('(SELECT avg(f1) FROM ra)', 'macro_f1')},
    {r('(SELECT sum(f1 * s) / sum(s) FROM ra)', 'weighted_f1')},
    {r('(SELECT avg(f1) FROM rb)', 'baseline_macro_f1')},
    {r('(SELECT avg(f1) FROM rb) - (SELECT avg(f1) FROM ra)', 'improvement')},
    {r(f"(SELECT {nll} FROM sc WHERE split = 'calibration')", 'calibration_nll')},
    {r(f"(SELECT {nll} FROM sc WHERE split = 'test')", 'test_nll')},
    round(({bins}), 6) AS calibration_ece,
    {r('pol.threshold', 'threshold')}, pol.accepted_count, pol.target_met,
    CASE WHEN pol.target_met THEN (SELECT acc_n FROM ap) ELSE 0 END AS test_accepted,
    {r(f'(SELECT {_W[0]} FROM ap WHERE acc_n > 0)', 'test_wilson_low')},
    (SELECT string_agg(printf('%d:%.6f', class_id, f1), ' ' ORDER BY class_id) FROM ra) AS class_f1,
    true AS interval_encloses FROM pol"""


@register("experiment_report", _report_sql())
def q_report(spark, sf_dir):
    from .report import report_of
    rep = report_of(_scored(spark, sf_dir), T)
    after = "filter({}, x -> x.stage = 'after')[0]"
    return rounded(rep.select(
        F.col("sample_counts.calibration").alias("calibration_n"), F.col("sample_counts.test").alias("test_n"),
        "model.accuracy", "model.macro_f1", "model.weighted_f1",
        F.col("baseline.macro_f1").alias("baseline_macro_f1"), "primary_hypothesis.improvement",
        F.expr(after.format("calibration")).nll.alias("calibration_nll"),
        F.expr(after.format("calibration_test")).nll.alias("test_nll"),
        F.round(F.expr(after.format("calibration")).ece, 6).alias("calibration_ece"),
        "review_policy_calibration.threshold", "review_policy_calibration.accepted_count",
        "review_policy_calibration.target_met",
        F.col("review_policy_test.accepted_count").alias("test_accepted"),
        F.col("review_policy_test.wilson_low").alias("test_wilson_low"),
        F.array_join(F.transform("model_classes", lambda c: F.format_string("%d:%.6f", c.class_id, c.f1)), " ")
        .alias("class_f1"),
        ((F.col("model_macro_f1_interval.low") <= F.col("model.macro_f1"))
         & (F.col("model.macro_f1") <= F.col("model_macro_f1_interval.high"))).alias("interval_encloses")))
