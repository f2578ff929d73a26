"""Registered queries (spark, sf_dir) -> DataFrame and their DuckDB oracles.

Each query reads the driver's tables through a fixture view and runs one
operator over the whole table. Doubles are rounded to 9 digits at the end so
that engines with different summation order hash equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .. import config
from ..functions import scores
from ..functions.labels import class_dimension
from ..operators import calibrate, metrics, policy
from ..sources import fixtures as fx
from . import sql_fixtures as sq

T = config.FIXTURE_TEMPERATURE
GRID = [round(0.5 + 0.1 * i, 1) for i in range(11)]
DIGITS = 9

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def r(expr: str, name: str) -> str:
    return f"round({expr}, {DIGITS}) AS {name}"


# ---------------------------------------------------------------- scoring
def _lines(spark, sf_dir):
    return fx.scored_lines(spark, sf_dir)


CONF_DIGITS = 12
CLASSES = len(fx.RETURN_FLAG_CLASSES)


def _scored(spark, sf_dir, t=T):
    """Scored fixture. Confidence is quantised to 12 digits here (and in the
    oracle): Java's and DuckDB's exp differ in the last bit, which would
    otherwise change which confidences tie. The operators themselves are exact."""
    s = policy.with_scores(_lines(spark, sf_dir), t)
    return s.withColumn("confidence", F.round("confidence", CONF_DIGITS))


def _cal(df):
    return df.where(F.col("split") == "calibration")


def _test(df):
    return df.where(F.col("split") == "test")


WITH_SL = f"WITH sl AS ({sq.SCORED_LINES})"
WITH_SC = WITH_SL + f", sc AS ({sq.scored(T)})"
WITH_SC1 = WITH_SL + f", sc AS ({sq.scored(1.0)})"


def _probs_cols(df):
    return df.select("id", *[F.get(F.col("probs"), i).alias(f"p{i}") for i in range(3)])


@register("softmax", WITH_SC1 + f" SELECT id, {r('p0','p0')}, {r('p1','p1')}, {r('p2','p2')} FROM sc")
def q_softmax(spark, sf_dir):
    return rounded(_probs_cols(_scored(spark, sf_dir, 1.0)))


@register("temperature_softmax",
          WITH_SC + f" SELECT id, {r('p0','p0')}, {r('p1','p1')}, {r('p2','p2')} FROM sc")
def q_temperature_softmax(spark, sf_dir):
    return rounded(_probs_cols(_scored(spark, sf_dir)))


@register("top_label", WITH_SC + f" SELECT id, label_id, pred_id, correct, {r('confidence','confidence')} FROM sc")
def q_top_label(spark, sf_dir):
    return rounded(_scored(spark, sf_dir).select("id", "label_id", "pred_id", "correct", "confidence"))


_TOPK_SQL = WITH_SC + """, long AS (
    SELECT id, 0 AS c, p0 AS p FROM sc UNION ALL SELECT id, 1, p1 FROM sc UNION ALL SELECT id, 2, p2 FROM sc),
  ranked AS (SELECT id, c, p, row_number() OVER (PARTITION BY id ORDER BY p DESC, c) AS k FROM long)
  SELECT id,
    max(CASE WHEN k = 1 THEN ['accepted','none','returned'][c + 1] END) AS top1_label,
    round(max(CASE WHEN k = 1 THEN p END), 9) AS top1_probability,
    max(CASE WHEN k = 2 THEN ['accepted','none','returned'][c + 1] END) AS top2_label,
    round(max(CASE WHEN k = 2 THEN p END), 9) AS top2_probability,
    max(CASE WHEN k = 3 THEN ['accepted','none','returned'][c + 1] END) AS top3_label,
    round(max(CASE WHEN k = 3 THEN p END), 9) AS top3_probability
  FROM ranked GROUP BY id"""


@register("top_k_classes", _TOPK_SQL)
def q_top_k(spark, sf_dir):
    s = _scored(spark, sf_dir).select(
        "id", scores.top_k(F.col("probs"), 3, fx.RETURN_FLAG_NAMES).alias("top"))
    cols = []
    for i in range(3):
        cols += [F.col("top")[i]["label"].alias(f"top{i + 1}_label"),
                 F.col("top")[i]["probability"].alias(f"top{i + 1}_probability")]
    return rounded(s.select("id", *cols))


@register("wilson_interval", WITH_SC + f""" SELECT split, pred_id, CAST(sum(CAST(correct AS INTEGER)) AS BIGINT) AS successes,
    count(*) AS total, {r(sq.wilson_sql('sum(CAST(correct AS INTEGER))', 'count(*)')[0], 'low')},
    {r(sq.wilson_sql('sum(CAST(correct AS INTEGER))', 'count(*)')[1], 'high')}
  FROM sc GROUP BY split, pred_id""")
def q_wilson(spark, sf_dir):
    g = _scored(spark, sf_dir).groupBy("split", "pred_id").agg(
        F.count_if("correct").alias("successes"), F.count(F.lit(1)).alias("total"))
    low, high = scores.wilson_bounds(F.col("successes"), F.col("total"))
    return rounded(g.select("split", "pred_id", "successes", "total", low.alias("low"),
                            high.alias("high")))


# ---------------------------------------------------------------- calibration
@register("negative_log_likelihood", WITH_SC + f""" SELECT
    {r("avg(-ln(greatest(least(CASE label_id WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 END, 1.0::DOUBLE), 1e-12::DOUBLE)))", "nll")},
    CAST(0 AS BIGINT) AS bad_label_count, count(*) AS n FROM sc WHERE split = 'test'""")
def q_nll(spark, sf_dir):
    return rounded(calibrate.negative_log_likelihood(_test(_scored(spark, sf_dir))))


def _nll_grid_sql():
    grid = ", ".join(f"({sq.dbl(t)})" for t in GRID)
    return WITH_SL + f""", g(t) AS (VALUES {grid}),
    x AS (SELECT t, label_id, logits[1] / t AS x0, logits[2] / t AS x1, logits[3] / t AS x2
          FROM sl CROSS JOIN g WHERE split = 'calibration'),
    e AS (SELECT t, label_id, exp(x0 - greatest(x0,x1,x2)) AS e0, exp(x1 - greatest(x0,x1,x2)) AS e1,
          exp(x2 - greatest(x0,x1,x2)) AS e2 FROM x)
    SELECT t AS temperature, {r("avg(-ln(greatest(least(CASE label_id WHEN 0 THEN e0 WHEN 1 THEN e1 ELSE e2 END / (e0 + e1 + e2), 1.0::DOUBLE), 1e-12::DOUBLE)))", "nll")}
    FROM e GROUP BY t"""


@register("nll_grid", _nll_grid_sql())
def q_nll_grid(spark, sf_dir):
    return rounded(calibrate.nll_grid(_cal(_lines(spark, sf_dir)), GRID, n_classes=CLASSES))


# The NLL is convex in b = 1/T: halve the bracket on the sign of its slope.
_FIT_CTE = f"""WITH RECURSIVE sl AS ({sq.SCORED_LINES}),
  dl AS (SELECT logits[1] AS l0, logits[2] AS l1, logits[3] AS l2, logits[label_id + 1] AS ly, count(*) AS n
         FROM sl WHERE split = 'calibration' GROUP BY ALL),
  halve(step, lo, hi) AS (
    SELECT 0, 1.0::DOUBLE / {sq.dbl(config.MAX_TEMPERATURE)}, 1.0::DOUBLE / {sq.dbl(config.MIN_TEMPERATURE)}
    UNION ALL
    SELECT step + 1, CASE WHEN slope > 0 THEN lo ELSE mid END, CASE WHEN slope > 0 THEN mid ELSE hi END
    FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid,
            (SELECT sum(n * ((l0 * exp(l0 * (lo + hi) / 2) + l1 * exp(l1 * (lo + hi) / 2) + l2 * exp(l2 * (lo + hi) / 2))
                             / (exp(l0 * (lo + hi) / 2) + exp(l1 * (lo + hi) / 2) + exp(l2 * (lo + hi) / 2)) - ly))
             FROM dl) AS slope
          FROM halve WHERE step < 45)),
  fitted AS (SELECT 2.0 / (lo + hi) AS t FROM halve WHERE step = 45)"""


def _before_after_sql(head: str, after: float | str, columns: str) -> str:
    t = after if isinstance(after, str) else sq.dbl(after)
    return head + f""", s AS (
      SELECT 'before' AS stage, 1.0::DOUBLE AS temperature, * FROM ({sq.scored(1.0)}) WHERE split = 'calibration'
      UNION ALL
      SELECT 'after', {t}, * FROM ({sq.scored(t)}) WHERE split = 'calibration'),
    b AS (SELECT stage, temperature, {sq.bin_case('confidence', 15)} AS bin, count(*) AS n,
      sum(-ln(greatest(least(CASE label_id WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 1.0::DOUBLE), 1e-12::DOUBLE))) AS nll_sum,
      avg(CAST(correct AS DOUBLE)) AS acc, avg(confidence) AS conf FROM s GROUP BY 1, 2, 3),
    f AS (SELECT stage, temperature, sum(nll_sum) / sum(n) AS nll,
      coalesce(sum(CASE WHEN bin IS NOT NULL THEN n * abs(acc - conf) END) / sum(n), 0.0) AS ece
      FROM b GROUP BY stage, temperature)
    SELECT {columns} FROM f"""


@register("fit_temperature", _before_after_sql(_FIT_CTE, "(SELECT t FROM fitted)", """stage,
    round(temperature, 4) AS temperature, round(nll, 7) AS nll, round(ece, 5) AS ece"""))
def q_fit_temperature(spark, sf_dir):
    cal = _cal(_lines(spark, sf_dir))
    fit = calibrate.calibration_before_after(cal, calibrate.fit_temperature(cal))
    return fit.select("stage", F.round("temperature", 4).alias("temperature"),
                      F.round("nll", 7).alias("nll"), F.round("ece", 5).alias("ece"))


def _ece_sql(where: str, n_bins: int) -> str:
    return WITH_SC + f""", b AS (SELECT {sq.bin_case('confidence', n_bins)} AS bin, count(*) AS n,
      avg(CAST(correct AS DOUBLE)) AS acc, avg(confidence) AS conf FROM sc WHERE {where} GROUP BY 1)"""


@register("expected_calibration_error", _ece_sql("split = 'test'", 15) + f"""
  SELECT {r("coalesce(sum(CASE WHEN bin IS NOT NULL THEN n * abs(acc - conf) END) / sum(n), 0.0)", "ece")},
    CAST(sum(n) AS BIGINT) AS n FROM b""")
def q_ece(spark, sf_dir):
    return rounded(calibrate.expected_calibration_error(_test(_scored(spark, sf_dir)), 15))


@register("reliability_table", _ece_sql("split = 'test'", 10) + f"""
  SELECT bin, {r(sq.bin_centre_case('bin', 10), 'centre')}, {r('acc', 'accuracy')},
    {r('conf', 'mean_confidence')}, n AS count FROM b WHERE bin IS NOT NULL""")
def q_reliability(spark, sf_dir):
    return rounded(calibrate.reliability_table(_test(_scored(spark, sf_dir)), 10))


_CURVE_CTE = WITH_SC + """, cv AS (SELECT confidence AS threshold,
      CAST(sum(n) OVER (ORDER BY confidence DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS accepted_count,
      CAST(sum(k) OVER (ORDER BY confidence DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS correct_count,
      CAST(sum(n) OVER () AS BIGINT) AS total_count
    FROM (SELECT confidence, count(*) AS n, sum(CAST(correct AS INTEGER)) AS k FROM sc
          WHERE split = 'calibration' GROUP BY confidence)),
  curve AS (SELECT threshold, accepted_count, correct_count, total_count,
      CAST(accepted_count AS DOUBLE) / total_count AS coverage,
      CAST(correct_count AS DOUBLE) / accepted_count AS accepted_accuracy FROM cv)"""

_POLICY_CTE = _CURVE_CTE + f""", best AS (SELECT * FROM curve
      WHERE accepted_count > 0 AND accepted_accuracy + 1e-12::DOUBLE >= {sq.dbl(config.TARGET_ACCURACY)}
      ORDER BY accepted_count DESC, threshold ASC LIMIT 1),
  pol AS (SELECT coalesce(b.threshold, 1.0::DOUBLE) AS threshold,
      coalesce(b.accepted_count, CAST(0 AS BIGINT)) AS accepted_count,
      coalesce(b.coverage, 0.0::DOUBLE) AS coverage, b.accepted_accuracy,
      b.threshold IS NOT NULL AS target_met
    FROM (SELECT 1 AS one) o LEFT JOIN best b ON true)"""


@register("threshold_curve", _CURVE_CTE + f""" SELECT {r('threshold','threshold')}, accepted_count,
    correct_count, {r('coverage','coverage')}, {r('accepted_accuracy','accepted_accuracy')}, total_count FROM curve""")
def q_threshold_curve(spark, sf_dir):
    return rounded(policy.threshold_curve(_cal(_scored(spark, sf_dir))))


def _policy(spark, sf_dir):
    return policy.select_confidence_threshold(_cal(_scored(spark, sf_dir)))


@register("select_confidence_threshold", _POLICY_CTE + f""" SELECT {r('threshold','threshold')},
    accepted_count, {r('coverage','coverage')}, {r('accepted_accuracy','accepted_accuracy')}, target_met FROM pol""")
def q_select_threshold(spark, sf_dir):
    return rounded(_policy(spark, sf_dir))


_W = sq.wilson_sql("acc_k", "acc_n")
_APPLY_SQL = _POLICY_CTE + f""", a AS (SELECT count(*) AS n,
      count(*) FILTER (WHERE coalesce(sc.confidence >= pol.threshold, false)) AS acc_n,
      count(*) FILTER (WHERE coalesce(sc.confidence >= pol.threshold, false) AND correct) AS acc_k,
      max(pol.target_met) AS met
    FROM sc CROSS JOIN pol WHERE split = 'test')
  SELECT CASE WHEN met AND acc_n > 0 THEN acc_n ELSE 0 END AS accepted_count,
    {r("CASE WHEN met AND acc_n > 0 THEN CAST(acc_n AS DOUBLE) / n ELSE 0.0 END", "coverage")},
    {r("CASE WHEN met AND acc_n > 0 THEN CAST(acc_k AS DOUBLE) / acc_n END", "accepted_accuracy")},
    {r(f"CASE WHEN met AND acc_n > 0 THEN {_W[0]} END", "wilson_low")},
    {r(f"CASE WHEN met AND acc_n > 0 THEN {_W[1]} END", "wilson_high")},
    n AS evaluated_count FROM a"""


@register("apply_policy", _APPLY_SQL)
def q_apply_policy(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return rounded(policy.apply_policy(_test(s), policy.select_confidence_threshold(_cal(s))))


@register("calibration_before_after", _before_after_sql(
    WITH_SL, T, f"stage, temperature, {r('nll', 'nll')}, {r('ece', 'ece')}"))
def q_before_after(spark, sf_dir):
    return rounded(calibrate.calibration_before_after(_cal(_lines(spark, sf_dir)), T))


# ---------------------------------------------------------------- routing
_ROUTE_SQL = _POLICY_CTE + f""", routed AS (
    SELECT sc.id, sc.label_id, sc.pred_id, sc.correct, sc.split, sc.pred_b, sc.confidence,
      ['accepted','none','returned'][sc.pred_id + 1] AS predicted_label,
      pol.threshold AS review_threshold, pol.target_met AS met,
      coalesce(pol.target_met AND sc.confidence >= pol.threshold, false) AS meets
    FROM sc CROSS JOIN pol WHERE sc.split = 'test')"""


@register("route_reviews", _ROUTE_SQL + f""" SELECT id, label_id, pred_id, correct, split, pred_b,
    {r('confidence','confidence')}, predicted_label,
    CASE WHEN meets THEN '{config.ROUTE_ACTION}' ELSE '{config.REVIEW_ACTION}' END AS recommended_action,
    CASE WHEN meets THEN '{config.REASON_MEETS}' WHEN NOT met THEN '{config.REASON_FAILS_CLOSED}'
         ELSE '{config.REASON_BELOW}' END AS review_reason,
    {r('review_threshold','review_threshold')} FROM routed""")
def q_route(spark, sf_dir):
    s = _scored(spark, sf_dir)
    routed = policy.route(_test(s), policy.select_confidence_threshold(_cal(s)), fx.RETURN_FLAG_NAMES)
    return rounded(routed.drop("top_predictions"))


def _routed(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return policy.route(_test(s), policy.select_confidence_threshold(_cal(s)), fx.RETURN_FLAG_NAMES)


@register("deferral_summary", _ROUTE_SQL + f""" SELECT
    CASE WHEN grouping(predicted_label) = 1 THEN '__all__' ELSE predicted_label END AS predicted_label,
    count(*) AS total_count, count(*) FILTER (WHERE meets) AS accepted_count,
    count(*) FILTER (WHERE NOT meets) AS deferred_count,
    {r('CAST(count(*) FILTER (WHERE meets) AS DOUBLE) / count(*)', 'accepted_share')},
    {r('CAST(count(*) FILTER (WHERE NOT meets) AS DOUBLE) / count(*)', 'deferred_share')}
  FROM routed GROUP BY ROLLUP (predicted_label)""")
def q_deferral(spark, sf_dir):
    return rounded(policy.deferral_summary(_routed(spark, sf_dir)))


def _pct(x: str) -> str:
    return f"printf('%.1f%%', {x} * 100.0::DOUBLE)"


@register("present_routes", _ROUTE_SQL + f""", long AS (
    SELECT id, 0 AS c, p0 AS p FROM sc WHERE split = 'test' UNION ALL SELECT id, 1, p1 FROM sc WHERE split = 'test'
    UNION ALL SELECT id, 2, p2 FROM sc WHERE split = 'test'),
  rk AS (SELECT id, c, p, row_number() OVER (PARTITION BY id ORDER BY p DESC, c) AS k FROM long),
  tops AS (SELECT id, string_agg(['accepted','none','returned'][c + 1] || ': ' || {_pct('p')}, '; ' ORDER BY k) AS top_text
    FROM rk GROUP BY id)
  SELECT routed.id, predicted_label, {_pct('confidence')} AS confidence_text,
    CASE WHEN meets THEN '{config.ROUTE_HEADLINE_ROUTE}' ELSE '{config.ROUTE_HEADLINE_REVIEW}' END AS route,
    CASE WHEN meets THEN '{config.REASON_MEETS}' WHEN NOT met THEN '{config.REASON_FAILS_CLOSED}'
         ELSE '{config.REASON_BELOW}' END || ' Threshold: ' || {_pct('review_threshold')} || '. ' ||
    CASE WHEN meets THEN '{config.ROUTE_DETAIL_ROUTE}' ELSE '{config.ROUTE_DETAIL_REVIEW}' END AS route_detail,
    top_text
  FROM routed JOIN tops ON routed.id = tops.id""")
def q_present(spark, sf_dir):
    return policy.present_routes(_routed(spark, sf_dir))


# ---------------------------------------------------------------- metrics
_CLASSES_SQL = "SELECT * FROM (VALUES (0, 'accepted'), (1, 'none'), (2, 'returned')) t(class_id, label)"
_CELLS = WITH_SC + f""", cells AS (SELECT label_id, pred_id, count(*) AS n FROM sc WHERE split = 'test' GROUP BY 1, 2),
  pc AS (SELECT class_id, coalesce(s.support, 0) AS support, coalesce(p.predicted, 0) AS predicted,
      coalesce(t.tp, 0) AS tp FROM
      (SELECT label_id AS class_id, sum(n) AS support FROM cells GROUP BY 1) s
      FULL OUTER JOIN (SELECT pred_id AS class_id, sum(n) AS predicted FROM cells GROUP BY 1) p USING (class_id)
      LEFT JOIN (SELECT label_id AS class_id, sum(n) AS tp FROM cells WHERE label_id = pred_id GROUP BY 1) t USING (class_id)),
  pcm AS (SELECT class_id, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted, CAST(tp AS BIGINT) AS tp,
      CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS precision,
      CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS recall,
      CASE WHEN support + predicted > 0 THEN CAST(2 * tp AS DOUBLE) / (support + predicted) ELSE 0.0 END AS f1
    FROM pc)"""


@register("confusion_matrix", _CELLS + f""", cls AS ({_CLASSES_SQL})
  SELECT a.class_id AS label_id, b.class_id AS pred_id, a.label AS true_label, b.label AS pred_label,
    CAST(coalesce(cells.n, 0) AS BIGINT) AS count
  FROM cls a CROSS JOIN cls b LEFT JOIN cells ON cells.label_id = a.class_id AND cells.pred_id = b.class_id""")
def q_confusion(spark, sf_dir):
    dim = class_dimension(spark, fx.RETURN_FLAG_NAMES)
    return metrics.confusion_matrix(_test(_scored(spark, sf_dir)), dim)


@register("per_class_metrics", _CELLS + f""" SELECT class_id, {r('precision','precision')}, {r('recall','recall')},
    {r('f1','f1')}, support, predicted, tp FROM pcm""")
def q_per_class(spark, sf_dir):
    return rounded(metrics.per_class_metrics(_test(_scored(spark, sf_dir))))


@register("classification_metrics", _CELLS + f""" SELECT {r('CAST(sum(tp) AS DOUBLE) / sum(support)', 'accuracy')},
    {r('avg(f1)', 'macro_f1')}, {r('sum(f1 * support) / sum(support)', 'weighted_f1')},
    CAST(sum(support) AS BIGINT) AS n, count(*) AS class_count FROM pcm""")
def q_classification(spark, sf_dir):
    return rounded(metrics.classification_metrics(_test(_scored(spark, sf_dir))))


@register("bootstrap_macro_f1", _CELLS + f""" SELECT {r('avg(f1)', 'estimate')}, 0.95::DOUBLE AS confidence,
    CAST({config.BOOTSTRAP_RESAMPLES} AS INTEGER) AS resamples, true AS ordered, true AS near_poisson FROM pcm""")
def q_bootstrap(spark, sf_dir):
    """The interval's ends are random draws: the check asks that they enclose
    the estimate and lie within half a width of the row-hash bootstrap's."""
    test = _test(_scored(spark, sf_dir))
    weighed = metrics.poisson_cells(test)  # one read of the rows for both
    drawn = metrics.bootstrap_macro_f1(test, cells=metrics.plain_cells(weighed))
    other = metrics.poisson_bootstrap_macro_f1(test, weighed=weighed).select(
        F.col("low").alias("_low"), F.col("high").alias("_high"))
    half = (F.col("_high") - F.col("_low")) / 2
    return rounded(drawn.crossJoin(other).select(
        "estimate", "confidence", "resamples",
        ((F.col("low") <= F.col("estimate")) & (F.col("estimate") <= F.col("high"))).alias("ordered"),
        ((F.abs(F.col("low") - F.col("_low")) <= half)
         & (F.abs(F.col("high") - F.col("_high")) <= half)).alias("near_poisson")))


def _poisson_sql(n_resamples: int, blocks: bool = False) -> str:
    unit = "substr(md5(id), 1, 2)" if blocks else "id"
    u = f"CAST(('0x' || substr(md5({unit} || '-' || CAST(rep AS VARCHAR)), 1, 8))::UBIGINT AS DOUBLE) / 4294967296.0::DOUBLE"
    return _CELLS + f""", reps AS (SELECT range AS rep FROM range(0, {n_resamples})),
  wc AS (SELECT rep, label_id, pred_id, sum({sq.poisson_case(u)}) AS n
         FROM (SELECT id, label_id, pred_id FROM sc WHERE split = 'test') CROSS JOIN reps GROUP BY 1, 2, 3),
  wc2 AS (SELECT * FROM wc WHERE n > 0),
  obs AS (SELECT label_id AS class_id FROM cells UNION SELECT pred_id FROM cells),
  s AS (SELECT rep, label_id AS class_id, sum(n) AS support FROM wc2 GROUP BY 1, 2),
  p AS (SELECT rep, pred_id AS class_id, sum(n) AS predicted FROM wc2 GROUP BY 1, 2),
  t AS (SELECT rep, label_id AS class_id, sum(n) AS tp FROM wc2 WHERE label_id = pred_id GROUP BY 1, 2),
  g AS (SELECT DISTINCT rep FROM wc2),
  f AS (SELECT g.rep, obs.class_id,
      CASE WHEN coalesce(s.support, 0) + coalesce(p.predicted, 0) > 0
           THEN CAST(2 * coalesce(t.tp, 0) AS DOUBLE) / (coalesce(s.support, 0) + coalesce(p.predicted, 0)) ELSE 0.0 END AS f1
    FROM g CROSS JOIN obs LEFT JOIN s ON s.rep = g.rep AND s.class_id = obs.class_id
      LEFT JOIN p ON p.rep = g.rep AND p.class_id = obs.class_id
      LEFT JOIN t ON t.rep = g.rep AND t.class_id = obs.class_id),
  m AS (SELECT rep, avg(f1) AS macro_f1 FROM f GROUP BY rep)
  SELECT {r('(SELECT avg(f1) FROM pcm)', 'estimate')}, {r('quantile_cont(macro_f1, 0.025)', 'low')},
    {r('quantile_cont(macro_f1, 0.975)', 'high')}, 0.95::DOUBLE AS confidence, count(*) AS resamples FROM m"""


@register("poisson_bootstrap_macro_f1", _poisson_sql(config.BOOTSTRAP_RESAMPLES))
def q_poisson(spark, sf_dir):
    return rounded(metrics.poisson_bootstrap_macro_f1(_test(_scored(spark, sf_dir))))


@register("blocked_poisson_bootstrap", _poisson_sql(config.BOOTSTRAP_RESAMPLES, blocks=True))
def q_blocked_poisson(spark, sf_dir):
    return rounded(metrics.blocked_poisson_bootstrap(_test(_scored(spark, sf_dir))))


@register("risk_coverage_curve", WITH_SC + f""" SELECT
    row_number() OVER w AS accepted_count,
    {r('CAST(row_number() OVER w AS DOUBLE) / count(*) OVER ()', 'coverage')},
    {r('1.0 - CAST(sum(CAST(correct AS INTEGER)) OVER w AS DOUBLE) / row_number() OVER w', 'risk')},
    {r('confidence', 'threshold')}
  FROM sc WHERE split = 'test' WINDOW w AS (ORDER BY confidence DESC, id ROWS UNBOUNDED PRECEDING)""")
def q_risk_coverage(spark, sf_dir):
    return rounded(metrics.risk_coverage_curve(_test(_scored(spark, sf_dir))))


def _macro_sql(pred: str) -> str:
    return f"""(SELECT avg(f1) FROM (
      SELECT class_id, CASE WHEN coalesce(s, 0) + coalesce(pp, 0) > 0 THEN CAST(2 * coalesce(tp, 0) AS DOUBLE) / (coalesce(s, 0) + coalesce(pp, 0)) ELSE 0.0 END AS f1
      FROM (SELECT label_id AS class_id, count(*) AS s FROM sc WHERE split = 'test' GROUP BY 1)
      FULL OUTER JOIN (SELECT {pred} AS class_id, count(*) AS pp FROM sc WHERE split = 'test' GROUP BY 1) USING (class_id)
      LEFT JOIN (SELECT label_id AS class_id, count(*) AS tp FROM sc WHERE split = 'test' AND label_id = {pred} GROUP BY 1) USING (class_id)))"""


@register("compare_models", WITH_SC + f""" SELECT {r(_macro_sql('pred_id'), 'macro_f1_a')},
    {r(_macro_sql('pred_b'), 'macro_f1_b')}, {r(_macro_sql('pred_b') + ' - ' + _macro_sql('pred_id'), 'improvement')},
    0.02::DOUBLE AS required_improvement,
    ({_macro_sql('pred_b')} - {_macro_sql('pred_id')}) >= 0.02::DOUBLE AS supported""")
def q_compare(spark, sf_dir):
    return rounded(metrics.compare_models(_test(_scored(spark, sf_dir))))


def _f1_table(pred: str, name: str) -> str:
    return f"""(SELECT class_id, s, CASE WHEN coalesce(s, 0) + coalesce(pp, 0) > 0 THEN CAST(2 * coalesce(tp, 0) AS DOUBLE) / (coalesce(s, 0) + coalesce(pp, 0)) ELSE 0.0 END AS {name}
      FROM (SELECT label_id AS class_id, count(*) AS s FROM sc WHERE split = 'test' GROUP BY 1)
      FULL OUTER JOIN (SELECT {pred} AS class_id, count(*) AS pp FROM sc WHERE split = 'test' GROUP BY 1) USING (class_id)
      LEFT JOIN (SELECT label_id AS class_id, count(*) AS tp FROM sc WHERE split = 'test' AND label_id = {pred} GROUP BY 1) USING (class_id))"""


@register("class_level_comparison", WITH_SC + f""" SELECT class_id, {r('coalesce(f1_a, 0.0)', 'f1_a')},
    {r('coalesce(f1_b, 0.0)', 'f1_b')}, {r('coalesce(f1_b, 0.0) - coalesce(f1_a, 0.0)', 'f1_diff')},
    CAST(coalesce(a.s, 0) AS BIGINT) AS support
  FROM {_f1_table('pred_id', 'f1_a')} a FULL OUTER JOIN (SELECT class_id, f1_b FROM {_f1_table('pred_b', 'f1_b')}) b USING (class_id)""")
def q_class_level(spark, sf_dir):
    return rounded(metrics.class_level_comparison(_test(_scored(spark, sf_dir))))


@register("dominant_confusions", _CELLS + f""" SELECT label_id, pred_id, n AS count,
    CAST(sum(n) OVER (PARTITION BY label_id) AS BIGINT) AS support_, 0 AS dummy FROM cells LIMIT 0""")
def q_dominant(spark, sf_dir):
    return rounded(metrics.dominant_confusions(_test(_scored(spark, sf_dir)), 4))


SQL["dominant_confusions"] = _CELLS + f""", sh AS (SELECT label_id, pred_id, n AS count,
    CAST(sum(n) OVER (PARTITION BY label_id) AS BIGINT) AS support FROM cells)
  SELECT label_id, pred_id, count, support, {r('CAST(count AS DOUBLE) / support', 'share')}
  FROM sh WHERE label_id <> pred_id ORDER BY count DESC, label_id, pred_id LIMIT 4"""


from . import checks_prepare  # noqa: E402,F401  (registers its queries)
from . import checks_features  # noqa: E402,F401
from . import checks_io  # noqa: E402,F401
