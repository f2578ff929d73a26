"""Registered checks of the text rules and preparation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions import text as tx
from ..functions.labels import class_dimension, decode_label, encode_label
from ..operators import prepare
from ..operators.rowkeys import written
from ..sources import fixtures as fx
from . import sql_fixtures as sq
from .registry import register

LANG_SHORT = ("English", "French", "German", "Spanish")

NAR = f"WITH nar AS ({sq.narratives('lang')})"
NAR_SRC = f"WITH nar AS ({sq.narratives('source')})"
ORD = f"WITH oc AS ({sq.ORDERS_CLS})"
HASH = f"sha256({sq.normalized('text')})"


def _nar(spark, sf_dir):
    return fx.narratives(spark, sf_dir, "lang")


def _nar_src(spark, sf_dir):
    return fx.narratives(spark, sf_dir, "source")


@register("normalize_text", NAR + f" SELECT complaint_id, {sq.normalized('text')} AS normalized FROM nar")
def q_normalize(spark, sf_dir):
    return _nar(spark, sf_dir).select("complaint_id", tx.normalize_text(F.col("text")).alias("normalized"))


@register("narrative_hash", NAR + f" SELECT complaint_id, {HASH} AS narrative_hash FROM nar")
def q_hash(spark, sf_dir):
    return _nar(spark, sf_dir).select("complaint_id",
                                      tx.narrative_hash(F.col("text")).alias("narrative_hash"))


def _slug_sql(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-')"


@register("slug", ORD + f" SELECT complaint_id, label, {_slug_sql('label')} AS label_slug, {_slug_sql('issue')} AS issue_slug FROM oc")
def q_slug(spark, sf_dir):
    o = fx.orders_cls(spark, sf_dir)
    return o.select("complaint_id", "label", tx.slug(F.col("label")).alias("label_slug"),
                    tx.slug(F.col("issue")).alias("issue_slug"))


@register("collapse_whitespace", NAR + f" SELECT complaint_id, {sq.collapse('text')} AS collapsed FROM nar")
def q_collapse(spark, sf_dir):
    return _nar(spark, sf_dir).select("complaint_id",
                                      tx.collapse_whitespace(F.col("text")).alias("collapsed"))


@register("validate_input", NAR + f""" SELECT complaint_id,
    CASE WHEN text IS NULL THEN 'not_text' WHEN length({sq.collapse('text')}) < 20 THEN 'too_short'
         WHEN length({sq.collapse('text')}) > 6000 THEN 'too_long' ELSE 'ok' END AS status,
    CAST(length({sq.collapse('text')}) AS BIGINT) AS n_chars FROM nar""")
def q_validate_input(spark, sf_dir):
    d = _nar(spark, sf_dir)
    return d.select("complaint_id", tx.input_status(F.col("text")).alias("status"),
                    F.char_length(tx.collapse_whitespace(F.col("text"))).cast("long").alias("n_chars"))


_ENC = " ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(fx.LANG_CLASSES))


@register("encode_label", NAR + f""" SELECT complaint_id, label, CAST(CASE label {_ENC} END AS INTEGER) AS label_id,
    CASE WHEN (CASE label {_ENC} END) IS NULL THEN 'unknown_label' ELSE 'ok' END AS label_status FROM nar""")
def q_encode(spark, sf_dir):
    dim = class_dimension(spark, fx.LANG_CLASSES, LANG_SHORT)
    return encode_label(_nar(spark, sf_dir).select("complaint_id", "label"), dim)


@register("decode_label", f"WITH sl AS ({sq.SCORED_LINES}) SELECT id, label_id, ['accepted','none','returned'][label_id + 1] AS true_label FROM sl")
def q_decode(spark, sf_dir):
    s = fx.scored_lines(spark, sf_dir)
    return s.select("id", "label_id", decode_label(F.col("label_id"), fx.RETURN_FLAG_NAMES).alias("true_label"))


_SHORT = " ".join(f"WHEN '{lab}' THEN '{LANG_SHORT[i]}'" for i, lab in enumerate(fx.LANG_CLASSES))


@register("short_label", NAR + f" SELECT complaint_id, label, CASE label {_SHORT} END AS short_label FROM nar")
def q_short(spark, sf_dir):
    dim = class_dimension(spark, fx.LANG_CLASSES, LANG_SHORT).select("label", "short_label")
    return _nar(spark, sf_dir).select("complaint_id", "label").join(F.broadcast(dim), "label", "left")


@register("filter_window_product", NAR + """ SELECT * FROM nar WHERE label IN ('en', 'de')
    AND text IS NOT NULL AND text <> '' AND date_received BETWEEN DATE '2024-01-15' AND DATE '2024-02-29'""")
def q_filter_window(spark, sf_dir):
    return prepare.filter_window(_nar(spark, sf_dir), ["en", "de"], "2024-01-15", "2024-02-29")


def _hashed(src: str) -> str:
    return f""", hs AS (SELECT *, {HASH} AS narrative_hash FROM {src}
      WHERE text IS NOT NULL AND text <> '' AND label IS NOT NULL AND label <> ''),
    grp AS (SELECT narrative_hash, min(label) AS mn, max(label) AS mx, count(*) AS n FROM hs GROUP BY 1)"""


_KEPT = """, kept AS (SELECT * FROM hs WHERE narrative_hash IN (SELECT narrative_hash FROM grp WHERE mn = mx)
      QUALIFY row_number() OVER (PARTITION BY narrative_hash ORDER BY date_received, complaint_id) = 1)"""


@register("deduplicate_records", NAR + _hashed("nar") + _KEPT
          + " SELECT complaint_id, date_received, issue, label, text, narrative_hash FROM kept")
def q_dedup(spark, sf_dir):
    return prepare.deduplicate_records(_nar(spark, sf_dir))


@register("dedup_stats", NAR_SRC + _hashed("nar") + """ SELECT (SELECT count(*) FROM nar) AS input_count,
    count(*) FILTER (WHERE mn = mx) AS output_count,
    CAST(coalesce(sum(n - 1) FILTER (WHERE mn = mx), 0) AS BIGINT) AS duplicate_count,
    CAST(coalesce(sum(n) FILTER (WHERE mn <> mx), 0) AS BIGINT) AS conflict_count,
    (SELECT count(*) FROM nar) - CAST(sum(n) AS BIGINT) AS dropped_count FROM grp""")
def q_dedup_stats(spark, sf_dir):
    return prepare.dedup_stats(_nar_src(spark, sf_dir))


@register("conflict_groups", NAR_SRC + _hashed("nar") + """ SELECT narrative_hash, complaint_id, label, date_received
    FROM hs WHERE narrative_hash IN (SELECT narrative_hash FROM grp WHERE mn <> mx)""")
def q_conflicts(spark, sf_dir):
    return prepare.conflict_groups(_nar_src(spark, sf_dir)).select(
        "narrative_hash", "complaint_id", "label", "date_received")


def _sample_sql(src: str, count: int) -> str:
    return f""", rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY date_received, complaint_id) - 1 AS r0,
        count(*) OVER (PARTITION BY label) AS n FROM {src}),
    smp AS (SELECT * FROM rk WHERE n <= {count} OR EXISTS (SELECT 1 FROM (SELECT range AS i FROM range(0, {count})) g
        WHERE round_even(CAST(g.i * (rk.n - 1) AS DOUBLE) / {count - 1}.0, 0) = rk.r0))"""


@register("sample_evenly", ORD + _sample_sql("oc", config.SAMPLES_PER_CLASS)
          + " SELECT complaint_id, label, date_received, r0 + 1 AS rank FROM smp")
def q_sample(spark, sf_dir):
    return prepare.sample_evenly(fx.orders_cls(spark, sf_dir), config.SAMPLES_PER_CLASS).select(
        "complaint_id", "label", "date_received", "rank")


@register("evenly_spaced_pages", ORD + f""", rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY date_received, complaint_id) - 1 AS r0,
        count(*) OVER (PARTITION BY label) AS n FROM oc),
    cls AS (SELECT DISTINCT label, n FROM rk),
    offs AS (SELECT label, 0 AS o FROM cls WHERE n > 0 AND (n <= {config.PAGE_SIZE} OR least({config.PAGES}, ceil(n / {config.PAGE_SIZE}.0)) = 1)
      UNION
      SELECT label, CAST(round_even(CAST(i * (n - {config.PAGE_SIZE}) AS DOUBLE) / (least({config.PAGES}, ceil(n / {config.PAGE_SIZE}.0)) - 1), 0) AS BIGINT)
      FROM cls, (SELECT range AS i FROM range(0, {config.PAGES})) g
      WHERE n > {config.PAGE_SIZE} AND least({config.PAGES}, ceil(n / {config.PAGE_SIZE}.0)) > 1
        AND g.i < least({config.PAGES}, ceil(n / {config.PAGE_SIZE}.0)))
  SELECT complaint_id, rk.label, r0 + 1 AS rank, min(o) AS page_start
  FROM rk JOIN offs ON rk.label = offs.label AND r0 >= o AND r0 < o + {config.PAGE_SIZE}
  GROUP BY complaint_id, rk.label, r0""")
def q_pages(spark, sf_dir):
    return prepare.evenly_spaced_pages(fx.orders_cls(spark, sf_dir)).select(
        "complaint_id", "label", "rank", "page_start")


def _split_sql(src: str) -> str:
    return f""", sp AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY date_received, complaint_id) AS rk2,
        count(*) OVER (PARTITION BY label) AS n2 FROM {src}),
    bd AS (SELECT *, greatest(1, floor(n2 * 0.7::DOUBLE)) AS te0, greatest(1, floor(n2 * 0.15::DOUBLE)) AS cs FROM sp),
    splits AS (SELECT *, rk2 AS rank,
      CASE WHEN rk2 <= (CASE WHEN te0 + cs >= n2 THEN least(te0, n2 - 2) ELSE te0 END) THEN 'train'
           WHEN rk2 <= (CASE WHEN te0 + cs >= n2 THEN n2 - 1 ELSE te0 + cs END) THEN 'calibration'
           ELSE 'test' END AS split FROM bd)"""


@register("temporal_split", ORD + _split_sql("oc")
          + " SELECT complaint_id, label, date_received, rank, split FROM splits")
def q_split(spark, sf_dir):
    return prepare.temporal_split(fx.orders_cls(spark, sf_dir), with_rank=True).select(
        "complaint_id", "label", "date_received", "rank", "split")


@register("temporal_split_texts", NAR + _split_sql("nar") + """ SELECT complaint_id, label, date_received, split,
    sha256(text) AS text_sha256 FROM splits""")
def q_split_texts(spark, sf_dir):
    return prepare.temporal_split(_nar(spark, sf_dir)).select(
        "complaint_id", "label", "date_received", "split", F.sha2(F.col("text"), 256).alias("text_sha256"))


@register("sample_evenly_texts", NAR + _sample_sql("nar", 40)
          + " SELECT complaint_id, label, r0 + 1 AS rank, sha256(text) AS text_sha256 FROM smp")
def q_sample_texts(spark, sf_dir):
    return prepare.sample_evenly(_nar(spark, sf_dir), 40).select(
        "complaint_id", "label", "rank", F.sha2(F.col("text"), 256).alias("text_sha256"))


@register("split_counts_check", ORD + """, g AS (SELECT label, count(*) AS n FROM oc GROUP BY 1),
    b AS (SELECT *, greatest(1, floor(n * 0.7::DOUBLE)) AS te0, greatest(1, floor(n * 0.15::DOUBLE)) AS cs FROM g),
    b2 AS (SELECT *, CASE WHEN te0 + cs >= n THEN n - 1 ELSE te0 + cs END AS ce,
        CASE WHEN te0 + cs >= n THEN least(te0, n - 2) ELSE te0 END AS te FROM b)
  SELECT label, n, CAST(CASE WHEN n >= 3 THEN te END AS BIGINT) AS train_n,
    CAST(CASE WHEN n >= 3 THEN ce - te END AS BIGINT) AS calibration_n,
    CAST(CASE WHEN n >= 3 THEN n - ce END AS BIGINT) AS test_n,
    CASE WHEN n >= 3 THEN 'ok' ELSE 'too_small' END AS status FROM b2""")
def q_split_counts(spark, sf_dir):
    return prepare.split_counts_check(fx.orders_cls(spark, sf_dir))


PREPARED_SQL = (NAR + _hashed("(SELECT complaint_id, date_received, issue, label, text FROM nar)")
                + _KEPT + _split_sql("kept"))


def prepared(spark, sf_dir):
    """The whole table, deduplicated and split."""
    return prepare.prepared_splits(_nar(spark, sf_dir), sample=False)


@register("audit_split_leakage", PREPARED_SQL + """ SELECT label,
    count(*) FILTER (WHERE split = 'train') AS train_n,
    count(*) FILTER (WHERE split = 'calibration') AS calibration_n,
    count(*) FILTER (WHERE split = 'test') AS test_n,
    max(date_received) FILTER (WHERE split = 'train') AS max_train_date,
    min(date_received) FILTER (WHERE split = 'calibration') AS min_calibration_date,
    max(date_received) FILTER (WHERE split = 'calibration') AS max_calibration_date,
    min(date_received) FILTER (WHERE split = 'test') AS min_test_date,
    coalesce(max(date_received) FILTER (WHERE split = 'train') <= min(date_received) FILTER (WHERE split = 'calibration'), true)
      AND coalesce(max(date_received) FILTER (WHERE split = 'calibration') <= min(date_received) FILTER (WHERE split = 'test'), true) AS time_ordered,
    (SELECT count(*) FROM (SELECT narrative_hash FROM splits GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS shared_hash_count
  FROM splits GROUP BY label""")
def q_audit(spark, sf_dir):
    return prepare.audit_split_leakage(prepared(spark, sf_dir))


@register("ordered_output", PREPARED_SQL
          + " SELECT complaint_id, label, date_received, split, narrative_hash FROM splits")
def q_ordered(spark, sf_dir):
    return prepare.ordered_output(prepared(spark, sf_dir)).select(
        "complaint_id", "label", "date_received", "split", "narrative_hash")


def _places(ordered):
    """Each row's place in the order in which it would be written: part by part, row by row."""
    from ..operators.prefix import ordered_positions
    seen = written(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered-places")
    return ordered_positions(seen, [F.col("_at")]).withColumnRenamed("rank", "place")


@register("ordered_splits", PREPARED_SQL + """ SELECT complaint_id, label, date_received, split,
    row_number() OVER (ORDER BY label, date_received, complaint_id) AS place FROM splits""")
def q_ordered_splits(spark, sf_dir):
    narrow = prepared(spark, sf_dir).select("complaint_id", "label", "date_received", "split")
    return _places(prepare.ordered_output(narrow)).select("complaint_id", "label", "date_received", "split", "place")


@register("ordered_kept", NAR + _hashed("nar") + _KEPT + """ SELECT complaint_id, label, date_received,
    row_number() OVER (ORDER BY date_received, complaint_id, label) AS place FROM kept""")
def q_ordered_kept(spark, sf_dir):
    narrow = prepare.deduplicate_records(_nar(spark, sf_dir)).select("complaint_id", "label", "date_received")
    return _places(prepare.ordered_output(narrow, prepare.KEPT_ORDER)).select(
        "complaint_id", "label", "date_received", "place")


@register("split_manifest", PREPARED_SQL + """ SELECT
    CASE WHEN grouping(split) = 1 THEN '__all__' ELSE split END AS split,
    CASE WHEN grouping(label) = 1 THEN '__all__' ELSE label END AS label,
    count(*) AS count FROM splits GROUP BY ROLLUP (split, label)""")
def q_manifest(spark, sf_dir):
    from ..sources.io import split_counts
    return split_counts(prepared(spark, sf_dir))
