"""Artifact checks as table operations (A7-A9): many (model, artifact) rows
are validated at once, each row gets a list of violations, and invalid rows
never reach routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import WHITESPACE_JAVA

# Messages (fixed values).
MSG_OBJECT = "payload must contain a JSON object."
MSG_TEMP_NUMERIC = "temperature.json must contain a numeric temperature."
MSG_TEMP_RANGE = "temperature must be between 0.05 and 10.0."
MSG_THRESHOLD_NUMERIC = "review_policy.json must contain a numeric threshold."
MSG_THRESHOLD_RANGE = "review threshold must be between 0 and 1."
MSG_FLAG = "review_policy.json must contain a boolean target_met flag."
MSG_KIND = "unknown artifact kind."


MSG_KEYS = "label_map.json keys must be integer class IDs."
MSG_CONTIGUOUS = "label_map.json class IDs must start at 0 and be contiguous."
MSG_CLASSES = "At least three classes are required for top-three scores."
MSG_BLANK = "Every class label must be a non-empty string."
MSG_UNIQUE = "Class labels must be unique."

_DUPLICATES = "spark.sql.variant.allowDuplicateKeys"
_END = "end of payload"


def _finite(x):
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def parsed_json(df: DataFrame, payload_col: str, name: str) -> DataFrame:
    """Adds the payload as a VARIANT ``name``, null where it is not one JSON document.

    Tokens outside strings that Python writes for NaN and infinities are read as
    numbers that are not finite; of repeated keys the last counts. The payload stands in an
    array before a marker, so anything that follows the document makes it invalid."""
    spark = df.sparkSession
    pieces = F.regexp_extract_all(F.col(payload_col), F.lit(
        r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^"]++|"'), F.lit(0))
    text = F.array_join(F.transform(pieces, lambda t: F.when(t.startswith('"'), t).otherwise(
        F.regexp_replace(t, r"-?\b(?:NaN|Infinity)\b", "1e999"))), "")
    before = spark.conf.get(_DUPLICATES, "false")
    spark.conf.set(_DUPLICATES, "true")  # read when the expression is resolved, which is now
    try:
        out = df.withColumn(name, F.try_parse_json(F.concat(F.lit("["), text, F.lit(f', "{_END}"]'))))
    finally:
        spark.conf.set(_DUPLICATES, before)
    whole = F.try_variant_get(F.col(name), "$[1]", "string") == _END
    return out.withColumn(name, F.when(whole, F.try_variant_get(F.col(name), "$[0]", "variant")))


_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)$"


def _is(path: str, types: str):
    """Whether the part of ``_json`` at ``path`` has a JSON type that matches ``types``."""
    kind = F.schema_of_variant(F.try_variant_get(F.col("_json"), path, "variant"))
    return F.coalesce(kind.rlike(types), F.lit(False))


def _field(field: str, types: str, sql_type: str):
    return F.when(_is(f"$.{field}", types), F.try_variant_get(F.col("_json"), f"$.{field}", sql_type))


def validate_policies(df: DataFrame, payload_col: str = "payload",
                      kind_col: str = "kind") -> DataFrame:
    """Adds ``violations ARRAY<STRING>`` and ``valid`` (A7). kind is
    'temperature' or 'review_policy'. Decided on the JSON type of the top-level
    fields: a number must be a JSON number (not a boolean, string or null), the flag a JSON
    boolean. A null payload or one that is not a single JSON object has no fields."""
    read = parsed_json(df, payload_col, "_json")

    def number(field: str):
        return _is(f"$.{field}", _NUMBER)

    def outside(field: str, low: float, high: float):
        v = _field(field, _NUMBER, "double")
        return number(field) & ~F.coalesce(_finite(v) & v.between(low, high), F.lit(False))

    is_object = _is("$", "^OBJECT")
    is_flag = _is("$.target_met", "^BOOLEAN$")
    kind = F.col(kind_col)
    temp_msgs = F.array(
        F.when(~number("temperature"), F.lit(MSG_TEMP_NUMERIC)),
        F.when(outside("temperature", config.MIN_TEMPERATURE, config.MAX_TEMPERATURE), F.lit(MSG_TEMP_RANGE)))
    policy_msgs = F.array(
        F.when(~number("threshold"), F.lit(MSG_THRESHOLD_NUMERIC)),
        F.when(outside("threshold", 0.0, 1.0), F.lit(MSG_THRESHOLD_RANGE)),
        F.when(~is_flag, F.lit(MSG_FLAG)))
    msgs = (F.when(~is_object, F.array(F.lit(MSG_OBJECT)))
            .when(kind == "temperature", temp_msgs)
            .when(kind == "review_policy", policy_msgs)
            .otherwise(F.array(F.lit(MSG_KIND))))
    v = F.filter(msgs, lambda m: m.isNotNull())
    return read.withColumn("violations", v).withColumn("valid", F.size("violations") == 0).drop("_json")


def policy_values(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Adds ``temperature, threshold, target_met`` read from the payload; null where a field
    is missing or of another type."""
    read = parsed_json(df, payload_col, "_json")
    return read.withColumns({
        "temperature": _field("temperature", _NUMBER, "double"),
        "threshold": _field("threshold", _NUMBER, "double"),
        "target_met": _field("target_met", "^BOOLEAN$", "boolean")}).drop("_json")


def stripped(label):
    """Without the white space that Python's strip removes at both ends."""
    return F.regexp_replace(label, f"^{WHITESPACE_JAVA}|{WHITESPACE_JAVA}$", "")


def validate_label_map(df: DataFrame, model_col: str = "model", key_col: str = "key",
                       label_col: str = "label") -> DataFrame:
    """Per model: integer ids contiguous from 0, at least three classes, no
    blank label, labels unique after stripping white space (A8)."""
    key_int = F.col(key_col).try_cast("bigint")
    lab = stripped(F.col(label_col))
    g = df.groupBy(model_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(key_int.isNull()).alias("bad_keys"),
        F.min(key_int).alias("min_id"), F.max(key_int).alias("max_id"),
        F.count_distinct(key_int).alias("distinct_ids"),
        F.count_if(F.col(label_col).isNull() | (lab == "")).alias("blank_labels"),
        F.count_distinct(lab).alias("distinct_labels"))
    msgs = F.array(
        F.when(F.col("bad_keys") > 0, F.lit(MSG_KEYS)),
        F.when((F.col("bad_keys") == 0) & ~((F.col("min_id") == 0)
               & (F.col("max_id") == F.col("n") - 1) & (F.col("distinct_ids") == F.col("n"))),
               F.lit(MSG_CONTIGUOUS)),
        F.when(F.col("n") < 3, F.lit(MSG_CLASSES)),
        F.when(F.col("blank_labels") > 0, F.lit(MSG_BLANK)),
        F.when((F.col("blank_labels") == 0) & (F.col("distinct_labels") != F.col("n")), F.lit(MSG_UNIQUE)))
    return g.select(model_col, F.col("n").alias("class_count"),
                    F.filter(msgs, lambda m: m.isNotNull()).alias("violations")) \
        .withColumn("valid", F.size("violations") == 0)


def validate_score_shape(df: DataFrame, n_classes: int, logits_col: str = "logits") -> DataFrame:
    """Per row: score vector length equals the class count and every score is
    finite; bad rows get an error status instead of raising (A9)."""
    z = F.col(logits_col)
    finite = F.forall(z, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    status = (F.when(z.isNull(), "missing_scores")
              .when(F.size(z) != n_classes, "wrong_class_count")
              .when(~finite, "non_finite_scores")
              .otherwise("ok"))
    return df.withColumn("score_status", status)
