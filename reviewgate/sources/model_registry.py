"""The registry of routable models: artifacts and label maps, checked together.

One row per model that occurs anywhere, with its temperature, policy and labels, and with
every violation found. A model is usable only where all of its artifacts are there once and
valid, and the model's own label list (where it has one) equals its label map. Routing joins
this table, so a model that fails a check can't route anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, StringType, StructField,
                               StructType)

from .validate import policy_values, stripped, validate_label_map, validate_policies

MSG_MISSING = "{kind} is missing."
MSG_REPEATED = "{kind} is given more than once."
MSG_NO_MAP = "label map is missing."
MSG_OUTPUTS = "The model output count does not match label_map.json."
MSG_OWN_LABELS = "The model config labels do not match label_map.json."
KINDS = ("temperature", "review_policy")

REGISTRY_SCHEMA = StructType([
    StructField("model", StringType()), StructField("temperature", DoubleType()),
    StructField("threshold", DoubleType()), StructField("target_met", BooleanType()),
    StructField("labels", ArrayType(StringType())), StructField("violations", ArrayType(StringType())),
    StructField("usable", BooleanType())])


def model_registry(artifacts: DataFrame, label_maps: DataFrame,
                   own_labels: DataFrame | None = None) -> DataFrame:
    """``model, temperature, threshold, target_met, labels, violations, usable``.

    ``artifacts``: ``model, kind, payload``; ``label_maps``: ``model, key, label``;
    ``own_labels``: ``model, own_labels`` (array, the model's labels by class id), or none.
    Rows without a model name belong to no model."""
    checked = validate_policies(policy_values(artifacts.where(F.col("model").isNotNull())))
    of = {k: F.col("kind") == k for k in KINDS}
    parts = checked.groupBy("model").agg(
        F.max(F.when(of["temperature"], F.col("temperature"))).alias("temperature"),
        F.max(F.when(of["review_policy"], F.col("threshold"))).alias("threshold"),
        F.max(F.when(of["review_policy"], F.col("target_met"))).alias("target_met"),
        *[F.count_if(of[k]).alias(f"n_{k}") for k in KINDS],
        F.array_distinct(F.flatten(F.array_sort(F.collect_list("violations")))).alias("found"))
    maps = label_maps.where(F.col("model").isNotNull())
    ids = F.col("key").try_cast("bigint")
    ordered = maps.groupBy("model").agg(F.transform(
        F.array_sort(F.collect_list(F.struct(ids.alias("id"), stripped(F.col("label")).alias("label")))),
        lambda x: x["label"]).alias("labels"))
    maps = validate_label_map(maps).select("model", F.col("violations").alias("map_found")).join(ordered, "model")
    out = parts.join(maps, "model", "full_outer")
    if own_labels is not None:
        out = out.join(own_labels.where(F.col("model").isNotNull()).groupBy("model").agg(
            F.min("own_labels").alias("own")), "model", "left")
    else:
        out = out.withColumn("own", F.lit(None).cast("array<string>"))
    found = [F.when(F.coalesce(F.col(f"n_{k}"), F.lit(0)) == 0, F.lit(MSG_MISSING.format(kind=k))) for k in KINDS]
    found += [F.when(F.col(f"n_{k}") > 1, F.lit(MSG_REPEATED.format(kind=k))) for k in KINDS]
    found += [F.when(F.col("labels").isNull(), F.lit(MSG_NO_MAP)),
              F.when(F.size("own") != F.size("labels"), F.lit(MSG_OUTPUTS))
              .when(F.transform("own", stripped) != F.col("labels"), F.lit(MSG_OWN_LABELS))]
    empty = F.array().cast("array<string>")
    out = out.withColumn("violations", F.concat(
        F.coalesce("found", empty), F.coalesce("map_found", empty),
        F.filter(F.array(*found), lambda m: m.isNotNull())))
    return out.select("model", "temperature", "threshold", "target_met", "labels", "violations",
                      (F.size("violations") == 0).alias("usable"))


def frozen_registry(registry: DataFrame, max_models: int = 10_000) -> DataFrame:
    """The registry as rows that plans carry themselves: read once, never computed again, not
    even by each micro-batch of a stream. For at most ``max_models`` models; more raise, and
    are to be joined as a stored table instead."""
    rows = registry.limit(max_models + 1).collect()
    if len(rows) > max_models:
        raise ValueError(f"more than {max_models} models: join the stored registry instead")
    return registry.sparkSession.createDataFrame([tuple(r) for r in rows], REGISTRY_SCHEMA)
