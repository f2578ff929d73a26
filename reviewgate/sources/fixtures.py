"""Record views over the driver's parquet tables (see FIXTURES.md section 2).

Each view is a projection of one table, so Catalyst prunes the parquet scan to
the columns used and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Class lists of the fixtures; position = class id.
LANG_CLASSES = ("en", "fr", "de", "es")
SOURCE_CLASSES = tuple(f"src{i}" for i in range(20))
PRIORITY_CLASSES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
RETURN_FLAG_CLASSES = ("A", "N", "R")
RETURN_FLAG_NAMES = ("accepted", "none", "returned")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narratives(spark: SparkSession, sf_dir: str, label: str = "lang") -> DataFrame:
    """documents as narrative records; label = lang (or source)."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.lpad(d.doc_id.cast("string"), 12, "0").alias("complaint_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (d.doc_id % 91).cast("int")).alias(
            "date_received"),
        d.source.alias("issue"),
        d[label].alias("label"),
        d.text.alias("text"),
    )


def orders_cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as dated class records; label = o_orderpriority."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.lpad(o.o_orderkey.cast("string"), 12, "0").alias("complaint_id"),
        o.o_orderdate.cast("date").alias("date_received"),
        o.o_orderstatus.alias("issue"),
        o.o_orderpriority.alias("label"),
    )


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with three-class logits of a synthetic model (two models: pred_b)."""
    l = table(spark, sf_dir, "lineitem")
    rid = F.md5(F.concat_ws(
        "|",
        l.l_orderkey.cast("string"), l.l_linenumber.cast("string"),
        l.l_partkey.cast("string"), l.l_suppkey.cast("string"),
        F.round(l.l_extendedprice * 100).cast("bigint").cast("string"),
        F.date_format(l.l_shipdate, "yyyy-MM-dd"),
    ))
    label_id = (F.when(l.l_returnflag == "A", 0).when(l.l_returnflag == "N", 1)
                .when(l.l_returnflag == "R", 2)).cast("int")
    u = ((l.l_orderkey * 31 + l.l_partkey * 17 + l.l_suppkey * 7 + l.l_linenumber * 3)
         % 1000) / 1000
    v = ((l.l_partkey * 13 + l.l_orderkey * 101 + l.l_linenumber * 37) % 1000) / 1000
    base = l.select(rid.alias("id"), label_id.alias("label_id"), u.alias("u"), v.alias("v"))
    pc = F.when(F.col("u") < F.lit(0.55) + F.lit(0.43) * F.col("v"), F.col("label_id")) \
        .otherwise((F.col("label_id") + 1) % 3)
    pb = F.when(F.col("u") < F.lit(0.60) + F.lit(0.40) * F.col("v"), F.col("label_id")) \
        .otherwise((F.col("label_id") + 1) % 3)
    m = F.lit(0.2) + F.lit(3.0) * F.col("v")
    logits = F.array(*[F.when(pc == k, m).otherwise(F.lit(0.0)) for k in range(3)])
    return base.select(
        "id", "label_id",
        logits.alias("logits"),
        pb.cast("int").alias("pred_b"),
        F.when(F.substring("id", 1, 2) < "80", "calibration").otherwise("test").alias("split"),
    )


def scored_vecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings: (vec_id, embedding ARRAY<FLOAT>, label INT)."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
