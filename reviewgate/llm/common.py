"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_NO_ID = -(1 << 63)
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str):
    """Sets a session setting for the block and puts back what was there."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet under the shared checkpoint folder and reads it
    back: lineage ends at files that every executor can reach, so a lost
    executor costs only its running tasks. The shuffles behind the table are
    released as soon as it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with session_setting(spark, _SHUFFLE_CLEANUP, "true"), \
            session_setting(spark, "spark.sql.parquet.compression.codec", "zstd"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def body(text: Column | str = "text") -> Column:
    """A text as UTF-8 bytes; null counts as empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col, F.lit("")).cast("binary")


def doc_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two null-free columns ``key_id, key_hash`` that name a document row.

    Rows that agree in id and text share a key (they are the same document);
    rows that share an id but not the text, or have no id, do not."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("key_id"),
            F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(doc_id).isNull()).alias("key_hash")]
