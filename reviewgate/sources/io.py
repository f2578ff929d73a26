"""Readers and writers: narrative CSV, split JSON lines, split sink, content
fingerprint and manifest (A1, A3-A6, A10)."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..operators.prepare import dedup_stats
from .export_blocks import BLOCK_BYTES, blocks_of, export_records, files_of, has_compressed

RECORD_SCHEMA = StructType([
    StructField("complaint_id", StringType()),
    StructField("date_received", DateType()),
    StructField("issue", StringType()),
    StructField("label", StringType()),
    StructField("text", StringType()),
])


def split_counts(splits: DataFrame) -> DataFrame:
    """Row counts per (split, label) with split totals and the grand total."""
    g = splits.rollup("split", "label").agg(
        F.count(F.lit(1)).alias("count"),
        F.grouping("split").alias("_gs"), F.grouping("label").alias("_gl"))
    return g.select(
        F.when(F.col("_gs") == 1, "__all__").otherwise(F.col("split")).alias("split"),
        F.when(F.col("_gl") == 1, "__all__").otherwise(F.col("label")).alias("label"),
        "count")


# Column names of the public complaint export (CSV header, fixed values).
EXPORT_ID = "Complaint ID"
EXPORT_DATE = "Date received"
EXPORT_PRODUCT = "Product"
EXPORT_ISSUE = "Issue"
EXPORT_NARRATIVE = "Consumer complaint narrative"

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "encoding": "UTF-8"}


def write_export_csv(records: DataFrame, path: str) -> None:
    """Write records in the export layout (used to land test exports)."""
    out = records.select(
        F.col("complaint_id").alias(EXPORT_ID),
        F.date_format("date_received", "yyyy-MM-dd").alias(EXPORT_DATE),
        F.col("label").alias(EXPORT_PRODUCT),
        F.col("issue").alias(EXPORT_ISSUE),
        F.col("text").alias(EXPORT_NARRATIVE))
    (out.write.mode("overwrite").options(**CSV_OPTIONS)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def read_narratives_csv(spark: SparkSession, path: str, products=None,
                        block_bytes: int | None = BLOCK_BYTES) -> DataFrame:
    """Header CSV export -> 5-field records (A1). Quoted line feeds are kept. A
    file is read by one task for every ``block_bytes``, cut at true record ends
    (``export_blocks``), for which quotes must be balanced and the path one that
    pyarrow opens too; line ends inside quotes stay as written. With None, and
    for compressed files, each file is one task, and Spark writes the line ends
    of a CRLF file as line feeds. All files have the columns of the first. A UTF-8 byte-order mark on
    the first header is dropped; rows of other products and rows without a
    narrative are skipped. A date that is not yyyy-MM-dd becomes null and its
    row stays, so one bad row never ends the read."""
    whole = spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path)
    names = [c.lstrip("\ufeff") for c in whole.columns]
    files = files_of(spark, path)
    if block_bytes is None or has_compressed(files):
        raw = whole.toDF(*names)
    else:
        schema = ", ".join(f"c{i} string" for i in range(len(names)))
        fields = F.from_csv("record", schema, CSV_OPTIONS)
        raw = export_records(blocks_of(files, block_bytes)).select(fields.alias("f")).select("f.*").toDF(*names)
    out = raw.select(
        F.col(EXPORT_ID).cast("string").alias("complaint_id"),
        F.try_to_date(F.col(EXPORT_DATE), "yyyy-MM-dd").alias("date_received"),
        F.col(EXPORT_ISSUE).alias("issue"),
        F.col(EXPORT_PRODUCT).alias("label"),
        F.col(EXPORT_NARRATIVE).alias("text"))
    keep = F.col("text").isNotNull() & (F.col("text") != "")
    if products is not None:
        keep = keep & F.col("label").isin(list(products))
    return out.where(keep)


def write_jsonl(records: DataFrame, path: str, partition_by: str | None = None) -> None:
    """JSON lines with keys in sorted order, non-ASCII kept (A4)."""
    cols = sorted(records.columns)
    w = records.select(*cols).write.mode("overwrite").option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType = RECORD_SCHEMA) -> DataFrame:
    """JSON lines with an explicit schema; blank lines are skipped (A3). A line
    that is not JSON of this schema ends the read with an error, never as an
    empty record."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def row_digest(df: DataFrame, columns) -> F.Column:
    """SHA-256 of the row's fields joined by U+001F, dates as yyyy-MM-dd,
    nulls as empty text."""
    parts = []
    for c in columns:
        dt = df.schema[c].dataType
        v = F.date_format(F.col(c), "yyyy-MM-dd") if isinstance(dt, DateType) \
            else F.col(c).cast("string")
        parts.append(F.coalesce(v, F.lit("")))
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def content_fingerprint(df: DataFrame, columns=None, group_col: str = "split",
                        depth: int = 4) -> DataFrame:
    """Order- and partitioning-independent SHA-256 per group (A5).

    Row digests are counted per distinct digest (so repeated rows never pile
    up in one list), bucketed by their first ``depth`` hex digits (part of
    the definition, whatever the number of rows), hashed per bucket, and
    folded up a 16-way tree of hex prefixes to one digest per group. Every
    level is a small grouped aggregate. Not equal to a hash of file bytes."""
    cols = sorted(columns or [c for c in df.columns if c != group_col])
    d = df.select(F.col(group_col).alias("g"), row_digest(df, cols).alias("d"))
    cnt = d.groupBy("g", "d").agg(F.count(F.lit(1)).alias("c"))
    level = cnt.groupBy("g", F.substring("d", 1, depth).alias("p")).agg(
        F.sha2(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("d", "c"))),
            lambda s: F.concat(s["d"], F.lit(":"), s["c"].cast("string"))), ","), 256).alias("h"))
    for width in range(depth - 1, -1, -1):
        level = level.groupBy("g", F.substring("p", 1, width).alias("q")).agg(
            F.sha2(F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct("p", "h"))),
                lambda s: F.concat(s["p"], F.lit("="), s["h"])), ","), 256).alias("h2")) \
            .select("g", F.col("q").alias("p"), F.col("h2").alias("h"))
    counts = df.groupBy(F.col(group_col).alias("g")).agg(F.count(F.lit(1)).alias("count"))
    return level.join(counts, "g").select(F.col("g").alias(group_col),
                                          F.col("h").alias("content_digest"), "count")


def split_manifest(source: DataFrame, splits: DataFrame, columns=None) -> DataFrame:
    """One row that states a preparation run (A6): rows of the source by label,
    the deduplication counters, and per split its rows by label and its content
    digest over ``columns``. All lists are bounded by splits and labels; it
    holds no text and no ids. Serialise with ``to_json``; an empty source gives
    zero counters and empty lists."""
    stats = dedup_stats(source)
    stats = stats.select(F.struct(*[
        F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in stats.columns]).alias("deduplication"))
    by_label = source.groupBy("label").count()
    labels = splits.groupBy("split", "label").count().groupBy("split").agg(
        F.array_sort(F.collect_list(F.struct("label", "count"))).alias("labels"))
    parts = content_fingerprint(splits, columns).join(labels, "split")
    return stats.crossJoin(by_label.agg(
        F.array_sort(F.collect_list(F.struct("label", "count"))).alias("source_counts"))).crossJoin(
        parts.agg(F.array_sort(F.collect_list(
            F.struct("split", "count", "content_digest", "labels"))).alias("splits")))  # one row each
