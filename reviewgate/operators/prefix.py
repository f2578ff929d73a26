"""Ranks and running sums in a total order without a single-partition window.

``Window.orderBy`` without ``partitionBy`` moves every row to one task, and
``partitionBy(class)`` makes one task per class, so one big class is one task.
Here the order key itself is range-partitioned (Spark samples it and splits hot
groups across many tasks); each task numbers its rows locally, the positions
are frozen with a reliable checkpoint, and a small per-(task, group) table of
counts supplies the offsets. That table has at most
``partitions + groups - 1`` rows, because each task holds one contiguous key
range; it is broadcast only below a checked row bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import checkpoint_dir

BROADCAST_ROW_LIMIT = 1_000_000
_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | row-in-partition


def _default_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _local_prefix_fn(sum_cols: list[str]):
    """Numbers a task's rows and adds the exclusive running sums; the columns
    that pass through stay the Arrow arrays they were."""
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        pos = 0
        carry = {c: 0 for c in sum_cols}
        for batch in batches:
            k = batch.num_rows
            added = {"_part": np.full(k, part, dtype=np.int64),
                     "_pos": np.arange(pos, pos + k, dtype=np.int64)}
            for c in sum_cols:
                vals = batch.column(c).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                added[f"_pre_{c}"] = np.cumsum(vals) - vals + carry[c]
                carry[c] += int(vals.sum())
            pos += k
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v, pa.int64()) for v in added.values())],
                [*batch.schema.names, *added])

    return run


def ordered_positions(df: DataFrame, order: list[Column], partition_by: list[str] = (),
                      sums: list[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Adds ``rank`` (1-based position in ``order`` within ``partition_by``),
    ``group_count``, and for each integer column ``s`` in ``sums`` the inclusive
    running sum ``cum_<s>`` and group total ``total_<s>``.

    ``order`` must end in a unique key; ties are otherwise broken arbitrarily.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    partition_by = list(partition_by)
    sums = list(sums)
    keys = [F.col(c) for c in partition_by] + list(order)
    # The range partitioner samples its input in a separate job; cache the
    # input so that job and the real one share one evaluation of the
    # upstream plan. (A lost cache block is recomputed; the positions are
    # frozen by the reliable checkpoint below either way.)
    source = df.persist(StorageLevel.MEMORY_AND_DISK)
    n = num_partitions or _default_partitions(df)
    ranged = source.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    if sums:
        fields = list(df.schema.fields) + [StructField("_part", LongType()),
                                           StructField("_pos", LongType())]
        fields += [StructField(f"_pre_{c}", LongType()) for c in sums]
        ranged = ranged.mapInArrow(_local_prefix_fn(sums), StructType(fields))
    else:
        mid = F.monotonically_increasing_id()
        ranged = ranged.withColumn("_mid", mid).select(
            *df.columns,
            F.shiftright(F.col("_mid"), _POS_BITS).alias("_part"),
            F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"),
        )
    # Freeze partition ids and positions: range bounds are sampled per job, so
    # both uses below must read the same materialised rows.
    ranged = ranged.checkpoint(eager=True)
    source.unpersist()

    aggs = [F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")]
    for c in sums:
        aggs += [F.min_by(f"_pre_{c}", "_pos").alias(f"_base_{c}"),
                 F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0))).alias(f"_tot_{c}")]
    stats = ranged.groupBy("_part", *partition_by).agg(*aggs)
    w = Window.partitionBy(*partition_by).orderBy("_part") if partition_by \
        else Window.orderBy("_part")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = [F.col("_part").alias("_s_part")]
    cols += [F.col(c).alias(f"_s_{c}") for c in partition_by]
    cols += [F.col("_first"),
             F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
             F.sum("_cnt").over(whole).alias("group_count")]
    for c in sums:
        cols += [F.col(f"_base_{c}"),
                 F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}"),
                 F.sum(f"_tot_{c}").over(whole).alias(f"total_{c}")]
    stats = stats.select(*cols)
    stat_rows = stats.count()
    if stat_rows <= BROADCAST_ROW_LIMIT:
        stats = F.broadcast(stats)
    cond = [ranged["_part"] == stats["_s_part"]]
    cond += [ranged[c].eqNullSafe(stats[f"_s_{c}"]) for c in partition_by]
    joined = ranged.join(stats, cond, "inner")
    out = [F.col(c) for c in df.columns]
    out += [(F.col("_off") + F.col("_pos") - F.col("_first") + 1).alias("rank"),
            F.col("group_count")]
    for c in sums:
        out += [(F.col(f"_off_{c}") + F.col(f"_pre_{c}") - F.col(f"_base_{c}")
                 + F.coalesce(F.col(c).cast("long"), F.lit(0))).alias(f"cum_{c}"),
                F.col(f"total_{c}")]
    return joined.select(*out)
