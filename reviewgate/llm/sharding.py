"""Sharding by fixed virtual slots. DataFrame functions only.

Records are hashed into a fixed number of virtual slots; bytes are summed per
slot; a versioned map says which shard holds a slot. Rebalancing edits the map:
it moves (or swaps) whole slots from the fullest to the emptiest shard and
leaves all others where they are. The map has as many rows as there are slots,
a constant, whatever the data; only it is ever on the driver.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

SLOTS = 8192
RECORD_OVERHEAD = 16
MAP = "version int, virtual_slot int, shard int"


def slot_map(spark: SparkSession, n_shards: int, n_slots: int = SLOTS) -> DataFrame:
    """Version 1: slots dealt round robin."""
    return spark.range(n_slots).select(F.lit(1).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
                                       (F.col("id") % n_shards).cast("int").alias("shard"))


def _edits(shards: list[dict[int, int]]) -> None:
    """Moves slots between the fullest and the emptiest shard while that narrows
    their gap; each step shrinks the sum of squared loads, so it ends."""
    loads = [sum(s.values()) for s in shards]
    while True:
        full, empty = loads.index(max(loads)), loads.index(min(loads))
        gap = loads[full] - loads[empty]
        give = sorted((size, slot) for slot, size in shards[full].items() if size)
        take = [(0, None)] + sorted((size, slot) for slot, size in shards[empty].items() if size)
        best = (gap, None, None)
        sizes = [g[0] for g in give]
        for size, slot in take:
            at = bisect_left(sizes, size + gap / 2)
            for k in (at - 1, at):
                if 0 <= k < len(give) and 0 < give[k][0] - size < gap:
                    best = min(best, (abs(gap - 2 * (give[k][0] - size)), give[k][1], slot),
                               key=lambda b: b[0])
        if best[1] is None:
            return
        _, out, back = best
        moved = shards[full].pop(out)
        shards[empty][out] = moved
        if back is not None:
            returned = shards[empty].pop(back)
            shards[full][back] = returned
            moved -= returned
        loads[full] -= moved
        loads[empty] += moved


def rebalance(current: DataFrame, slot_bytes: DataFrame, n_shards: int) -> DataFrame:
    """The next version of a map, edited until no move narrows the loads. Slots
    of shards that no longer exist go to the emptiest shards first."""
    spark = current.sparkSession
    rows = current.join(slot_bytes, "virtual_slot", "left") \
        .select("version", "virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes")).collect()
    shards: list[dict[int, int]] = [{} for _ in range(n_shards)]
    homeless = []
    for r in sorted(rows, key=lambda r: r.virtual_slot):
        if r.shard < n_shards:
            shards[r.shard][r.virtual_slot] = r.bytes
        else:
            homeless.append((r.bytes, r.virtual_slot))
    for size, slot in sorted(homeless, reverse=True):
        shards[min(range(n_shards), key=lambda k: sum(shards[k].values()))][slot] = size
    _edits(shards)
    version = max((r.version for r in rows), default=0) + 1
    return spark.createDataFrame([(version, slot, k) for k, s in enumerate(shards) for slot in s], MAP)


def shard_documents(docs: DataFrame, n_shards: int = 40, n_slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version``.

    The law is ``bytes``: shard sizes near equal. ``slot`` is the row's place in
    its shard, without gaps from 0. Null texts have no bytes, and texts of any length count
    whole. A record is hashed by doc_id, text checksum and size, so rows without id and
    rows sharing an id spread over the slots; rows equal in all three are told apart by
    their place in the stored table, so any number of them spreads too. An empty
    table gives no rows; columns besides ``doc_id`` and ``text`` are ignored."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + RECORD_OVERHEAD).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32")) \
        .withColumns({"record": F.xxhash64("doc_id", "text_crc32", "size"), "nth": F.monotonically_increasing_id()})
    rows = stored(rows, "shard-input")  # freezes the numbers
    alike = stored(rows.groupBy("record").agg(F.count(F.lit(1)).alias("alike")).where("alike > 1")
                   .select("record", "alike"), "shard-alike")
    key = F.when(F.col("alike").isNull(), F.col("record")).otherwise(F.xxhash64("record", "nth"))
    rows = stored(rows.join(alike, "record", "left").select(
        "doc_id", "size", "text_crc32", F.pmod(key, F.lit(n_slots)).cast("int").alias("virtual_slot")), "shard-records")
    slots = stored(rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")),
                   "shard-slots")
    first = stored(slot_map(spark, n_shards, n_slots), "shard-map")
    newest = stored(rebalance(first, slots.select("virtual_slot", "bytes"), n_shards), "shard-map")
    versions = first.unionByName(newest)
    latest = versions.where(F.col("version") == versions.agg(F.max("version")).first()[0])
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    places = latest.join(slots, "virtual_slot") \
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))) \
        .select("virtual_slot", "shard", "start", F.col("version").alias("map_version"))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("place", F.row_number().over(within) - 1) \
        .join(F.broadcast(places), "virtual_slot").select(  # at most n_slots rows
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
