"""Benchmark items inside documents, by size-partitioned MinHash containment.

An item is found in a document when at least ``containment`` of its distinct
five-word shingles occur there. Items are partitioned by their number n of
shingles into classes of doubling size. A class keeps of each item the k
smallest shingle hashes (its bottom-k MinHash sketch), with k chosen from the
largest size in the class: a document that contains the item misses at most
floor((1 - containment) * n) of its shingles, so it must hit the remaining
sketch values. The sketch is far smaller than the item, no contained item is
ever missed, and the length of the document doesn't matter. Candidates are
verified on the shingles themselves, as text.

Sketches are made in tasks. The documents are read once, whatever the size of
the benchmark: each keeps the shingles whose hash has its bit set in a filter of
all item shingles. The filter has a fixed number of bits, so it is the only
thing sent to every task and never grows; a larger benchmark lets more foreign
shingles through, which the joins then drop. Candidates and their check are
joins over what was kept; document texts are never shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .words import _FOLD, shingles, word_table

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Bits of the filter, as a power of two: 16 MB.
FILTER_BITS = 27
_ROWS = 1 << 15

_ITEM = "item_key string, n long, needed long, shingle binary, hash long, sketched boolean"
_KEPT = "doc_row long, doc_id long, text_hash long, shingle binary, hash long"


def fold(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def shingles_at(folded: bytes, starts, ends, places, size: int) -> list[bytes]:
    """The shingles that begin at the given words, as text."""
    words = folded.translate(_FOLD)
    return [b" ".join(words[a:b] for a, b in zip(starts[i:i + size].tolist(), ends[i:i + size].tolist()))
            for i in places]


def may_miss(n: int, containment: float) -> int:
    return n - at_least(n, containment)


def at_least(n: int, containment: float) -> int:
    return math.ceil(round(containment * n, 9))


def item_sketch(text: str | None, size: int = SHINGLE_WORDS, containment: float = CONTAINMENT):
    """(distinct shingles as a dict to their hashes, sketch values, hits needed)."""
    folded = fold(text)
    starts, ends, words = word_table(folded)
    hashes = shingles(words, size)
    own = dict(zip(shingles_at(folded, starts, ends, range(len(hashes)), size), hashes.tolist()))
    n = len(own)
    if not n:
        return own, [], 0
    largest = 1 << n.bit_length()  # sizes of a class: largest / 2 to largest - 1
    values = sorted(set(own.values()))[:min(n, may_miss(largest - 1, containment) + 1)]
    return own, values, len(values) - may_miss(n, containment)


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _item_rows(size: int, containment: float):
    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                own, values, needed = item_sketch(text.as_py(), size, containment)
                sketch, rows, n = set(values), list(own.items()), len(own)
                for at in range(0, n, _ROWS):
                    part = rows[at:at + _ROWS]
                    m = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()] * m, pa.string()), pa.array([n] * m, pa.int64()),
                         pa.array([needed] * m, pa.int64()), pa.array([s for s, _ in part], pa.binary()),
                         _signed([h for _, h in part]), pa.array([h in sketch for _, h in part], pa.bool_())],
                        ["item_key", "n", "needed", "shingle", "hash", "sketched"])

    return run


def _filter_of(item_shingles: DataFrame, bits: int) -> np.ndarray:
    """The filter as 64-bit words; Spark folds the hashes into at most
    2 ** (bits - 6) of them before they are fetched."""
    place = F.shiftrightunsigned("hash", 64 - bits)
    words = item_shingles.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 AS int))")).alias("set"))
    out = np.zeros(1 << (bits - 6), np.int64)
    fetched = words.toArrow()
    out[fetched.column("word").to_numpy()] = fetched.column("set").to_numpy()
    return out.view(np.uint64)


def _kept_shingles(held, bits: int, size: int):
    """Distinct shingles of each document that the filter lets through."""
    def run(batches):
        for batch in batches:
            for row, doc_id, text_hash, text in zip(*batch.columns):
                if not text.is_valid:
                    continue
                folded = fold(text.as_py())
                starts, ends, words = word_table(folded)
                hashes = shingles(words, size)
                place = hashes >> np.uint64(64 - bits)
                found = held.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)
                at = np.flatnonzero(found)
                own = dict(zip(shingles_at(folded, starts, ends, at.tolist(), size), hashes[at].tolist()))
                rows = list(own.items())
                for k in range(0, len(rows), _ROWS):
                    part = rows[k:k + _ROWS]
                    m = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row.as_py()] * m, pa.int64()), pa.array([doc_id.as_py()] * m, pa.int64()),
                         pa.array([text_hash.as_py()] * m, pa.int64()),
                         pa.array([s for s, _ in part], pa.binary()), _signed([h for _, h in part])],
                        ["doc_row", "doc_id", "text_hash", "shingle", "hash"])

    return run


def _id(df: DataFrame) -> Column:
    return df["doc_id"].cast("long")


def _text_hash(df: DataFrame) -> Column:
    return F.xxhash64(df["text"])


def _contained(docs: DataFrame, items: DataFrame, size: int, containment: float) -> DataFrame:
    """``doc_row, doc_id, text_hash, item_key, n, shared`` for every document
    row and distinct item text that it contains."""
    spark = docs.sparkSession
    texts = items.select(_item_key(items).alias("item_key"), "text").groupBy("item_key").agg(
        F.first("text").alias("text"))
    rows = stored(texts.mapInArrow(_item_rows(size, containment), _ITEM), "benchmark-shingles")
    held = spark.sparkContext.broadcast(_filter_of(rows, FILTER_BITS))
    narrow = docs.select(F.monotonically_increasing_id().alias("doc_row"), _id(docs).alias("doc_id"),
                         _text_hash(docs).alias("text_hash"), docs["text"].alias("text"))
    kept = stored(narrow.mapInArrow(_kept_shingles(held, FILTER_BITS, size), _KEPT), "benchmark-kept")
    sketches = rows.where("sketched").select("hash", "item_key", "needed")
    candidates = kept.select("doc_row", "hash").join(sketches, "hash").groupBy("doc_row", "item_key").agg(
        F.count(F.lit(1)).alias("hits"), F.max("needed").alias("needed")) \
        .where("hits >= needed").select("doc_row", "item_key")
    wanted = candidates.join(rows.select("item_key", "n", "shingle"), "item_key")
    shared = wanted.join(kept.drop("hash"), ["doc_row", "shingle"]) \
        .groupBy("doc_row", "doc_id", "text_hash", "item_key", "n").agg(F.count(F.lit(1)).alias("shared"))
    return shared.where(F.col("shared") >= F.ceil(F.round(F.lit(float(containment)) * F.col("n"), 9)))


def _item_key(items: DataFrame) -> Column:
    """Digest of the text: equal items are searched for once."""
    return F.sha2(F.coalesce(items["text"], F.lit("")).cast("binary"), 256)


def benchmark_hits(docs: DataFrame, items: DataFrame, size: int = SHINGLE_WORDS,
                   containment: float = CONTAINMENT) -> DataFrame:
    """``doc_id, item_id, item_shingles, shared_shingles, containment``: a row
    for every document row and item row where the item is contained.

    Words are runs of ASCII letters, digits and other characters, lower-cased;
    fewer than ``size`` words make one shingle. Null, empty and wordless texts
    and items match nothing. Repeated rows of either table each give their row;
    null ids are passed through. Texts may be of any length: one text at a time
    is held. An empty table gives no rows; other columns are ignored."""
    named = items.select(_item_key(items).alias("item_key"), items["item_id"].cast("long").alias("item_id"))
    return _contained(docs, items, size, containment).join(named, "item_key").select(
        "doc_id", "item_id", F.col("n").alias("item_shingles"), F.col("shared").alias("shared_shingles"),
        (F.col("shared").cast("double") / F.col("n")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = SHINGLE_WORDS,
                      containment: float = CONTAINMENT) -> DataFrame:
    """The documents in which no item is contained, all columns kept.

    Rows that agree in id and text go or stay together. The ids that go are
    joined by Spark's own threshold: sent to the tasks while they are few, by
    shuffle beyond it."""
    hit = stored(_contained(docs, items, size, containment).select("doc_id", "text_hash").distinct(),
                 "benchmark-hit")
    return docs.join(hit, _id(docs).eqNullSafe(hit["doc_id"]) & (_text_hash(docs) == hit["text_hash"]), "left_anti")
