"""Removal of every byte covered by a repeated fixed-length string.

After bucket-pointer refinement, on the window starts ("suffixes") of all texts. The
classical form keeps one bucket pointer per byte and sorts all suffixes. Here
a suffix only takes part while its bucket still holds a second, different
member, and bucket pointers are content digests, so no global rank table is
needed:

1. *Initial q-gram buckets.* Every window of ``length`` bytes contains at least
   one full run of q-grams; the q-gram with the smallest hash in it (leftmost
   when equal) is the window's pivot. Equal windows have equal pivots at equal
   offsets. Neighbouring windows with one pivot form a node, about one node for
   85 bytes of text, and the pivot's q-gram is the node's bucket.
2. *Refinement.* A bucket with one node is final: nothing in it repeats. Nodes
   of one bucket whose whole span is equal repeat entirely, and one of them
   goes on for all. Buckets that hold different spans are refined by fresh
   digests, not by the buckets of later offsets: the node is cut on a grid of
   offsets counted from its pivot, and the digest of the piece common to all
   windows of a cell is the cell's bucket.
3. The same step is used again, on what the step before left open, with cells
   of one window, where bucket and span coincide.

All counts are aggregates and all lookups are equi-joins, which Spark splits
when a key is hot; no bucket is ever gathered in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, doc_key, stored

QGRAM = 32
CELL = 16
_CHUNK = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0x00000000FFFFFFFF)

_NODE = ("key_id long, key_hash long, pivot long, first long, last long, "
         "bucket long, span long")


def _qgram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q bytes from each position; q is a power of two."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(_MULTIPLIER)
    h ^= h >> np.uint64(29)
    k = 1
    while k < q:
        h = h[:-k] * np.uint64(pow(_BASE, k, 1 << 64)) + h[k:]
        k *= 2
    h *= np.uint64(_MULTIPLIER)
    h ^= h >> np.uint64(32)
    h *= np.uint64(_BASE)
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        values = np.minimum(values[:-k], values[k:])
        k *= 2
    rest = width - k
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def pivot_nodes(text: bytes, length: int, q: int = QGRAM):
    """(pivot, first, last, bucket) arrays: maximal runs of window starts that
    share a pivot. Long texts go through in overlapping pieces."""
    found = []
    n_windows = len(text) - length + 1
    for start in range(0, max(0, n_windows), _CHUNK):
        data = np.frombuffer(text, np.uint8, min(len(text) - start, _CHUNK + length - 1), start)
        h = _qgram_hashes(data, q)
        ranked = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
        pivot = (_sliding_min(ranked, length - q + 1) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], pivot[1:] != pivot[:-1])))
        last = np.append(first[1:], len(pivot)) - 1
        at = pivot[first]
        found.append((at + start, first + start, last + start, h[at].view(np.int64)))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


def _digest(pieces) -> np.ndarray:
    joined = b"".join(pieces)
    return np.frombuffer(joined, dtype=">i8").astype(np.int64)


def _span_digests(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    xxh = xxhash.xxh3_64_digest
    return _digest([xxh(text[a:b]) for a, b in zip(starts.tolist(), ends.tolist())])


def _node_batch(parts: list[tuple]) -> pa.RecordBatch:
    names = ["key_id", "key_hash", "pivot", "first", "last", "bucket", "span"]
    cols = [np.concatenate(x) if parts else np.empty(0, np.int64)
            for x in (zip(*parts) if parts else [()] * 7)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def _initial_nodes(length: int):
    def run(batches):
        for batch in batches:
            ids, hashes, texts = (batch.column(i) for i in range(3))
            parts = []
            for key_id, key_hash, text in zip(ids.to_pylist(), hashes.to_pylist(), texts):
                text = text.as_py()
                if len(text) < length:
                    continue
                pivot, first, last, bucket = pivot_nodes(text, length)
                k = len(pivot)
                parts.append((np.full(k, key_id), np.full(k, key_hash), pivot, first, last, bucket,
                              _span_digests(text, first, last + length)))
            yield _node_batch(parts)

    return run


def _cells(pivot, first, last, size):
    """Cuts each node on the grid of pivot offsets; returns (row, cell, first, last)."""
    low, high = (pivot - last) // size, (pivot - first) // size
    counts = high - low + 1
    row = np.repeat(np.arange(len(pivot)), counts)
    cell = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[row]
    return (row, cell, np.maximum(first[row], pivot[row] - size * cell - size + 1),
            np.minimum(last[row], pivot[row] - size * cell))


def _refined_nodes(length: int, size: int):
    def run(batches):
        for batch in batches:
            parts = []
            for key_id, key_hash, text, nodes in zip(*(batch.column(i) for i in range(4))):
                text = text.as_py()
                nodes = nodes.values
                pivot, first, last = (nodes.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                row, cell, lo, hi = _cells(pivot, first, last, size)
                at, k = pivot[row], len(row)
                span = _span_digests(text, lo, hi + length)
                core = at - size * cell
                bucket = span if size == 1 else _span_digests(text, core, core - size + 1 + length)
                parts.append((np.full(k, key_id.as_py()), np.full(k, key_hash.as_py()), at, lo, hi,
                              bucket, span))
            yield _node_batch(parts)

    return run


def _counted(nodes: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row. Stored before it is joined, so that both
    sides of the join come from plain exchanges and a hot key can be split."""
    return nodes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)


def _settle(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """One refinement step: (window runs that repeat, nodes still open)."""
    shared = stored(_counted(nodes, "bucket"), f"{name}-shared")
    live = stored(nodes.join(shared, "bucket", "left_semi"), f"{name}-live")
    spans = stored(
        live.groupBy("bucket", "span").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("key_id", "key_hash", "pivot", "first", "last")).alias("one")),
        f"{name}-spans")
    repeats = live.join(spans.where("n > 1").select("bucket", "span"), ["bucket", "span"], "left_semi")
    mixed = stored(_counted(spans, "bucket"), f"{name}-mixed")
    still_open = spans.join(mixed, "bucket", "left_semi").select("one.*")
    return repeats.select("key_id", "key_hash", "first", "last"), still_open


def _per_document(nodes: DataFrame, *cols: str) -> DataFrame:
    return nodes.groupBy("key_id", "key_hash").agg(F.collect_list(F.struct(*cols)).alias("nodes"))


def repeated_windows(docs: DataFrame, length: int = 200) -> DataFrame:
    """``key_id, key_hash, first, last``: runs of start positions whose
    ``length``-byte string also starts somewhere else in the corpus.

    ``docs`` has ``key_id, key_hash, body`` (see ``common.doc_key``)."""
    if length < 2 * QGRAM:
        raise ValueError(f"length must be at least {2 * QGRAM}")
    nodes = stored(docs.mapInArrow(_initial_nodes(length), _NODE), "suffix-pivots")
    repeats, still_open = _settle(nodes, "suffix-pivots")
    found = [stored(repeats, "suffix-repeats")]
    for size in (CELL, 1):
        refined = docs.join(_per_document(still_open, "pivot", "first", "last"),
                            ["key_id", "key_hash"]) \
            .select("key_id", "key_hash", "body", "nodes") \
            .mapInArrow(_refined_nodes(length, size), _NODE)
        nodes = stored(refined, f"suffix-cells-{size}")
        if size == 1:
            equal = stored(_counted(nodes, "span"), "suffix-equal")
            repeats = nodes.join(equal, "span", "left_semi") \
                .select("key_id", "key_hash", "first", "last")
        else:
            repeats, still_open = _settle(nodes, f"suffix-cells-{size}")
        found.append(stored(repeats, "suffix-repeats"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _cut(length: int):
    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, nodes in zip(*(batch.column(i) for i in range(3))):
                text = text.as_py()
                removed = np.empty((0, 2), np.int64)
                if nodes.is_valid:
                    nodes = nodes.values
                    first, last = (nodes.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                    order = np.argsort(first, kind="stable")
                    first, reach = first[order], np.maximum.accumulate(last[order] + length)
                    new = np.flatnonzero(np.append(True, first[1:] > reach[:-1]))
                    removed = np.stack([first[new], reach[np.append(new[1:], len(reach)) - 1]], axis=1)
                kept, at = [], 0
                for a, b in removed.tolist():
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                kept = b"".join(kept)
                out.append((doc_id.as_py(), len(text), len(text) - len(kept), len(removed),
                            hashlib.sha256(kept).hexdigest(), kept, removed.tolist()))
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
                 pa.array(cols[4], pa.string()), pa.array(cols[5], pa.binary()),
                 pa.array(cols[6], pa.list_(pa.list_(pa.int64())))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    return run


def suffix_dedup(docs: DataFrame, length: int = 200) -> DataFrame:
    """Cuts every byte that lies in a ``length``-byte string occurring twice.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans``,
    one row per input row; ``spans`` are the removed ``[start, end)`` byte
    ranges of the input and ``kept`` the remaining bytes (a cut may fall inside
    a multi-byte character).

    Null texts count as empty; texts under ``length`` bytes are untouched; rows
    that are equal in id and text repeat each other like any other copies; a
    null ``doc_id`` is passed through; an empty table gives no rows; columns
    besides ``doc_id`` and ``text`` are ignored."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *doc_key(), body().alias("body"))
    runs = repeated_windows(keyed.select("key_id", "key_hash", "body"), length)
    return keyed.join(_per_document(runs, "first", "last"), ["key_id", "key_hash"], "left") \
        .select("doc_id", "body", "nodes") \
        .mapInArrow(_cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                  "kept_sha256 string, kept binary, spans array<array<long>>")
