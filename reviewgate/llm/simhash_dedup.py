"""SimHash near-duplicate groups by a binary-trie self-join.

Fingerprints within ``max_bits`` differing bits are linked; documents that are
linked directly or through others form a component.

The 64 bits are cut into ``max_bits + 3`` blocks. Two fingerprints that differ in
at most ``max_bits`` bits agree on at least three whole blocks, so all links
lie inside the sub-tries below a choice of three equal blocks: a key for
each of the 35 choices (for four bits). Every task walks the sub-tries it was
dealt: pairs of trie nodes go down together, their differing bits add up, and
a pair over the budget is dropped with everything below it.

Only distinct fingerprints take part, so copies cost nothing, and a task sends
on links that connect what it has, not all pairs. A sub-trie with more than
``max_subtrie`` distinct fingerprints is cut the same way once more on the bits
its key leaves open, which multiplies only that sub-trie.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, doc_key, stored
from .components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
_SEED = 42
_FRONTIER = 1 << 19


def shingle_hashes(text: bytes, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each word shingle, repeats included. ``bytes.lower`` touches A-Z
    only and ``bytes.split`` cuts at exactly 0x20 and 0x09-0x0D."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    n = len(words) - shingle_words + 1
    if n <= 1:
        return np.array([xxhash.xxh64_intdigest(line, _SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
    xxh = xxhash.xxh64_intdigest
    return np.array([xxh(line[a:b], _SEED) for a, b in zip(starts, ends[shingle_words - 1:].tolist())],
                    np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half of the hashes."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        votes += np.unpackbits(hashes[k:k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8),
                               axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def _fingerprint_udf(shingle_words: int):
    @F.pandas_udf("long")
    def fingerprint(texts):
        import pandas as pd
        values = [majority_bits(shingle_hashes(t, shingle_words)) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    return fingerprint


def _blocks(bits: list[int], n: int) -> list[int]:
    """Masks that cut the given bit positions into n nearly equal blocks."""
    return [sum(1 << int(b) for b in part) for part in np.array_split(np.array(bits), n)]


def key_masks(max_bits: int, equal: int = 3, bits: list[int] | None = None) -> list[int]:
    """Masks of which any two values within ``max_bits`` bits agree on at least one."""
    bits = list(range(64)) if bits is None else bits
    blocks = _blocks(bits, max_bits + equal)
    return [sum(chosen) for chosen in combinations(blocks, equal)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    keys = [F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
            for i, m in enumerate(masks)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")) \
        .select("fp", F.xxhash64("k.mask", "k.part").alias("trie"), "k.mask")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def trie_links(groups: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within ``max_bits`` bits inside each group.

    Rows are sorted by (group, fp), so a trie node is a range of rows. Returns
    index pairs: a star for each connected set."""
    n = len(fps)
    label = np.arange(n)

    def root(of: np.ndarray) -> np.ndarray:
        while True:
            up = label[of]
            if (up == of).all():
                return of
            label[of] = label[up]
            of = up

    def unite(a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = root(a), root(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))

    def split(lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
        """First row of each range whose bit at this depth is set."""
        bit = np.uint64(63 - depth)
        left, right = lo.copy(), hi.copy()
        while (busy := left < right).any():
            mid = (left + right) >> 1
            one = busy & ((fps[np.minimum(mid, n - 1)] >> bit & np.uint64(1)) == 1)
            right = np.where(one, mid, right)
            left = np.where(busy & ~one, mid + 1, left)
        return left

    starts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1]))) if n else np.empty(0, int)
    ends = np.append(starts[1:], n)
    many = ends - starts > 1
    starts, ends = starts[many], ends[many]
    stack = [(0, np.stack([starts, ends, starts, ends, np.zeros(len(starts), np.int64)]))] \
        if len(starts) else []
    while stack:
        depth, pairs = stack.pop()
        if pairs.shape[1] > _FRONTIER:
            half = pairs.shape[1] // 2
            stack += [(depth, pairs[:, :half]), (depth, pairs[:, half:])]
            continue
        a0, a1, b0, b1, used = pairs
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        x, y = a0[single], b0[single]
        near = (x != y) & (_popcount(fps[x] ^ fps[y]) <= max_bits)
        unite(x[near], y[near])
        a0, a1, b0, b1, used = pairs[:, ~single]
        if not len(a0) or depth == 64:
            continue
        a, b = split(a0, a1, depth), split(b0, b1, depth)
        same = a0 == b0
        children = [np.stack([a0, a, b0, b, used]), np.stack([a, a1, b, b1, used]),
                    np.stack([a0, a, b, b1, used + 1]),
                    np.stack([a, a1, b0, b, used + 1])[:, ~same]]
        down = np.concatenate(children, axis=1)
        down = down[:, (down[0] < down[1]) & (down[2] < down[3]) & (down[4] <= max_bits)]
        down = down[:, ~((down[0] == down[2]) & (down[1] - down[0] == 1))]
        if down.shape[1]:
            stack.append((depth + 1, down))
    top = root(np.arange(n))
    child = np.flatnonzero(top != np.arange(n))
    return child, top[child]


def _walk(max_bits: int):
    def links(tries: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = trie_links(tries, fps.view(np.uint64), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], ["a", "b"])

    def run(batches):
        # rows come sorted by (trie, fp); a trie may span batches
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            tries, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            if not len(tries):
                continue
            cut = int(np.searchsorted(tries, tries[-1]))
            if cut:
                held.append((tries[:cut], fps[:cut]))
                t, f = (np.concatenate(x) for x in zip(*held))
                yield links(t, f.astype(np.int64))
                held = []
            held.append((tries[cut:], fps[cut:]))
        if held:
            t, f = (np.concatenate(x) for x in zip(*held))
            yield links(t, f.astype(np.int64))

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, max_subtrie: int = 1_000_000) -> DataFrame:
    """``a, b``: links that connect every two of the distinct fingerprints
    ``fp`` within ``max_bits`` bits, directly or through other links."""
    masks = key_masks(max_bits)
    keyed = _keyed(fps, masks)
    sizes = stored(keyed.groupBy("trie", "mask").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                   "simhash-tries")
    usual = keyed.join(sizes.where(F.col("n") <= max_subtrie).select("trie"), "trie", "left_semi")
    rows = usual.select("trie", "fp")
    for mask in [r.mask for r in sizes.where(F.col("n") > max_subtrie).select("mask").distinct().collect()]:
        # at most one round for each of the fixed masks
        free = [b for b in range(64) if not masks[mask] >> b & 1]
        inside = keyed.where(F.col("mask") == mask) \
            .join(sizes.where(F.col("n") > max_subtrie).select("trie"), "trie", "left_semi")
        finer = [F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
                 for i, m in enumerate(key_masks(max_bits, bits=free))]
        rows = rows.unionByName(
            inside.select("fp", "trie", F.explode(F.array(*finer)).alias("k"))
            .select(F.xxhash64("trie", "k.i", "k.part").alias("trie"), "fp"))
    return rows.repartition("trie").sortWithinPartitions("trie", F.col("fp") < 0, "fp") \
        .mapInArrow(_walk(max_bits), "a long, b long").distinct()


def _grouped(docs: DataFrame, shingle_words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(documents with key and fingerprint, the keeper of each fingerprint's component)."""
    fp = _fingerprint_udf(shingle_words)
    marked = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *doc_key(),
                                fp(body()).alias("fp")), "simhash-fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key_id", "key_hash")
    distinct = stored(marked.groupBy("fp").agg(F.min(first).alias("first")), "simhash-distinct")
    links = stored(fingerprint_links(distinct.select("fp"), max_bits), "simhash-links")
    member = connected_components(links, "a", "b")
    by_fp = distinct.join(member.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("component", F.coalesce("component", "fp"))
    # both sides stored: a component with very many fingerprints is a splittable join key
    by_fp = stored(by_fp.select("fp", "first", "component"), "simhash-members")
    keeper = stored(by_fp.groupBy("component").agg(F.min("first").alias("keeper")), "simhash-keepers")
    # and so is a fingerprint with very many documents
    return marked, stored(by_fp.join(keeper, "component").select("fp", "keeper"), "simhash-components")


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest doc_id that
    links reach. Null and wordless texts have fingerprint zero, which links
    like any other; fewer words than a shingle make one shingle. Repeated rows
    are kept and share a component. A null doc_id is passed through and is the
    component only where no row of it has an id. An empty table gives no rows;
    columns besides ``doc_id`` and ``text`` are ignored."""
    marked, named = _grouped(docs, shingle_words, max_bits)
    return marked.join(named, "fp") \
        .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                F.col("keeper.doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, with all its columns: the one with the
    smallest doc_id (rows without id last; rows that share the id by the hash
    of the text). Of rows that repeat that document exactly one stays."""
    _, named = _grouped(docs, shingle_words, max_bits)
    keepers = named.select("keeper.key_id", "keeper.key_hash").distinct()
    # columns by position: the caller's names are not touched
    rows = docs.select(*doc_key(), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    # the join leaves the rows dealt and sorted by the key that the last step needs
    return rows.join(keepers, ["key_id", "key_hash"], "left_semi").dropDuplicates(["key_id", "key_hash"]) \
        .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
