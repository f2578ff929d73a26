"""Hard-negative mining over an STR-packed R-tree.

Vectors are packed bottom-up by sort-tile-recursive order: a tile tree cuts the
space into slabs of the widest coordinates (its cuts come from a bounded sample),
every label's rows are dealt to their tile, tiles are split into chunks of a bounded
number of rows, and inside a chunk the rows are sorted and tiled again into leaves.
Each leaf and each chunk has a minimum bounding box.

A box gives, for a query vector, an interval of the inner product in every
coordinate; the sums of their ends bound the score of all rows in the box. A query
drops chunks whose interval lies outside its score windows or strictly below a floor
(its k-th score among the sample rows, which the true k-th can't be below). Inside a
chunk a queue takes the leaves best bound first and ends when the next bound is
strictly below the k-th score found. All scores are integers and exact.

Queries meet chunks in blocks: the anchors of one chunk are a block, blocks meet the
boxes in directory pages of a bounded number of chunks, and only what survives there
meets the rows of a chunk.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LOW, HIGH = -(1 << 62), 1 << 62
_NO_ID = (1 << 63) - 1
#: Components are held to this after scaling, so that a score always fits a long.
_LARGEST = 1 << 26
_EXACT = 1 << 53


@dataclass(frozen=True)
class TreeShape:
    """Bounds of the index: rows in a chunk and a leaf, boxes in a directory page,
    tiles of the tile tree, sample rows behind the tile cuts and the floors."""
    chunk: int = 4096
    leaf: int = 128
    page: int = 256
    tiles: int = 1024
    sample: int = 4096


# ---------------------------------------------------------------- plain numpy helpers

def _matrix(values: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list array as one int64 matrix, short rows filled up with zeros."""
    n = len(values)
    lengths = np.diff(values.offsets.to_numpy()) if n else np.empty(0, np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    if n and (lengths == dims).all():
        return flat.reshape(n, dims).astype(np.int64)
    out = np.zeros((n, dims), np.int64)
    row = np.repeat(np.arange(n), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = flat
    return out


def _scorable(m: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where every partial sum stays exact, else as longs."""
    bound = float(np.abs(m).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, m.shape[1])
    return (m.astype(np.float64), q.astype(np.float64)) if bound < _EXACT else (m, q)


def _bounds(lo: np.ndarray, hi: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest, highest) score of each query (rows) in each box (columns): per
    coordinate the interval runs from one end of the box to the other, by sign."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def tile_cuts(sample: np.ndarray, tiles: int) -> list[tuple[int, np.ndarray]]:
    """Levels of the tile tree: (coordinate, cuts of every tile above). The widest
    coordinates are cut first, each into about the same number of slabs."""
    if tiles < 2 or not len(sample) or not sample.shape[1]:
        return []
    levels = max(1, min(sample.shape[1], int(np.ceil(np.log2(tiles) / 2))))
    slabs = max(2, int(np.ceil(tiles ** (1 / levels))))
    widest = np.argsort(-sample.var(axis=0), kind="stable")[:levels]
    groups, out = [sample], []
    for dim in widest:
        share = np.arange(1, slabs) / slabs
        cuts = np.array([np.quantile(g[:, dim], share, method="higher") if len(g) else np.zeros(slabs - 1)
                         for g in groups])
        out.append((int(dim), cuts))
        slab = [(g[:, dim, None] >= c).sum(1) for g, c in zip(groups, cuts)]
        groups = [g[s == k] for g, s in zip(groups, slab) for k in range(slabs)]
    return out


def tile_of(m: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    code = np.zeros(len(m), np.int64)
    for dim, cuts in levels:
        code = code * (cuts.shape[1] + 1) + (m[:, dim, None] >= cuts[code]).sum(1)
    return code


def str_order(m: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """(row order, leaf starts) of sort-tile-recursive packing."""
    widest = np.argsort(-m.var(axis=0), kind="stable") if len(m) and m.shape[1] else np.empty(0, int)
    order, starts = [], []

    def tile(rows: np.ndarray, level: int) -> None:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1 or level == len(widest):
            for k in range(0, len(rows), leaf):
                starts.append(sum(map(len, order)))
                order.append(rows[k:k + leaf])
            return
        rows = rows[np.argsort(m[rows, widest[level]], kind="stable")]
        slabs = 2 if leaves <= 4 else int(np.ceil(np.sqrt(leaves)))
        size = -(-leaves // slabs) * leaf
        for k in range(0, len(rows), size):
            tile(rows[k:k + size], level + 1)

    tile(np.arange(len(m)), 0)
    return (np.concatenate(order) if order else np.empty(0, np.int64)), np.array(starts, np.int64)


def best_first(rows: np.ndarray, ids: np.ndarray, numbers: np.ndarray, starts: np.ndarray,
               least: np.ndarray, most: np.ndarray, query: np.ndarray, own: int, windows, floors, k: int):
    """(window, places in ``rows``, scores) of the first ``k`` rows of each score window.

    The queue holds the leaves by their bound ``most``; a leaf is opened for a window
    only where its interval meets the window and the bound isn't strictly below the k-th."""
    ends = np.append(starts[1:], len(rows))
    queue = [(-u, i) for i, u in enumerate(most.tolist())]
    heapq.heapify(queue)
    least = least.tolist()
    kth = list(floors)
    found = [(np.empty(0, np.int64), np.empty(0, rows.dtype)) for _ in windows]
    while queue:
        bound, leaf = heapq.heappop(queue)
        bound = -bound
        if bound < min(kth):  # nothing that is left can reach any window's k-th
            break
        wanted = [w for w, (a, b) in enumerate(windows)
                  if bound >= max(a, kth[w]) and least[leaf] <= b]
        if not wanted:
            continue
        a, b = starts[leaf], ends[leaf]
        scores = rows[a:b] @ query
        for w in wanted:
            low, high = windows[w]
            at = np.flatnonzero((scores >= max(low, kth[w])) & (scores <= high) & (numbers[a:b] != own))
            if len(at):
                place = np.concatenate((found[w][0], at + a))
                score = np.concatenate((found[w][1], scores[at]))
                first = np.lexsort((numbers[place], ids[place], -score))[:k]
                found[w] = place[first], score[first]
                if len(first) == k:
                    kth[w] = max(kth[w], found[w][1][-1])
    return [(w, p, s) for w, (p, s) in enumerate(found) if len(p)]


# ---------------------------------------------------------------- rows and index

def numbered_rows(embeddings: DataFrame, id_col: str = "vec_id", label_col: str = "label",
                  vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """``number, id, label, v``: every row that takes part, scaled to integers.

    Rows with a null label, a null vector or a null or non-finite component are left
    out. ``number`` tells repeated rows apart."""
    scaled = F.transform(F.col(vector_col), lambda x: F.greatest(F.least(
        F.floor(x.cast("double") * 256.0), F.lit(_LARGEST)), F.lit(-_LARGEST)).cast("int"))
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return stored(embeddings.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull())
                  .where(finite)
                  .select(F.monotonically_increasing_id().alias("number"),
                          F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"),
                          (F.col(label_col) if label is None else label).cast("long").alias("label"),
                          scaled.alias("v")), "negatives-rows")


@dataclass(frozen=True)
class Tree:
    rows: DataFrame      # number, id, label, v, chunk
    chunks: DataFrame    # chunk, label, ids, numbers, starts, packed
    pages: DataFrame     # page, chunk[], label[], lo, hi
    n_pages: int
    dims: int
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]  # numbers, labels, vectors
    shape: TreeShape


def build_tree(rows: DataFrame, shape: TreeShape = TreeShape()) -> Tree:
    """Packs ``number, id, label, v`` rows into chunks, leaves and directory pages."""
    n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.greatest(F.max(F.size("v")), F.lit(1)), F.lit(1))).first()
    # bounded by shape.sample, whatever the table's size
    picked = rows.select("number", "label", "v", F.xxhash64("number").alias("h")) \
        .orderBy("h", "number").limit(shape.sample).toArrow()
    sample = (picked["number"].to_numpy(), picked["label"].to_numpy(),
              _matrix(picked["v"].combine_chunks(), dims))
    levels = tile_cuts(sample[2], min(shape.tiles, -(-n // (shape.chunk * max(1, len(set(sample[1])))))))

    @F.pandas_udf("long")
    def tile(v: pd.Series) -> pd.Series:
        return pd.Series(tile_of(_matrix(pa.array(v, pa.list_(pa.int32())), dims), levels))

    tiled = stored(rows.withColumn("tile", tile("v")), "negatives-tiles")
    sizes = stored(tiled.groupBy("label", "tile").agg(F.count(F.lit(1)).alias("n")), "negatives-sizes")
    parts = F.ceil(F.col("n") / F.lit(shape.chunk))
    placed = stored(
        tiled.join(sizes, ["label", "tile"])
        .select("number", "id", "label", "v", F.xxhash64(
            "label", "tile", F.pmod(F.xxhash64("number"), parts)).alias("chunk")), "negatives-placed")

    def pack(key, group):
        m = _matrix(group["v"].combine_chunks(), dims)
        order, starts = str_order(m, shape.leaf)
        m = m[order].astype(np.int32)
        wide = lambda x, t=pa.int64(): pa.array([x], pa.list_(t))
        return pa.table({
            "chunk": pa.array([key[0].as_py()], pa.int64()), "label": pa.array([key[1].as_py()], pa.int64()),
            "ids": wide(group["id"].to_numpy()[order]), "numbers": wide(group["number"].to_numpy()[order]),
            "starts": wide(starts), "lo": wide(m.min(axis=0), pa.int32()), "hi": wide(m.max(axis=0), pa.int32()),
            "packed": pa.array([m.tobytes()], pa.binary())})

    chunks = stored(placed.groupBy("chunk", "label").applyInArrow(
        pack, "chunk long, label long, ids array<long>, numbers array<long>, starts array<long>, "
              "lo array<int>, hi array<int>, packed binary"), "negatives-chunks")
    n_pages = max(1, -(-chunks.count() // shape.page))
    pages = stored(chunks.select(F.pmod(F.xxhash64("chunk"), F.lit(n_pages)).alias("page"),
                                 F.struct("chunk", "label", "lo", "hi").alias("box"))
                   .groupBy("page").agg(F.sort_array(F.collect_list("box")).alias("boxes")), "negatives-pages")
    return Tree(placed, chunks, pages, n_pages, dims, sample, shape)


def search(tree: Tree, queries: DataFrame, k: int, same_label: bool) -> DataFrame:
    """``query, window, place, number, id, score``: for each query and each of its
    score windows the first ``k`` rows of the same (or of other) labels by score,
    ties by smaller id; the query's own row is left out.

    ``queries``: ``number, label, v, chunk, windows`` (array of structs low, high)."""
    numbers, labels, vectors = tree.sample
    dims = tree.dims
    window_lists = pa.list_(pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))

    def block(key, group):
        """The queries of one chunk, with the floor of every window."""
        own, label = group["number"].to_numpy(), key[1].as_py()
        q = _matrix(group["v"].combine_chunks(), dims)
        usable = (labels == label) == same_label
        m, qs = _scorable(vectors[usable], q)
        scores, others = qs @ m.T, numbers[usable]
        windows, floors = group["windows"].to_pylist(), []
        for row, ws in enumerate(windows):
            s = scores[row][others != own[row]]
            floors.append([])
            for w in ws:
                inside = s[(s >= w["low"]) & (s <= w["high"])]
                floors[-1].append(int(np.partition(inside, -k)[-k]) if len(inside) >= k else LOW)
        return pa.table({"block": [key[0].as_py()], "label": [label],
                         "queries": pa.array([own], pa.list_(pa.int64())),
                         "windows": pa.array([windows], window_lists),
                         "floors": pa.array([floors], pa.list_(pa.list_(pa.int64()))),
                         "packed": pa.array([q.astype(np.int32).tobytes()], pa.binary())})

    kind = "array<struct<low:bigint,high:bigint>>"
    blocks = queries.select("number", "label", "v", "chunk", "windows").groupBy("chunk", "label").applyInArrow(
        block, f"block long, label long, queries array<long>, windows array<{kind}>, "
               "floors array<array<long>>, packed binary")
    blocks = stored(blocks, "negatives-blocks")

    def prune(batches):
        """Blocks beside directory pages: what is left of a block for each chunk."""
        for batch in batches:
            for r in batch.to_pylist():
                boxes = [b for b in r["boxes"] if (b["label"] == r["label"]) == same_label]
                if not boxes:
                    continue
                q = np.frombuffer(r["packed"], np.int32).reshape(-1, dims).astype(np.int64)
                lo = np.array([b["lo"] for b in boxes], np.int64).reshape(-1, dims)
                hi = np.array([b["hi"] for b in boxes], np.int64).reshape(-1, dims)
                edges, qs = _scorable(np.vstack((lo, hi)), q)
                least, most = _bounds(edges[:len(lo)], edges[len(lo):], qs)
                alive = np.zeros(least.shape, bool)
                for row, (ws, fs) in enumerate(zip(r["windows"], r["floors"])):
                    for w, f in zip(ws, fs):
                        alive[row] |= (most[row] >= max(w["low"], f)) & (least[row] <= w["high"])
                for col, b in enumerate(boxes):
                    at = np.flatnonzero(alive[:, col])
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([b["chunk"]], pa.int64()),
                             pa.array([[r["queries"][i] for i in at]], pa.list_(pa.int64())),
                             pa.array([[r["windows"][i] for i in at]], window_lists),
                             pa.array([[r["floors"][i] for i in at]], pa.list_(pa.list_(pa.int64()))),
                             pa.array([q[at].astype(np.int32).tobytes()], pa.binary())],
                            ["chunk", "queries", "windows", "floors", "asked"])

    beside = blocks.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tree.n_pages - 1).cast("long")))) \
        .join(tree.pages, "page").select("label", "queries", "windows", "floors", "packed", "boxes")
    pairs = stored(beside.mapInArrow(
        prune, f"chunk long, queries array<long>, windows array<{kind}>, floors array<array<long>>, asked binary"),
        "negatives-pairs")

    def visit(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows = np.frombuffer(r["packed"], np.int32).reshape(-1, dims).astype(np.int64)
                asked = np.frombuffer(r["asked"], np.int32).reshape(-1, dims).astype(np.int64)
                rows, asked = _scorable(rows, asked)
                ids, own = np.array(r["ids"], np.int64), np.array(r["numbers"], np.int64)
                starts = np.array(r["starts"], np.int64)
                out = {name: [] for name in ("query", "window", "number", "id", "score")}
                least, most = _bounds(np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts), asked)
                for i, (ws, fs, number) in enumerate(zip(r["windows"], r["floors"], r["queries"])):
                    windows = [(x["low"], x["high"]) for x in ws]
                    for w, place, score in best_first(rows, ids, own, starts, least[i], most[i], asked[i],
                                                      number, windows, fs, k):
                        out["query"] += [number] * len(place)
                        out["window"] += [w] * len(place)
                        out["number"] += own[place].tolist()
                        out["id"] += ids[place].tolist()
                        out["score"] += [int(s) for s in score]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], list(out))

    spark = tree.rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = tree.chunks.select("chunk", "ids", "numbers", "starts", "packed").repartition(n, "chunk")
    hits = pairs.repartition(n, "chunk").join(chunks, "chunk").mapInArrow(visit, "query long, window long, number long, id long, score long")
    first = Window.partitionBy("query", "window").orderBy(F.desc("score"), "id", "number")
    return hits.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)


def mine_hard_negatives(embeddings: DataFrame, positives: int = 5, negatives: int = 10,
                        low_percent: int = 30, high_percent: int = 90, every: int = 100,
                        shape: TreeShape = TreeShape()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``; their positives
    the first rows of the same label; the negatives of a positive the first rows of
    other labels whose score is from ``low_percent`` to ``high_percent`` of its score.

    Rows with a null label, a null vector, or a null or non-finite component take no
    part. A null ``vec_id`` is no anchor, comes last among ties and is returned as
    null. Repeated rows each count, and a repeated anchor returns its rows each time.
    Shorter vectors (the empty one too) are filled up with zeros, components beyond
    2^26 after scaling are held to that. Equal scores go by ``vec_id``, then by row. An
    empty table gives no rows; other columns are ignored."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = numbered_rows(embeddings, label=label)
    tree = build_tree(rows, shape)
    anchors = tree.rows.where((F.col("id") != _NO_ID) & (F.col("id") % every == 0))
    whole = F.array(F.struct(F.lit(LOW).cast("long").alias("low"), F.lit(HIGH).cast("long").alias("high")))
    first = stored(search(tree, anchors.withColumn("windows", whole), positives, same_label=True),
                   "negatives-positives")
    score = F.col("score").cast("decimal(20,0)")
    low = F.ceil(score * low_percent / 100).cast("long")
    high = F.floor(score * high_percent / 100).cast("long")
    asked = first.groupBy("query").agg(F.sort_array(F.collect_list(F.struct(  # at most ``positives`` of them
        "place", "id", "score", low.alias("low"), high.alias("high")))).alias("wanted"))
    anchors = stored(anchors.join(asked.withColumnRenamed("query", "number"), "number"), "negatives-anchors")
    windows = F.transform("wanted", lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high")))
    found = stored(search(tree, anchors.withColumn("windows", windows), negatives, same_label=False),
                   "negatives-found")
    named = anchors.select(F.col("number").alias("query"), F.col("id").alias("anchor_id"), "wanted")
    given = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return found.join(named, "query").withColumn("p", F.expr("wanted[int(window)]")).select(
        "anchor_id", F.col("p.id").alias("positive_id"), F.col("place").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.col("p.score").alias("positive_score"),
        F.col("score").alias("negative_score")) \
        .withColumns({c: given(c) for c in ("positive_id", "negative_id")})
