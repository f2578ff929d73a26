import math

import numpy as np
import pytest

from reviewgate.llm.hard_negatives import TreeShape, best_first, mine_hard_negatives, str_order, tile_cuts, tile_of

SCHEMA = "vec_id long, embedding array<float>, label int"
SMALL = TreeShape(chunk=16, leaf=4, page=2, tiles=4, sample=20)


def brute(rows, dims=None):
    """Every anchor against every row, in plain Python integers."""
    kept = []
    for n, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((n, vec_id, label, [math.floor(256 * float(x)) for x in vector]))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for n, a, label, v in kept:
        if a is None or a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), i, k) for m, i, k, w in kept if m != n]
        for ps, p, _ in sorted((s for s in scored if s[2] == label), key=order)[:5]:
            fit = [s for s in scored if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps]
            for rank, (ns, i, _) in enumerate(sorted(fit, key=order)[:10], 1):
                out.append((a, p, rank, i, ps, ns))
    return sorted(out, key=str)


def mined(spark, rows, shape=SMALL, **extra):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("number", "id", "v", "chunk", "score", "windows", "n"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return sorted((tuple(r) for r in mine_hard_negatives(df, shape=shape, **extra).collect()), key=str)


def vectors(n, seed, dims=6, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    label = rng.integers(0, labels, n)
    points = (centres[label] + rng.normal(scale=0.8, size=(n, dims))).astype(np.float32)
    return [(25 * i, p.tolist(), int(k)) for i, (p, k) in enumerate(zip(points, label))]


@pytest.mark.parametrize("shape", [SMALL, TreeShape()])
def test_mining_against_every_pair(spark, shape):
    rows = vectors(220, 1)
    got = mined(spark, rows, shape)
    assert got == brute(rows) and len({r[0] for r in got}) > 20


def test_odd_rows_ties_and_copies(spark):
    rows = vectors(60, 2, dims=4)
    rows += [(100, [0.5, 0.5, 0.5, 0.5], 1)] * 2                       # a repeated anchor, its id used before
    rows += [(i, [0.25, 0.25, 0.5, 0.0], 0) for i in range(1001, 1090)]   # more equal vectors than a chunk holds
    rows += [(i, [0.25, 0.25, 0.5, 0.0], 1) for i in range(1101, 1190)]
    rows += [(None, [0.5, 0.25, 0.5, 0.0], 1), (None, [0.5, 0.5, 0.5, 0.0], 2)]
    rows += [(300, None, 1), (400, [1.0, 2.0, 3.0, 4.0], None), (500, [1.0, None, 0.0, 0.0], 1),
             (600, [float("nan"), 0.0, 0.0, 0.0], 1), (700, [float("inf"), 0.0, 0.0, 0.0], 1),
             (800, [], 1), (900, [0.5, 0.5], 1), (-100, [-0.5, 0.5, -0.25, 0.0], 2), (0, [0.0] * 4, 0)]
    assert mined(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(20 * i, (rng.normal(size=5) * 60_000).astype(np.float32).tolist(), i % 3) for i in range(50)]
    assert mined(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [0.5, 0.5], 1)]) == []
    assert mined(spark, [(100, [0.5, 0.5], 1), (101, [0.5, 0.5], 1)]) == []


def test_tiles_and_leaves_hold_every_row_once():
    rng = np.random.default_rng(4)
    m = np.concatenate((rng.integers(-9, 9, (300, 5)), np.zeros((200, 5), np.int64)))
    code = tile_of(m, tile_cuts(m[::3], 9))
    assert len(set(code.tolist())) > 4
    order, starts = str_order(m, 32)
    assert sorted(order.tolist()) == list(range(500))
    assert max(np.diff(np.append(starts, 500))) <= 32


def test_the_queue_skips_boxes():
    """Two far clusters: the leaves of the low one are never opened."""
    rows = np.concatenate((np.full((64, 3), 100.0), np.full((64, 3), -100.0)))
    opened = []

    class Rows(np.ndarray):
        def __getitem__(self, key):
            opened.extend([key] if isinstance(key, slice) else [])
            return super().__getitem__(key)

    starts = np.arange(0, 128, 16)
    q = np.ones(3)
    most = np.array([rows[s:s + 16].max(0) @ q for s in starts])
    got = best_first(rows.view(Rows), np.arange(128), np.arange(128), starts, most, most, q, 0,
                     [(-(1 << 62), 1 << 62)], [-(1 << 62)], 3)
    assert got[0][1].tolist() == [1, 2, 3]
    assert len(opened) == 4  # ties of the k-th are opened, lower boxes are not
