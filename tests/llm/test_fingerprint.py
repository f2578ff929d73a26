import hashlib

import numpy as np

from reviewgate.llm.fingerprint import block_masks, edited_fingerprints, within_radius


def rows():
    base = " ".join(f"word{i * 37 % 101} stem{i % 13}" for i in range(120))
    other = " ".join(f"Ünter{i * 31 % 97}" for i in range(200))
    return [(100, base), (200, base), (3, base + " tail"), (4, other), (5, None), (6, ""), (7, "one"), (8, "日本 語"),
            (300, other), (300, other), (300, "same id"), (None, "no id at all"), (9, "x " * 20000), (10, " \n ")]


def test_against_plain_python(spark, make_docs):
    data = rows()
    out = edited_fingerprints(make_docs(data)).collect()
    assert len(out) == len(data)
    uniq = {}
    for r in out:
        uniq.setdefault((r.doc_id, r.n_chars), r)
    # order: descending id, None last; ties on the id by an unspecified text hash
    ids = sorted({(i, t or "") for i, t in data if i != 300}, key=lambda x: (x[0] is None, -(x[0] or 0)))
    texts = dict(ids)
    for (i, t), (_, after) in zip(ids, ids[1:]):
        k = len(t) // 3
        want = t[:len(t) - k] + after[:k]
        assert uniq[(i, len(t))].edited_sha256 == hashlib.sha256(want.encode()).hexdigest(), i
    assert set(texts) >= {100, 200, None}
    by = {}
    for r in out:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by.setdefault(r.doc_id, set()).add(r.fingerprint)
        a, b = int(r.fingerprint, 16), int(r.edited_fingerprint, 16)
        assert r.near_edited == 1 - (a ^ b).bit_count() / 64
    assert by[100] == by[200] and by[5] == by[6] == by[10] and by[4] < by[300]
    fps = [int(r.fingerprint, 16) for r in out]
    for r in out:
        near = sum((int(r.fingerprint, 16) ^ f).bit_count() <= 3 for f in fps)
        assert r.n_near == (near if r.doc_id is not None and r.doc_id % 100 == 0 else None)


def test_single_and_empty(spark, make_docs):
    one = edited_fingerprints(make_docs([(1, "abc def ghi")])).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abc def abc").hexdigest()
    assert edited_fingerprints(make_docs([])).collect() == []


def test_search_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(2)
    centers = [int(x) for x in rng.integers(0, 1 << 63, 20)]
    values = set(centers)
    for _ in range(600):
        v = int(rng.choice(centers))
        for b in rng.integers(0, 64, rng.integers(1, 7)):
            v ^= 1 << int(b)
        values.add(v - (1 << 64) if v >> 63 else v)
    for radius in (1, 3):
        got = sorted(tuple(r) for r in within_radius(
            spark.createDataFrame([(c,) for c in centers], "query long"),
            spark.createDataFrame([(v,) for v in values], "fp long"), radius).collect())
        dist = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
        assert got == sorted((c, v, dist(c, v)) for c in centers for v in values if dist(c, v) <= radius)
    assert len(block_masks(3)) == 20


def test_main_path_is_native(spark, make_docs):
    plan = edited_fingerprints(make_docs(rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
