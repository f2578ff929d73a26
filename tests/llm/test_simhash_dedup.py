import re

import numpy as np
import xxhash

from reviewgate.llm import simhash_dedup
from reviewgate.llm.components import connected_components
from reviewgate.llm.simhash_dedup import (drop_near_duplicates, fingerprint_links, key_masks,
                                          simhash_groups, trie_links)


def brute_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [words[i:i + k] for i in range(len(words) - k + 1)] or [words]
    hs = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(values, bits):
    top = list(range(len(values)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = sorted((root(i), root(j)))
                top[b] = a
    return [root(i) for i in range(len(values))]


def near_values(n, seed):
    rng = np.random.default_rng(seed)
    centers = rng.integers(0, 1 << 63, 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = set()
    while len(out) < n:
        v = int(rng.choice(centers))
        for b in rng.integers(0, 64, rng.integers(0, 9)):
            v ^= 1 << int(b)
        out.add(v)
    return sorted(out)


def test_trie_walk_against_all_pairs(monkeypatch):
    values = near_values(400, 3)
    want = brute_components(values, 4)
    for frontier in (1 << 19, 50):
        monkeypatch.setattr(simhash_dedup, "_FRONTIER", frontier)
        a, b = trie_links(np.zeros(len(values), np.int64), np.array(values, np.uint64), 4)
        top = list(range(len(values)))
        for x, y in zip(a, b):
            top[x] = y
        assert top == want
        assert len(a) == len(values) - len(set(want))


def test_masks_cover_every_error_pattern():
    masks = key_masks(4)
    assert len(masks) == 35
    rng = np.random.default_rng(5)
    for _ in range(2000):
        diff = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(diff & m == 0 for m in masks)


def test_links_with_hot_subtries_cut_again(spark):
    values = near_values(300, 8)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = brute_components(values, 4)
    for limit in (1_000_000, 20):
        member = {r.node: r.component for r in
                  connected_components(fingerprint_links(fps, 4, max_subtrie=limit), "a", "b").collect()}
        groups = {}
        for v, w in zip(signed, want):
            groups.setdefault(w, set()).add(member.get(v, v))
        assert all(len(g) == 1 for g in groups.values())
        assert len(set().union(*groups.values())) == len(groups)


def texts():
    base = " ".join(f"word{i * 37 % 101}" for i in range(300))
    other = " ".join(f"term{i * 31 % 97}" for i in range(200))
    return [(5, base), (2, base + " End"), (9, base.upper()), (7, base.replace("word5 ", "odd ", 1)),
            (11, other), (12, other), (12, other), (None, other), (None, None), (20, ""), (21, " \t\n "),
            (30, "one"), (31, "One"), (32, "two words"), (40, "É x É a b\x0bc d"), (41, base * 30)]


def test_groups_against_brute_force(spark, make_docs):
    rows = texts()
    fps = [brute_fingerprint(t) for _, t in rows]
    top = brute_components(fps, 4)
    ids = {}
    for (i, _), c in zip(rows, top):
        ids.setdefault(c, []).append(i)
    low = {c: min((i for i in m if i is not None), default=None) for c, m in ids.items()}
    want = sorted([(i, f"{f:016x}", low[c]) for (i, _), f, c in zip(rows, fps, top)], key=repr)
    got = sorted([tuple(r) for r in simhash_groups(make_docs(rows)).collect()], key=repr)
    assert got == want


def test_one_document_stays(spark, make_docs):
    docs = make_docs(texts() + [(50, "lone text that nothing else resembles at all")])
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    comps = {r.component_id for r in simhash_groups(docs).collect()}
    assert sorted(got) == sorted(comps) and 50 in got and got.count(11) == 1 and 12 not in got


def test_empty(spark, make_docs):
    assert simhash_groups(make_docs([])).collect() == []
    assert drop_near_duplicates(make_docs([])).collect() == []


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100}
