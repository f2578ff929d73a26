import hashlib
import random
import re
import zlib

import pytest

from reviewgate.llm.conversation_trie import conversation_trie as trie
from reviewgate.llm.conversation_trie import list_digests, sweep

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Every prefix of every rebuilt conversation, in plain Python."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [t[3] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) or 1
        saved[p] = sum(saved[k] for k in kids) + (len(nodes[p]) - 1) * words(p)
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members),
                    len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def built(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("c", "d", "t", "words", "rank", "n", "s", "first", "group_count", "n_turns"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return sorted((tuple(r) for r in trie(df, **options).collect()), key=str)


def talk(n, seed, vocabulary=3, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", " d  e\tf "][:vocabulary])))
    return rows


@pytest.mark.parametrize("cap", [1, 12, 4096])
def test_trie_against_every_prefix(spark, cap):
    rows = talk(150, 1, vocabulary=2)
    assert built(spark, rows, cap=cap) == brute(rows)


def test_odd_rows(spark):
    rows = talk(45, 2)
    rows += [(7, None, None, None), (7, 2, "user", None), (7, 2, "user", None), (8, 0, None, "x"),  # ties, nulls
             (-5, 1, "user", "before"), (-20, 0, "user", "below zero"), (None, 0, "user", "nobody's"),
             (61, 0, "user", "alone"), (62, 0, "user", ""), (900, 3, "user", "w " * 50_000)]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1400, 20) for t in range(9)]  # copies longer than a container
    rows += [(5000, t, "user", str(t % 3)) for t in range(300)]
    for cap in (10, 4096):
        assert built(spark, rows, cap=cap) == brute(rows)


def test_turnless_and_empty(spark):
    assert built(spark, []) == []
    assert built(spark, [(None, 1, "user", "x")]) == []
    turnless = next(c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(turnless, 0, "user", "dropped"), (turnless + 200 - turnless % 20, 0, "user", "kept words")]
    got = built(spark, rows)
    assert got == brute(rows) and any(r[1] == 0 and r[3] == 2 for r in got)


def test_list_digests_join_pieces_in_order(spark):
    rows = [(1, 0, 0, c) for c in range(140_000)] + [(1, 0, 5, 7), (2, 0, 0, -3), (2, 0, 0, 12)]
    got = {tuple(r)[:3]: r.ends_sha256 for r in
           list_digests(spark.createDataFrame(rows, "d long, k1 long, k2 long, c long").repartition(5)).collect()}
    want = {}
    for *key, c in sorted(rows):
        want.setdefault(tuple(key), []).append(str(c))
    assert got == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in want.items()}


def test_sweep_of_one_container():
    nodes = sweep([((b"", b"x"), [0, 4], 9), ((b"", b"x", b"y"), [0, 4, 1], 3), ((b"", b"z"), [0, 2], 5)], 2)
    assert sorted(nodes) == [(3, 2, None, 3, 2, 2, 4, []), (3, 3, 3, 2, 1, 1, 4, [9]), (3, 4, 3, 1, 0, 1, 0, [3]),
                             (5, 3, 3, 1, 0, 1, 0, [5])]
