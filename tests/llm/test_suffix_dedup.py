import hashlib
from collections import Counter

import pytest

from reviewgate.llm.suffix_dedup import suffix_dedup


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        drop = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                drop[k:k + length] = b"\1" * length
        kept = bytes(c for c, d in zip(b, drop) if not d)
        spans = sum(1 for k, d in enumerate(drop) if d and (k == 0 or not drop[k - 1]))
        out.append((i, len(b), sum(drop), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans",
                                               "kept_sha256").collect()), key=repr)


def prose(seed, n):
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(["alpha", "bèta", "gam", "delta ", "e", "zeta\n", "ηθ", "iota"][x >> 16 & 7])
        out.append(chr(97 + (x >> 8) % 26))
    return "".join(out)


def test_against_every_window(spark, make_docs):
    a, b = prose(1, 200), prose(2, 120)
    rows = [(1, a), (2, a), (3, a[:150] + prose(3, 40) + a[150:]), (4, prose(4, 30) + b[:230] + "x" + b[231:]),
            (5, b), (6, b), (6, b), (6, prose(6, 70)), (None, a[100:420]), (None, None), (8, ""),
            (9, "y" * 450), (10, "ab" * 180 + prose(7, 5)), (11, "short"), (12, prose(8, 60) * 3),
            (13, b[:199]), (14, b[:200]), (15, prose(9, 400))]
    assert got(suffix_dedup(make_docs(rows), 200)) == brute(rows, 200)
    assert got(suffix_dedup(make_docs(rows), 64)) == brute(rows, 64)


def test_empty_table_and_bad_length(spark, make_docs):
    assert got(suffix_dedup(make_docs([]), 200)) == []
    with pytest.raises(ValueError):
        suffix_dedup(make_docs([]), 10)


def test_long_text_in_pieces(spark, make_docs, monkeypatch):
    from reviewgate.llm import suffix_dedup as module
    a = prose(5, 1500)
    whole = module.pivot_nodes(a.encode(), 200)
    monkeypatch.setattr(module, "_CHUNK", 700)
    pieces = module.pivot_nodes(a.encode(), 200)
    assert len(a.encode()) > 3000
    expand = lambda n: [(p, s) for p, f, l in zip(*(x.tolist() for x in n[:3])) for s in range(f, l + 1)]
    assert expand(whole) == expand(pieces)


def test_spans_keep_the_offsets(spark, make_docs):
    a = prose(21, 100)
    head, tail = prose(22, 20), prose(23, 20)
    rows = {r.doc_id: r for r in suffix_dedup(make_docs([(1, a), (2, head + a + tail)])).collect()}
    start = len(head.encode())
    assert rows[2].spans == [[start, start + len(a.encode())]]
    assert bytes(rows[2].kept) == (head + tail).encode()
