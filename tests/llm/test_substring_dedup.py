import random
import re

from reviewgate.llm.substring_dedup import drop_repeated_units, substring_dedup, text_units


def prose(seed, n, sep=" "):
    rng = random.Random(seed)
    return sep.join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 9))) for _ in range(n))


def brute(rows, min_words=5):
    """The same units, grouped by their normalised text instead of a digest."""
    def norm(piece):
        return b" ".join(re.findall(rb"[0-9a-z\x80-\xff]+", piece.lower()))
    best, found = {}, []
    for i, t in rows:
        b = (t or "").encode()
        start, stop, _, _ = text_units(b, min_words)
        found.append([(a, z, norm(b[a:z])) for a, z in zip(start.tolist(), stop.tolist())])
        for a, _, u in found[-1]:
            rank = (-1 if i is None else i, a)
            best[u] = min(best.get(u, rank), rank)
    out = []
    for (i, t), units in zip(rows, found):
        b = (t or "").encode()
        drop = [(a, z) for a, z, u in units if best[u] != (-1 if i is None else i, a)]
        kept, at = b"", 0
        for a, z in drop:
            kept, at = kept + b[at:a], z
        out.append((i, len(b), sum(z - a for a, z in drop), (kept + b[at:]).decode()))
    return sorted(out, key=repr)


def rows():
    passage = prose(1, 60) + ".\n" + prose(2, 30)
    line = prose(3, 12)
    return [(3, prose(10, 40) + " " + passage + " " + prose(11, 50)), (1, prose(12, 7) + "\n" + passage),
            (2, line + "\n" + prose(13, 30)), (4, prose(14, 20) + "\n" + line.upper() + "!\n" + prose(15, 20)),
            (5, line + "\n" + line), (6, None), (7, ""), (8, "a b c"), (9, "a b c"), (10, "spam " * 400),
            (None, prose(16, 30)), (12, prose(16, 30)), (13, ".,;\n\n--"), (14, prose(17, 3000)),
            (15, prose(17, 3000) + prose(18, 9, "\n"))]


def test_against_brute_force(spark, make_docs):
    got = sorted([(r.doc_id, r.n_bytes, r.n_removed, r.kept_text)
                  for r in substring_dedup(make_docs(rows())).collect()], key=repr)
    assert got == brute(rows())


def test_passage_inside_a_line_goes_and_offsets_hold(spark, make_docs):
    source = dict(rows())
    for r in substring_dedup(make_docs(rows())).collect():
        b = (source[r.doc_id] or "").encode()
        assert sum(e - s for s, e in r.spans) == r.n_removed
        kept, at = b"", 0
        for s, e in r.spans:
            kept, at = kept + b[at:s], e
        assert (kept + b[at:]).decode() == r.kept_text
        if r.doc_id == 3:  # the passage of 90 words is first in document 1
            left = set(prose(1, 60).split()) & set(r.kept_text.split())
            assert len(left) < 25 and all(w in r.kept_text for w in prose(11, 50).split()[20:])


def test_repeated_rows_and_columns(spark, make_docs):
    docs = make_docs([(1, "one two three four five six"), (1, "one two three four five six"),
                      (2, "one two three four five six"), (2, "other text altogether here it is"), (3, None)])
    out = drop_repeated_units(docs)
    assert out.columns == docs.columns
    got = sorted([(r.doc_id, r.text) for r in out.collect()], key=repr)
    assert got == sorted([(1, "one two three four five six")] * 2 + [
        (2, ""), (2, "other text altogether here it is"), (3, None)], key=repr)


def test_empty(spark, make_docs):
    assert substring_dedup(make_docs([])).collect() == []


def test_repeated_lines_against_plain_line_grouping(spark, make_docs):
    """No text_units here: a later copy of a line of five or more words goes whole."""
    rng = random.Random(20)
    lines = [prose(100 + k, rng.randint(5, 40)) for k in range(40)]
    docs = [(i, "\n".join(x for k in range(8) for x in
                          (prose(1000 * i + k, rng.randint(1, 4)), rng.choice(lines)))) for i in range(1, 40)]
    seen, want = set(), {}
    for i, text in docs:
        want[i] = []
        for line in text.split("\n"):
            if len(line.split()) < 5 or line not in seen:
                want[i].append(line)
            seen.add(line)
    got = {r.doc_id: r.kept_text for r in substring_dedup(make_docs(docs)).collect()}
    assert {i: t.split() for i, t in got.items()} == {i: " ".join(x).split() for i, x in want.items()}


def test_passage_in_differing_text_goes_whole(spark, make_docs):
    """Passages of 50 words in the middle of a line; the copies also stand twice in one table row."""
    docs, passages = [], []
    for k in range(60):
        passages.append(prose(5000 + k, 50))
        for copy in range(2):
            docs.append((2 * k + copy, f"{prose(7000 + 2 * k + copy, 30)} {passages[-1]} {prose(9000 + 2 * k + copy, 30)}"))
    docs += [docs[1], docs[1]]
    for r in substring_dedup(make_docs(docs), extend=True).collect():
        k, copy = divmod(r.doc_id, 2)
        rest = f"{prose(7000 + r.doc_id, 30)} {prose(9000 + r.doc_id, 30)}"
        whole = dict(docs)[r.doc_id]
        assert r.kept_text == (rest if copy else whole)
        assert r.n_removed == len(whole.encode()) - len(r.kept_text.encode())


def test_short_lines_inside_a_passage_go(spark, make_docs):
    song = "\n".join(prose(300 + k, 3 if k % 5 else 9) for k in range(40))
    docs = [(1, prose(1, 9) + "\n" + song + "\n" + prose(2, 9)), (2, prose(3, 9) + "\n" + song + "\n" + prose(4, 9))]
    got = {r.doc_id: r.kept_text for r in substring_dedup(make_docs(docs), extend=True).collect()}
    assert got == {1: docs[0][1], 2: prose(3, 9) + "\n" + prose(4, 9)}
