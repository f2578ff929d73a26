import random
import re

from reviewgate.llm import decontaminate
from reviewgate.llm.decontaminate import benchmark_hits, drop_contaminated, item_sketch
from reviewgate.llm.words import run_hashes, shingles, word_table


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 7))) for _ in range(n))


def brute(docs, items):
    def shingle_set(text):
        w = re.findall(r"[0-9a-z\x80-\U0010FFFF]+", (text or "").lower())
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    out = []
    for d, t in docs:
        have = shingle_set(t)
        for i, x in items:
            want = shingle_set(x)
            n = len(want & have)
            if want and 10 * n >= 8 * len(want):
                out.append((d, i, len(want), n, n / len(want)))
    return sorted(out, key=repr)


def fixture():
    items = [(i, prose(i, n)) for i, n in enumerate([5, 6, 9, 14, 20, 33, 60, 120])]
    items += [(20, "tiny item"), (21, ""), (22, None), (23, "?!"), (None, prose(3, 14)), (3, prose(3, 14))]
    docs = [(1, prose(100, 3000) + "\n" + items[6][1].upper() + ", " + prose(101, 50)),
            (2, items[4][1]), (3, "Tiny, ITEM!"), (4, "a tiny item more"), (5, None), (6, ""), (None, items[3][1])]
    for k, (i, t) in enumerate(items[:8]):  # some words changed: near the threshold, on both sides
        for j in range(6):
            w = t.split()
            for x in random.Random(j).sample(range(len(w)), min(j, len(w))):
                w[x] = "changed"
            docs.append((100 + 10 * k + j, prose(200 + j, 30) + " " + " ".join(w) + " " + prose(300 + j, 30)))
    return docs + docs[:2], items


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n string")


def test_against_every_pair(spark, make_docs):
    docs, items = fixture()
    got = sorted([tuple(r) for r in benchmark_hits(make_docs(docs), items_frame(spark, items)).collect()], key=repr)
    assert got == brute(docs, items) and len(got) > 20


def test_crowded_filter_and_kept_documents(spark, make_docs, monkeypatch):
    docs, items = fixture()
    frame = items_frame(spark, items)
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 7)  # most foreign shingles get through
    got = sorted([tuple(r) for r in benchmark_hits(make_docs(docs), frame).collect()], key=repr)
    assert got == brute(docs, items)
    kept = drop_contaminated(make_docs(docs), frame)
    assert kept.columns == make_docs(docs).columns
    hit = [(d, t) for d, t in docs if brute([(d, t)], items)]
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == \
        sorted((d, t or "") for d, t in docs if (d, t) not in hit)


def test_very_long_text_and_columns_of_the_same_name(spark, make_docs):
    item = prose(7, 40)
    long = prose(8, 60_000) + " " + item + " " + prose(9, 60_000)
    docs = make_docs([(1, long), (2, prose(10, 50))])
    for name in ("doc_row", "text_hash", "hash", "shingle", "item_key", "item_id", "shared"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    items = items_frame(spark, [(5, item)] * 3)
    got = [tuple(r) for r in benchmark_hits(docs, items).collect()]
    assert got == [(1, 5, 36, 36, 1.0)] * 3
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_empty_tables(spark, make_docs):
    docs, items = fixture()
    assert benchmark_hits(make_docs([]), items_frame(spark, items)).collect() == []
    assert benchmark_hits(make_docs(docs), items_frame(spark, [])).collect() == []
    assert drop_contaminated(make_docs(docs), items_frame(spark, [])).count() == len(docs)


def test_sketch_is_smaller_than_the_item():
    own, values, needed = item_sketch(prose(1, 200))
    assert len(own) == 196 and len(values) < 60 and needed >= 1


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    a, b = word_table(b"One, two three"), word_table(b"zero one two  three")
    assert a[2].tolist() == b[2].tolist()[1:] and a[0].tolist() == [0, 5, 9]
    assert run_hashes(a[2], *map(__import__("numpy").array, ([0], [3]))) == \
        run_hashes(b[2], *map(__import__("numpy").array, ([1], [4])))
    text = prose(5, 4000).encode()
    whole = word_table(text)
    from reviewgate.llm import words
    monkeypatch.setattr(words, "_PIECE", 100)
    assert all((x == y).all() for x, y in zip(whole, word_table(text)))
    assert len(shingles(whole[2], 5)) == 3996
