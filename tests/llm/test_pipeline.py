"""Every stage of the pipeline against a plain Python version of it."""

import hashlib
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from reviewgate.llm.substring_dedup import REACH, text_units
from reviewgate.llm.toxicity import fit_toxicity, score_documents

from .test_decontaminate import brute as brute_hits
from .test_simhash_dedup import brute_components, brute_fingerprint
from .test_substring_dedup import brute as brute_units

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_in_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "bpe"]
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_toxicity_stage(spark, steps):
    model = fit_toxicity(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r.doc_id for r in score_documents(steps[0], model).where("predicted = 1").collect()}
    assert texts(steps[1]) == [(i, t) for i, t in texts(steps[0]) if i not in bad]


def test_near_duplicate_stage(steps):
    rows = texts(steps[1])
    top = brute_components([brute_fingerprint(t) for _, t in rows], 4)
    best = {}
    for (i, _), c in zip(rows, top):
        best[c] = min(best.get(c, i), i)
    assert texts(steps[2]) == [(i, t) for i, t in rows if i in best.values()]


def words_of(b):
    return [(m.start(), m[0]) for m in re.finditer(rb"[0-9a-z\x80-\xff]+", b.lower())]


def brute_grown(rows, min_words=5):
    """Repeated units go, and the run grows by equal words beside the kept occurrence: the
    grouping and the growing in plain Python, over the places where the units are cut."""
    docs = {i: t.encode() for i, t in rows}
    words = {i: words_of(b) for i, b in docs.items()}
    place = {i: {a: k for k, (a, _) in enumerate(w)} | {len(docs[i]): len(w)} for i, w in words.items()}
    units, best = {}, {}
    for i, b in docs.items():
        start, stop, _, _ = text_units(b, min_words)
        units[i] = [(a, z, b" ".join(w for _, w in words_of(b[a:z]))) for a, z in zip(start.tolist(), stop.tolist())]
        for a, _, u in units[i]:
            best[u] = min(best.get(u, (i, a)), (i, a))
    out = []
    for i, b in docs.items():
        drop = [(a, z, best[u]) for a, z, u in units[i] if best[u] != (i, a)]
        spans = [(a, z) for a, z, _ in drop]
        opens, closes = {a for a, _ in spans}, {z for _, z in spans}
        own, edge = words[i], [a for a, _ in words[i]] + [len(b)]
        for a, z, (k, s) in drop:
            whole = [(place[k][x], place[k][y]) for x, y, _ in units[k]]
            at = next(n for n, (x, _) in enumerate(whole) if x == place[k][s])
            other = words[k]
            if a not in closes:
                far = min(whole[at - 1][0] if at else 0, max(0, whole[at][0] - REACH))
                n, left, right = 0, place[i][a], whole[at][0]
                while right - n > far and left - n > 0 and own[left - n - 1][1] == other[right - n - 1][1]:
                    n += 1
                spans.append((edge[left - n], a))
            if z not in opens:
                far = max(whole[at + 1][1] if at + 1 < len(whole) else len(other), whole[at][1] + REACH)
                n, left, right = 0, place[i][z], whole[at][1]
                while right + n < min(far, len(other)) and left + n < len(own) and own[left + n][1] == other[right + n][1]:
                    n += 1
                spans.append((z, edge[left + n]))
        gone = bytearray(len(b))
        for a, z in spans:
            gone[a:z] = b"\1" * (z - a)
        out.append((i, bytes(x for x, g in zip(b, gone) if not g).decode()))
    return sorted(out)


def test_passage_stage(steps):
    got, rows = texts(steps[3]), texts(steps[2])
    assert got == brute_grown(rows)
    units_only = {i: kept for i, _, _, kept in brute_units(rows)}
    assert all(len(t) <= len(units_only[i]) for i, t in got) and got != sorted(units_only.items())


def test_benchmark_stage(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d for d, *_ in brute_hits(texts(steps[3]), items)}
    assert texts(steps[4]) == [(i, t) for i, t in texts(steps[3]) if i not in hit]


def test_token_stage(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = steps[5].select("text", "token_ids").collect()
    assert len(rows) == steps[4].count()
    assert all(r.token_ids == library.encode(r.text, add_special_tokens=False).ids for r in rows)


def test_run_gives_the_last_stage(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    key = lambda r: r.doc_id
    assert sorted(got.collect(), key=key) == sorted(steps[-1].collect(), key=key)
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_and_odd_rows(spark, make_docs):
    """Columns whose names the operators use themselves go through unchanged."""
    long = "word " * 60_000
    for rows in ([], [(None, None), (1, None), (1, ""), (1, ""), (2, long)]):
        docs = make_docs(rows)
        for name in ("_keep_id", "_keep_hash", "_kept", "_spans", "_c0", "body", "toxic"):
            docs = docs.selectExpr("*", f"77 AS {name}")
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == columns
        docs = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert all(r[name] == 77 for r in docs.collect() for name in ("_keep_id", "_keep_hash", "_kept", "_spans", "_c0", "body"))


def test_ids_give_the_text_back(steps):
    rows = steps[5].select("text", "decoded_sha256").collect()
    assert rows and all(r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in rows)
