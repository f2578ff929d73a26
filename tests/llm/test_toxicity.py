import math
import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from reviewgate.llm.toxicity import (FitLimits, _logistic, drop_toxic, fit_toxicity, held_out,
                                     score_documents, text_windows, window_features)

SF = "/root/testdata/sf0.1"
BAD = "scumbag lowlife pathetic worthless".split()


def corpus(n=400):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice(["an", "ti", "re", "shon", "le"]) for _ in range(rng.randint(1, 4)))
             for _ in range(rng.randint(40, 200))]
        toxic = i % 4 == 0
        if toxic:
            for k in range(0, len(w), 15):
                w.insert(k, rng.choice(BAD))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, dict(labels), fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    out = score_documents(docs, model).collect()
    assert {r.doc_id: r.held_out for r in out} == \
        {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in labels}
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in out)


def test_edge_texts_and_filter(spark, make_docs, fitted):
    _, _, model = fitted
    rows = [(1, None), (2, ""), (None, "plain an ti re"), (3, "scumbag pathetic worthless lowlife " * 9000),
            (3, "scumbag pathetic worthless lowlife " * 9000), (4, "an ti re shon le " * 9000)]
    docs = make_docs(rows)
    got = score_documents(docs, model).collect()
    assert len(got) == 6 and not [r for r in got if r.doc_id is None][0].held_out
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score and by[3].predicted == 1 and by[4].predicted == 0
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 4]
    assert score_documents(make_docs([]), model).collect() == []


def test_labels_of_held_out_rows_are_not_read(spark, fitted):
    docs, labels, model = fitted
    turned = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int") \
        .withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = fit_toxicity(docs, turned)
    assert (again.ordinary, again.toxic) == (model.ordinary, model.toxic)
    assert np.allclose(again.weights, model.weights)


def test_no_labels_and_one_class(spark, make_docs):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    docs = make_docs([(1, "some text"), (2, None)])
    assert all(r.score < 0.3 for r in score_documents(docs, fit_toxicity(docs, empty)).collect())
    one = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    assert len({r.score for r in score_documents(docs, fit_toxicity(docs, one)).collect()}) == 1
    assert score_documents(make_docs([]), fit_toxicity(make_docs([]), empty)).collect() == []


def test_windows_cover_the_whole_text():
    text = "é" + "abcdefghij" * 200
    windows = text_windows(text)
    assert b"".join(w[:320] for w in windows) == text.encode() and text_windows(None) == []
    assert window_features(["", None], b" " * 64, b" " * 64, True).tolist() == [[0.0] * 7] * 2


def test_logistic_against_gradient():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=500) > 0).astype(float)
    center, scale, w, b = _logistic(x, y)
    z = (x - np.array(center)) / np.array(scale)
    p = 1 / (1 + np.exp(-(b + z @ np.array(w))))
    assert np.abs(z.T @ (y - p) - np.array(w)).max() < 1e-3


def test_planted_words_of_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = fit_toxicity(docs, labels, FitLimits())
    known = labels.select("doc_id", "toxic")
    held = score_documents(docs.join(known, "doc_id", "left_semi"), model).where("held_out") \
        .join(known, "doc_id").toPandas()
    bad, fine = held[held.toxic == 1], held[held.toxic == 0]
    assert bad.predicted.mean() > 0.6 and fine.predicted.mean() < 0.05


def test_score_keeps_the_share_of_all_labelled_rows(spark):
    """The sample's limits draw the classes at 1:1; the mean score stays at the share of the table."""
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(1500):
        toxic = int(i % 10 == 0)
        w = ["".join(rng.choice(["an", "ti", "re", "shon", "le"]) for _ in range(rng.randint(1, 4))) for _ in range(30)]
        if rng.random() < (0.7 if toxic else 0.15):
            w.insert(5, rng.choice(BAD))
        docs.append((i, " ".join(w)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).cache()
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    share = np.mean([r.score for r in score_documents(docs, fit_toxicity(docs, labels)).collect()])
    small = np.mean([r.score for r in score_documents(
        docs, fit_toxicity(docs, labels, FitLimits(toxic=100, ordinary=100))).collect()])
    assert abs(share - 0.1) < 0.05 and abs(small - 0.1) < 0.05


def test_score_recomputed_in_plain_python(spark, make_docs, fitted):
    """Dictionaries, windows and curve, one text at a time, without the library's code."""
    _, _, model = fitted
    texts = ["an ti re shon", "pathetic worthless scumbag " * 200, "é lowlife " + "an ti " * 300, ""]
    got = {r.doc_id: r.score for r in score_documents(make_docs(list(enumerate(texts))), model).collect()}
    kind = zstandard.DICT_TYPE_RAWCONTENT if model.raw else zstandard.DICT_TYPE_AUTO

    def length(window, dictionary):
        params = zstandard.ZstdCompressionParameters(
            compression_level=3, window_log=15, hash_log=13, chain_log=13, search_log=5, min_match=4, target_length=16,
            strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=kind),
                                            compression_params=params).compress(window))

    for i, text in enumerate(texts):
        data = text.lower().encode()
        gains = [length(data[k:k + 332], model.ordinary) - length(data[k:k + 332], model.toxic)
                 for k in range(0, len(data), 320)]
        x = [0.0] * 7 if not gains else [
            sum(gains) / len(gains), max(gains), math.log(1 + len(gains)),
            *(sum(g >= m for g in gains) / len(gains) for m in (1, 2, 4, 6))]
        margin = model.intercept + sum((a - c) / s * w for a, c, s, w in zip(x, model.center, model.scale, model.weights))
        assert abs(got[i] - 1 / (1 + math.exp(-margin))) < 1e-6


def test_the_end_of_a_long_text_is_learned_from(spark):
    """The toxic words of every toxic text stand after 25,000 characters."""
    rows, labels = corpus(80)
    rows = [(i, "an ti re shon le " * 1500 + t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit_toxicity(docs, table)
    out = {r.doc_id: r.predicted for r in score_documents(docs, model).collect()}
    assert np.mean([out[i] == y for i, y in labels]) > 0.9
    again = fit_toxicity(docs.repartition(2), table)
    assert (again.ordinary, again.toxic) == (model.ordinary, model.toxic)
