"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one for ordinary and one for toxic
text. They share the entropy tables and common segments trained on ordinary
windows; each then gets the segments that set its class apart (word pieces
whose document frequency differs between the classes by a likelihood-ratio
test). Every window of a text is compressed with both, and the difference in
length says how much better the toxic dictionary explains it. A text is
described by its windows' differences (mean, largest, share over fixed
margins, number of windows), and a logistic curve fitted on labelled texts
that the dictionaries have not seen turns that into a calibrated probability.
Those texts also decide how much evidence a segment needs.

Dictionaries and curve are fitted on a bounded sample of labelled rows
(``FitLimits``), segments and curve on their whole texts; the common segments come from
a fixed number of windows of every sampled text, chosen by checksum anywhere in it.
Scoring reads all of every text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 320
OVERLAP = 12
THRESHOLD = 0.3
_MARGINS = (1, 2, 4, 6)
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_PIECES = range(4, 9)


@dataclass(frozen=True)
class FitLimits:
    """Bounds of the labelled sample that is fitted on, by hash of the doc_id."""
    toxic: int = 1500
    ordinary: int = 4500
    windows: int = 4          # of each ordinary text, by hash, that train the common segments
    segments: int = 1_000
    base_bytes: int = 6_144
    evidence: tuple[float, ...] = (20.0, 35.0, 60.0, 90.0)


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    raw: bool
    center: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float


def text_windows(text: str | None) -> list[bytes]:
    data = (text or "").lower().encode("utf-8", "replace")
    return [data[k:k + WINDOW + OVERLAP] for k in range(0, len(data), WINDOW)]


def _compressor(content: bytes, raw: bool) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        compression_level=3, window_log=15, hash_log=13, chain_log=13, search_log=5, min_match=4,
        target_length=16, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False,
        write_checksum=False, write_dict_id=False)
    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_AUTO
    trained = zstandard.ZstdCompressionDict(content, dict_type=kind)
    trained.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=trained, compression_params=params)


def window_features(texts, ordinary: bytes, toxic: bytes, raw: bool) -> np.ndarray:
    plain, bad = _compressor(ordinary, raw), _compressor(toxic, raw)
    out = np.zeros((len(texts), 3 + len(_MARGINS)))
    for row, text in enumerate(texts):
        windows = text_windows(text)
        if windows:
            gain = np.array([len(plain.compress(w)) - len(bad.compress(w)) for w in windows])
            out[row] = [gain.mean(), gain.max(), np.log1p(len(windows)),
                        *(np.mean(gain >= m) for m in _MARGINS)]
    return out


def _chosen_windows(n: int):
    """The ``n`` windows with the smallest checksums, of every text."""
    def run(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                chosen = sorted(set(text_windows(text)), key=lambda w: (zlib.crc32(w), w))[:n]
                yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.binary())], ["w"])
    return run


def _pieces(batches):
    """Word pieces with the number of toxic and ordinary texts that hold them."""
    counts = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = {b" " + w for w in _WORD.findall((text or "").lower().encode("utf-8", "replace"))}
            counts[toxic].update({w[i:i + k] for w in words for k in _PIECES for i in range(len(w) - k + 1)})
    keys = list(counts[0].keys() | counts[1].keys())
    for k in range(0, len(keys), 100_000):
        part = keys[k:k + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.binary()), pa.array([counts[1][p] for p in part], pa.int64()),
             pa.array([counts[0][p] for p in part], pa.int64())], ["piece", "toxic", "ordinary"])


def _evidence(own: str, other: str, n_own: int, n_other: int) -> Column:
    """Likelihood-ratio statistic of a piece that is over-represented in ``own``."""
    a, b, n = F.col(own), F.col(other), n_own + n_other
    seen = a + b
    stat = 2 * (a * F.log(a * n / (seen * n_own))
                + F.when(b > 0, b * F.log(b * n / (seen * n_other))).otherwise(0.0))
    return F.when((a >= 4) & (a * n_other > b * n_own), stat).otherwise(0.0)


def _strongest(pieces: DataFrame, own: str, other: str, n_own: int, n_other: int,
               limits: FitLimits) -> list[tuple[float, bytes]]:
    """(evidence, piece) of the class's segments, strongest first. A piece that
    holds a stronger one adds only what both classes share, and one inside a
    stronger piece adds nothing, so neither is taken."""
    rows = pieces.select("piece", _evidence(own, other, n_own, n_other).alias("g")) \
        .where(F.col("g") > min(limits.evidence)) \
        .orderBy(F.desc("g"), F.desc(F.length("piece")), "piece").limit(limits.segments).collect()
    kept: list[tuple[float, bytes]] = []
    for g, piece in ((r.g, bytes(r.piece)) for r in rows):
        if not any(piece in k or k in piece for _, k in kept):
            kept.append((g, piece))
    return kept


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rows: np.ndarray | None = None) -> tuple:
    """Newton steps on a ridge-penalised logistic curve over standardised columns;
    ``rows`` are the weights of the rows."""
    r = np.ones(len(x)) if rows is None else rows
    center = np.average(x, axis=0, weights=r)
    scale = np.sqrt(np.average((x - center) ** 2, axis=0, weights=r))
    scale[scale == 0] = 1.0
    z = np.hstack([np.ones((len(x), 1)), (x - center) / scale])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (r * p * (1 - p))[:, None]).T @ z + np.diag(penalty),
                               z.T @ (r * (y - p)) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(center), tuple(scale), tuple(w[1:]), float(w[0])


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose label is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _known(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic``: every labelled document that is not held out."""
    return labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")) \
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")


def _sample(docs: DataFrame, known: DataFrame, limits: FitLimits) -> DataFrame:
    """``text, toxic, fold``: the bounded labelled sample, one row a document."""
    pick = [known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
            for value, n in ((1, limits.toxic), (0, limits.ordinary))]
    ids = pick[0].unionByName(pick[1])
    return docs.select("doc_id", "text") \
        .join(F.broadcast(ids), "doc_id") \
        .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")) \
        .select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)).alias("fold"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, limits: FitLimits = FitLimits()) -> ToxicityModel:
    """Fits on labelled rows that are not held out. Three quarters of the
    sample train the dictionaries, the rest calibrates, weighted to the shares that the
    classes have among all labelled rows, so the bounds of the sample do not move the
    score. Where one class has no sample the curve is flat at the share of toxic rows."""
    known = stored(_known(docs, labels), "toxicity-known")
    total = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = stored(_sample(docs, known, limits), "toxicity-sample")
    train = sample.where("fold > 0")
    n = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_ordinary = n.get(1, 0), n.get(0, 0)
    segments = {"toxic": [], "ordinary": []}
    if n_toxic and n_ordinary:
        pieces = stored(train.select("text", "toxic")
                        .mapInArrow(_pieces, "piece binary, toxic long, ordinary long")
                        .groupBy("piece").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
                        .where("toxic >= 4 OR ordinary >= 4"), "toxicity-pieces")
        segments = {"toxic": _strongest(pieces, "toxic", "ordinary", n_toxic, n_ordinary, limits),
                    "ordinary": _strongest(pieces, "ordinary", "toxic", n_ordinary, n_toxic, limits)}
    windows = sorted(bytes(r.w) for r in train.where("toxic = 0").select("text").mapInArrow(  # limits.windows a text
        _chosen_windows(limits.windows), "w binary").collect())
    raw = False
    try:
        base = zstandard.train_dictionary(limits.base_bytes, windows, k=64, d=6, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text to train on
        base, raw = b"".join(windows)[-limits.base_bytes:].rjust(64, b" "), True
    models = [_calibrated(sample.where("fold = 0"), base, raw, segments, level, total)
              for level in limits.evidence]
    return min(models, key=lambda m: m[0])[1]


def _calibrated(sample: DataFrame, base: bytes, raw: bool, segments: dict, level: float,
                total: dict[int, int]) -> tuple[float, ToxicityModel]:
    """(log loss, model) with the segments whose evidence reaches ``level``. ``total``
    counts all labelled rows of each class."""
    tails = {c: b"".join(p for g, p in reversed(s) if g >= level) for c, s in segments.items()}
    longest = max(map(len, tails.values()))
    # equal lengths keep the shared part at the same distance in both
    ordinary, toxic = (base + b"\0" * (longest - len(tails[c])) + tails[c] for c in ("ordinary", "toxic"))

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series(list(window_features(texts, ordinary, toxic, raw)))

    seen = sample.select("toxic", features("text").alias("x")).collect()
    y = np.array([r.toxic for r in seen], float)
    if len(set(y)) < 2:
        share = total.get(1, 0) / sum(total.values()) if total else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        k = 3 + len(_MARGINS)
        return 0.0, ToxicityModel(ordinary, toxic, raw, (0.0,) * k, (1.0,) * k, (0.0,) * k,
                                  float(np.log(share / (1 - share))))
    x = np.array([r.x for r in seen])
    bad = total[1] / sum(total.values())
    rows = np.where(y == 1, bad / y.mean(), (1 - bad) / (1 - y.mean()))  # mean 1
    center, scale, weights, intercept = _logistic(x, y, rows=rows)
    margin = intercept + ((x - center) / scale) @ np.array(weights)
    loss = float(np.mean(rows * (np.logaddexp(0, margin) - y * margin)))
    return loss, ToxicityModel(ordinary, toxic, raw, center, scale, weights, intercept)


def toxicity_score(model: ToxicityModel, text: str = "text") -> Column:
    center, scale, weights = (np.array(v) for v in (model.center, model.scale, model.weights))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = window_features(texts, model.ordinary, model.toxic, model.raw)
        margin = model.intercept + ((x - center) / scale) @ weights
        return pd.Series(1 / (1 + np.exp(-np.clip(margin, -30, 30))))

    return score(F.col(text))


def score_documents(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Null and empty texts have no window and get the curve's value for that;
    very long texts are scored over all their windows; repeated rows get equal
    scores; a null doc_id is passed through and counts as not held out; an
    empty table gives no rows. Only the text decides the score."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       toxicity_score(model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, all columns kept."""
    return docs.where(toxicity_score(model) < threshold)
