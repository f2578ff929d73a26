"""Removal of lines and passages that occur earlier in the corpus.

A text is cut into units: a unit ends at every line end, and, inside long
lines, where the hash of two words is the least of all within ``min_words - 1``
words to both sides. What stands farther off has no say, so a passage gives the
same units wherever it stands, but for the ends. Units are normalised (ASCII case
and all punctuation and space ignored), digested, and grouped over the corpus.
The occurrence with the smallest (doc_id, text hash, offset) stays, the others
are cut out; everything else stays byte for byte. With ``extend``, a run of
units that are cut out grows word by word to both sides for as long as the words
equal those beside the occurrence that stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import body, doc_key, stored
from .words import mix, run_hashes, word_table

MIN_WORDS = 5
MAX_WORDS = 64
REACH = 64

_UNIT = "key_id long, key_hash long, start long, stop long, d1 long, d2 long"
_END = "key_id long, key_hash long, at long, side long, kept_id long, kept_hash long, kept_start long"
_LEFT, _RIGHT = -1, -2


def _layout(text: bytes, min_words: int):
    """(starts, hashes, first): place and hash of each word, first word of each unit."""
    starts, _, hashes = word_table(text)
    n = len(hashes)
    if not n:
        return starts, hashes, np.empty(0, np.int64)
    lines = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    line = np.searchsorted(lines, starts)
    head = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    size = np.diff(np.append(head, n))
    at = np.arange(n) - np.repeat(head, size)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    pair = np.append(none, mix(hashes[:-1] * np.uint64(3) + hashes[1:]))
    pair[(at < min_words) | (np.repeat(size, size) - at < min_words)] = none
    cut = pair != none  # places of one line only are ever this near to each other
    for k in range(1, min(min_words, n)):
        cut[k:] &= pair[k:] < pair[:-k]
        cut[:-k] &= pair[:-k] <= pair[k:]
    first = np.union1d(head, np.flatnonzero(cut))
    most = max(MAX_WORDS, 8 * min_words)
    long = np.flatnonzero(np.diff(np.append(first, n)) > most + min_words)
    if len(long):  # words repeated with a short period
        ends = np.append(first[1:], n)
        first = np.union1d(first, np.concatenate(
            [np.arange(first[k], ends[k] - min_words, most) for k in long.tolist()]))
    return starts, hashes, first


def text_units(text: bytes, min_words: int = MIN_WORDS):
    """(start, stop, d1, d2) of the units. Spans are byte ranges that lie side
    by side: each reaches from its first word to the first word of the next."""
    starts, hashes, first = _layout(text, min_words)
    n = len(hashes)
    if not n:
        return (np.empty(0, np.int64),) * 4
    last = np.append(first[1:], n)
    again = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    d1, d2 = run_hashes(hashes, first, last), run_hashes(again, first, last)
    stop = np.append(starts[first[1:]], len(text))
    enough = last - first >= min_words
    return starts[first][enough], stop[enough], d1[enough].view(np.int64), d2[enough].view(np.int64)


def _units(min_words: int):
    def run(batches):
        for batch in batches:
            parts = []
            for key_id, key_hash, text in zip(*(batch.column(i) for i in range(3))):
                unit = text_units(text.as_py(), min_words)
                k = len(unit[0])
                parts.append((np.full(k, key_id.as_py()), np.full(k, key_hash.as_py()), *unit))
            cols = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["key_id", "key_hash", "start", "stop", "d1", "d2"])

    return run


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``key_id, key_hash, start, stop, kept``: the units that are not the earliest
    with their digest, and the earliest. ``docs`` has ``key_id, key_hash, body``."""
    units = stored(docs.mapInArrow(_units(min_words), _UNIT), "units")
    shared = stored(units.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select("d1", "d2"), "units-shared")
    live = stored(units.join(shared, ["d1", "d2"], "left_semi"), "units-live")
    keepers = stored(live.groupBy("d1", "d2")
                     .agg(F.min(F.struct("key_id", "key_hash", "start")).alias("kept")), "units-kept")
    return live.join(keepers, ["d1", "d2"]) \
        .where(F.struct("key_id", "key_hash", "start") != F.col("kept")) \
        .select("key_id", "key_hash", "start", "stop", "kept")


def _run_ends(batches):
    """The outer sides of each run of removed units, with the unit kept for the last one."""
    for batch in batches:
        out = []
        for key_id, key_hash, units in zip(*(c.to_pylist() for c in batch.columns)):
            units = {(u["start"], u["stop"]): u["kept"] for u in units}
            opens, closes = {a for a, _ in units}, {b for _, b in units}
            for (a, b), kept in units.items():
                kept = (kept["key_id"], kept["key_hash"], kept["start"])
                if a not in closes:
                    out.append((key_id, key_hash, a, _LEFT, *kept))
                if b not in opens:
                    out.append((key_id, key_hash, b, _RIGHT, *kept))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 7)], _END.replace(" long", "").split(", "))


def _beside(min_words: int):
    """The word hashes left (nearest first) and right of the asked units: ``REACH`` words,
    and in any case all up to the far end of the next unit of ``min_words``."""
    def table(out):
        cols = list(zip(*out)) if out else [()] * 5
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())],
            ["kept_id", "kept_hash", "kept_start", "side", "words"])

    def run(batches):
        for batch in batches:
            out, held = [], 0
            for key_id, key_hash, text, asked in zip(*(batch.column(i) for i in range(4))):
                starts, hashes, first = _layout(text.as_py(), min_words)
                last = np.append(first[1:], len(hashes))
                whole = np.flatnonzero(last - first >= min_words)
                for a in asked.as_py():
                    k = np.searchsorted(first, np.searchsorted(starts, a["kept_start"]))
                    near = np.searchsorted(whole, k)
                    if a["side"] == _LEFT:
                        far = min(first[whole[near - 1]] if near else 0, max(0, first[k] - REACH))
                        words = hashes[far:first[k]][::-1]
                    else:
                        far = max(last[whole[near + 1]] if near + 1 < len(whole) else len(hashes), last[k] + REACH)
                        words = hashes[last[k]:far]
                    out.append((key_id.as_py(), key_hash.as_py(), a["kept_start"], a["side"], words.tobytes()))
                    held += len(out[-1][-1])
                    if held > 1 << 23:
                        yield table(out)
                        out, held = [], 0
            yield table(out)

    return run


def _grown(docs: DataFrame, units: DataFrame, min_words: int) -> DataFrame:
    """``key_id, key_hash, start, stop, words``: for each outer side of a run of
    removed units its place, the side, and the words beside the kept occurrence."""
    ends = stored(units.groupBy("key_id", "key_hash")
                  .agg(F.collect_list(F.struct("start", "stop", "kept")).alias("units"))
                  .mapInArrow(_run_ends, _END), "units-ends")
    sites = ends.select(F.col("kept_id").alias("key_id"), F.col("kept_hash").alias("key_hash"),
                        "kept_start", "side").distinct() \
        .groupBy("key_id", "key_hash").agg(F.collect_list(F.struct("kept_start", "side")).alias("asked"))
    beside = docs.join(sites, ["key_id", "key_hash"]).select("key_id", "key_hash", "body", "asked") \
        .mapInArrow(_beside(min_words), "kept_id long, kept_hash long, kept_start long, side long, words binary") \
        .distinct()  # rows equal in id and text
    return ends.join(stored(beside, "units-beside"), ["kept_id", "kept_hash", "kept_start", "side"]) \
        .select("key_id", "key_hash", F.col("at").alias("start"), F.col("side").alias("stop"), "words")


def _grow(text: bytes, spans: list[dict]) -> list[tuple[int, int]]:
    """Byte ranges of the units, and of the words beside them that are equal."""
    found = [(u["start"], u["stop"]) for u in spans if u["words"] is None]
    ends = [u for u in spans if u["words"]]
    if ends:
        starts, _, hashes = word_table(text)
        n = len(starts)
        edge = np.append(starts, len(text))
    for u in ends:
        i, words = int(np.searchsorted(starts, u["start"])), np.frombuffer(u["words"], np.uint64)
        own = hashes[max(0, i - len(words)):i][::-1] if u["stop"] == _LEFT else hashes[i:i + len(words)]
        unlike = np.flatnonzero(own != words[:len(own)])
        k = int(unlike[0]) if len(unlike) else len(own)
        found.append((int(edge[i - k]), u["start"]) if u["stop"] == _LEFT else (u["start"], int(edge[min(n, i + k)])))
    return sorted((a, b) for a, b in found if a < b)


def _cut(batches):
    for batch in batches:
        kept, spans, cut = [], [], []
        for text, units in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            joined = []
            for a, b in _grow(text, units.as_py() or []):
                if joined and joined[-1][1] >= a:
                    joined[-1][1] = max(b, joined[-1][1])
                else:
                    joined.append([a, b])
            rest, at = [], 0
            for a, b in joined:
                rest.append(text[at:a])
                at = b
            kept.append(b"".join([*rest, text[at:]]).decode("utf-8", "replace"))
            spans.append(joined)
            cut.append(sum(b - a for a, b in joined))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[2:], pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
             pa.array(cut, pa.int64())],
            [*batch.schema.names[2:], "_kept", "_spans", "_cut_bytes"])


def _with_cuts(docs: DataFrame, carry: list[str], min_words: int, extend: bool) -> DataFrame:
    """The columns ``carry`` of each row, with ``_kept``, ``_spans``, ``_cut_bytes``."""
    key_id, key_hash = doc_key()
    rows = docs.select(key_id, key_hash, body().alias("body"),
                       *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)])
    keyed = rows.select("key_id", "key_hash", "body")
    runs = repeated_units(keyed, min_words)
    spans = runs.select("key_id", "key_hash", "start", "stop", F.lit(None).cast("binary").alias("words"))
    if extend:
        runs = stored(runs, "units-repeated")
        spans = runs.select("key_id", "key_hash", "start", "stop", F.lit(None).cast("binary").alias("words")) \
            .unionByName(_grown(keyed, runs, min_words))
    runs = spans.groupBy("key_id", "key_hash") \
        .agg(F.collect_list(F.struct("start", "stop", "words")).alias("units"))
    joined = rows.join(runs, ["key_id", "key_hash"], "left") \
        .select("body", "units", *[f"_c{i}" for i in range(len(carry))])
    schema = joined.drop("body", "units").schema \
        .add("_kept", T.StringType()).add("_spans", T.ArrayType(T.ArrayType(T.LongType()))) \
        .add("_cut_bytes", T.LongType())
    return joined.mapInArrow(_cut, schema)


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, extend: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_text`` for every row.

    ``spans`` are the removed ``[start, end)`` byte ranges of the input text, so
    kept bytes can be traced to their place. Null texts count as empty; texts
    under ``min_words`` words are untouched. Rows equal in id and text are one
    document to the ranking: all of them keep or lose the same units. Rows
    without id rank first. An empty table gives no rows; other columns are
    ignored."""
    out = _with_cuts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                     ["doc_id", "text"], min_words, extend)
    return out.select(F.col("_c0").alias("doc_id"),
                      F.octet_length(F.coalesce("_c1", F.lit(""))).cast("long").alias("n_bytes"),
                      F.col("_cut_bytes").alias("n_removed"), F.col("_spans").alias("spans"),
                      F.col("_kept").alias("kept_text"))


def drop_repeated_units(docs: DataFrame, min_words: int = MIN_WORDS, extend: bool = False) -> DataFrame:
    """The documents with their repeated units cut out, all columns kept; a null
    text stays null."""
    out = _with_cuts(docs, docs.columns, min_words, extend)
    return out.select(*[
        (F.when(F.col(f"_c{i}").isNotNull(), F.col("_kept")) if c == "text" else F.col(f"_c{i}")).alias(c)
        for i, c in enumerate(docs.columns)])
