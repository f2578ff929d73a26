"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

Each Arrow batch of texts is cut into words by the tokenizer's pattern. The
distinct words that the task has not met yet are laid out as symbols in one
flat array, and all of them are merged together: a round finds the rank of
every adjacent pair by binary search over the sorted pair keys, takes each
word's lowest, merges all its places at once, and puts words without a mergeable
pair aside. Texts are then assembled from the words' ids.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body

#: Fixed value: the published word pattern of this vocabulary, white space
#: spelled out as Unicode's White_Space.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")

_NONE = np.iinfo(np.int64).max
_CACHE_WORDS = 150_000


def _byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in the vocabulary file:
    printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """What the tasks need of a tokenizer file."""
    tokens: tuple[bytes, ...]      # bytes of each id
    byte_ids: np.ndarray           # id of each single byte
    keys: np.ndarray               # sorted left * size + right
    ranks: np.ndarray              # rank of the pair, in the order of keys
    merged: np.ndarray             # id that the pair becomes
    special: dict[str, int]

    @staticmethod
    def load(path: str) -> "Vocabulary":
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], _byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = model["vocab"]
        size = max([*ids.values(), *special.values()]) + 1
        tokens = [b""] * size
        for token, i in ids.items():
            tokens[i] = bytes(letters[c] for c in token)
        for token, i in special.items():
            tokens[i] = token.encode()
        byte_ids = np.zeros(256, np.int64)
        for letter, b in letters.items():
            byte_ids[b] = ids[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        return Vocabulary(tuple(tokens), byte_ids, keys[order], order.astype(np.int64),
                          np.array([ids[a + b] for a, b in pairs], np.int64)[order], special)


def merge_words(words: list[bytes], vocab: Vocabulary) -> list[np.ndarray]:
    """Token ids of each word."""
    lengths = np.array([len(w) for w in words], np.int64)
    symbols = vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    size = len(vocab.tokens)
    done_ids, done_owner = [], []
    while len(symbols):
        inside = owner[1:] == owner[:-1]
        key = np.where(inside, symbols[:-1] * size + symbols[1:], -1)
        at = np.searchsorted(vocab.keys, key)
        at[at == len(vocab.keys)] = 0
        known = vocab.keys[at] == key
        rank = np.append(np.where(known, vocab.ranks[at], _NONE), _NONE)
        first = np.flatnonzero(np.append(True, ~inside))
        counts = np.diff(np.append(first, len(symbols)))
        lowest = np.minimum.reduceat(rank, first)
        open_word = np.repeat(lowest < _NONE, counts)
        if not open_word.all():
            done_ids.append(symbols[~open_word])
            done_owner.append(owner[~open_word])
            keep = np.flatnonzero(open_word)
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            at = np.append(at, 0)[keep]
            counts, lowest = counts[lowest < _NONE], lowest[lowest < _NONE]
            if not len(symbols):
                break
        else:
            at = np.append(at, 0)
        hit = np.flatnonzero(rank == np.repeat(lowest, counts))
        # of overlapping places (one symbol repeated) every second one merges, from the left
        run = np.flatnonzero(np.append(True, np.diff(hit) != 1))
        place = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
        hit = hit[place % 2 == 0]
        symbols[hit] = vocab.merged[at[hit]]
        stays = np.ones(len(symbols), bool)
        stays[hit + 1] = False
        symbols, owner = symbols[stays], owner[stays]
    if not done_ids:
        return [np.empty(0, np.uint32) for _ in words]
    ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(words))
    return np.split(ids[order].astype(np.uint32), np.cumsum(counts)[:-1])


class Encoder:
    """Encodes texts; remembers up to ``_CACHE_WORDS`` words within a task."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.known: dict[str, np.ndarray] = {}
        names = sorted(vocab.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def _words(self, text: str) -> list[str]:
        if self.special is None or not any(s in text for s in self.vocab.special):
            return PATTERN.findall(text)
        out = []
        for k, part in enumerate(self.special.split(text)):
            # an odd part is a special token; U+0000 before it keeps it apart from a word
            out += ["\0" + part] if k % 2 else PATTERN.findall(part)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self._words(t) for t in texts]
        if len(self.known) > _CACHE_WORDS:
            self.known = {}
        known = self.known
        new = [w for w in set().union(*cut) if w not in known]
        marked = {"\0" + s: i for s, i in self.vocab.special.items()}
        plain = [w for w in new if w not in marked]
        if plain:
            known.update(zip(plain, merge_words([w.encode("utf-8") for w in plain], self.vocab)))
        known.update({w: np.array([marked[w]], np.uint32) for w in new if w in marked})
        none = np.empty(0, np.uint32)
        return [np.concatenate([known[w] for w in words]) if words else none for words in cut]


def decode(ids: np.ndarray, vocab: Vocabulary) -> str:
    tokens = vocab.tokens
    return b"".join([tokens[i] for i in ids.tolist()]).decode("utf-8", "replace")


def _slices(bodies, chars: int = 1 << 20):
    """The UTF-8 texts, decoded, in runs of about ``chars`` characters: the words
    and ids of one run at a time are in memory."""
    run, used = [], 0
    for b in bodies:
        text = b.as_py().decode("utf-8", "replace")
        if run and used + len(text) > chars:
            yield run
            run, used = [], 0
        run.append(text)
        used += len(text)
    if run:
        yield run


def _encoded(vocab, decoded: bool):
    def run(batches):
        encoder = Encoder(vocab.value)
        for batch in batches:
            at = 0
            for part in _slices(batch.column(0)):
                ids = encoder.encode(part)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
                lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()),
                                                      pa.array(np.concatenate(ids), pa.int64()))
                back = [pa.array([hashlib.sha256(decode(x, vocab.value).encode("utf-8")).hexdigest() for x in ids],
                                 pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, len(ids)) for c in batch.columns[1:]), lists.cast(pa.list_(pa.int64())), *back],
                    [*batch.schema.names[1:], "ids", *["back"] * decoded])
                at += len(ids)

    return run


def _digested(vocab):
    def run(batches):
        encoder = Encoder(vocab.value)
        for batch in batches:
            doc_ids = batch.column(0)
            counts, id_hashes, text_hashes = [], [], []
            for part in _slices(batch.column(1)):
                for ids in encoder.encode(part):
                    counts.append(len(ids))
                    id_hashes.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    text_hashes.append(hashlib.sha256(decode(ids, vocab.value).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()),
                 pa.array(text_hashes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _decoded(vocab):
    def run(batches):
        for batch in batches:
            texts = [decode(np.array(ids.as_py() or [], np.int64), vocab.value) for ids in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())],
                                             [*batch.schema.names[1:], "text"])

    return run


def encode_texts(docs: DataFrame, vocabulary_path: str, decoded: bool = False) -> DataFrame:
    """All columns of ``docs`` and ``token_ids`` (array of long); with ``decoded`` also
    ``decoded_sha256``, the digest of the text that the ids give back.

    A null text counts as empty and has no ids; the text column itself stays as
    it is. Special tokens that stand in a text become their ids. A column named
    ``token_ids`` is replaced. An empty table gives no rows."""
    vocab = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))
    added = {"ids": "token_ids"} | ({"back": "decoded_sha256"} if decoded else {})
    names = [c for c in docs.columns if c not in added.values()]
    rows = docs.select(body().alias("_body"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)])
    schema = rows.drop("_body").withColumn("ids", F.array().cast("array<bigint>")).schema
    if decoded:
        schema = schema.add("back", "string")
    out = rows.mapInArrow(_encoded(vocab, decoded), schema)
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)],
                      *[F.col(c).alias(name) for c, name in added.items()])


def decode_ids(rows: DataFrame, vocabulary_path: str) -> DataFrame:
    """The rows of ``encode_texts`` with ``text`` made anew from ``token_ids``;
    null ids give an empty text."""
    vocab = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))
    names = [c for c in rows.columns if c != "text"]
    data = rows.select(F.col("token_ids").alias("_ids"),
                       *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)])
    schema = data.drop("_ids").withColumn("text", F.lit("")).schema
    out = data.mapInArrow(_decoded(vocab), schema)
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)], "text")


def token_digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row: the ids as
    little-endian 32-bit numbers, and the text decoded from them. Null texts
    count as empty; a null doc_id is passed through; repeated rows are kept; an
    empty table gives no rows; other columns are ignored."""
    vocab = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("body")) \
        .mapInArrow(_digested(vocab), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
