"""Poisson(1) weights of rows from md5(id-replicate), for many replicates of an Arrow batch.

MD5 runs over matrices of 32-bit words, one array operation for many rows and replicates; the
rounds that only read the id are done once for all replicates, and the last three are left out,
as they don't change the first word. Ids too long for one MD5 block go through hashlib.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa

_SHIFTS = [s for row in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in row * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_PLACES = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
_LAST = 61  # rounds up to the one that makes the first word
_BLOCK = 55  # message bytes of a single block
#: Cells of a matrix (few enough for a core's cache, many enough for a call each), and rows that
#: wait until there are so many of their cell.
_CELLS, _HELD = 49_152, 524_288


def _rounds(state, first: int, last: int, added, free, spare):
    """Rounds ``first`` to ``last`` of MD5. ``added``: for each round what is added to its words,
    in turn; ``free``: arrays that may be written, five at least; ``spare``: one more."""
    a, b, c, d = state
    for i in range(first, last):
        f = free.pop()
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        for x in added[i]:
            np.add(f, x, out=f)
        np.left_shift(f, np.uint32(_SHIFTS[i]), out=spare)
        np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=f)
        np.bitwise_or(f, spare, out=f)
        np.add(f, b, out=f)
        if i - first >= 4:  # made here, not given
            free.append(a)
        a, b, c, d = d, f, b, c
    return a, b, c, d


def _arrays(shape, n: int):
    """Arrays that begin at cache lines, each at another place of a page."""
    size = math.prod(shape)
    step = -(-size // 16) * 16 + 48
    base = np.empty(n * step + 16, np.uint32)
    at = -base.ctypes.data % 64 // 4
    return [base[at + i * step:at + i * step + size].reshape(shape) for i in range(n)]


def first_words(ids: list[bytes], endings: list[bytes]):
    """For runs of ``endings`` of one length, in their order: how many, and a matrix of the first
    32 bits (big-endian) of md5(id + ending), a row an ending, for ids of one length."""
    size, n = len(ids[0]), len(ids)
    if size + max(map(len, endings)) > _BLOCK:
        for end in endings:
            yield 1, np.array([[int.from_bytes(hashlib.md5(x + end).digest()[:4], "big") for x in ids]], np.uint32)
        return
    whole, rest = size // 4, size % 4
    raw = np.frombuffer(b"".join(x.ljust(whole * 4 + 4, b"\0") for x in ids), "<u4").reshape(n, whole + 1)
    own = np.ascontiguousarray(raw.T)
    of_id = [i for i, g in enumerate(_PLACES[:_LAST]) if g < whole]
    named = {i: np.add(own[_PLACES[i]], np.uint32(_SINES[i]), out=x) for i, x in zip(of_id, _arrays((n,), len(of_id)))}
    start = _arrays((n,), 4)
    for x, value in zip(start, _START):
        x[:] = value
    start = _rounds(start, 0, whole, {i: [x] for i, x in named.items()}, _arrays((n,), whole + 1), np.empty(n, np.uint32))
    at, most, held = 0, max(1, _CELLS // n), None
    while at < len(endings):
        some = 1
        while some < most and at + some < len(endings) and len(endings[at + some]) == len(endings[at]):
            some += 1
        tails = [(b"\0" * rest + end + b"\x80").ljust(56 - whole * 4, b"\0") + (8 * (size + len(end))).to_bytes(8, "little")
                 for end in endings[at:at + some]]
        words = np.frombuffer(b"".join(tails), "<u4").reshape(some, 16 - whole)
        added = {i: [x] for i, x in named.items()}
        for i, g in enumerate(_PLACES[:_LAST]):
            if g >= whole:
                word = words[:, g - whole] + np.uint32(_SINES[i])
                added[i] = [word[0] if (word == word[0]).all() else word[:, None]]
                if rest and g == whole:
                    added[i].append(own[whole])
        if held is None or len(held[0]) != some:
            held = _arrays((some, n), 6)
        _, word, _, _ = _rounds(start, whole, _LAST, added, held[:5], held[5])
        np.add(word, np.uint32(_START[0]), out=held[5])
        yield some, held[5].byteswap(inplace=True)  # written again by the next run
        at += some


def weighted_cells(n_resamples: int, cuts: list[float], plain: bool = False):
    """A function for mapInArrow: ``_id, label_id, pred_id`` become ``replicate, label_id, pred_id, w``,
    the weights of a task's rows summed over each cell in each replicate and, if ``plain``, the
    number of its rows as the replicate null."""
    steps = [np.uint32(x) for x in (math.ceil(c * 2**32) for c in cuts) if x < 2**32]
    endings = [str(r).encode() for r in range(n_resamples)]
    dashed = [b"-" + e for e in endings]

    def weights(ids, ends):
        out = [np.zeros(0, np.int64)]
        for _, words in first_words(ids, ends) if ends else ():
            w = (words >= steps[0]).view(np.uint8)
            more = np.empty(words.shape, bool)
            for cut in steps[1:]:
                np.greater_equal(words, cut, out=more)
                np.add(w, more.view(np.uint8), out=w)
            out.append(w.sum(axis=1, dtype=np.int64))
        return np.concatenate(out)

    def run(batches):
        sums, types = defaultdict(lambda: np.zeros(n_resamples, np.int64)), None
        count, alike, waiting = defaultdict(int), defaultdict(list), 0

        def weigh(key, size):
            # concat_ws leaves a null id and its dash out, so all rows without an id weigh the same
            if key[0] is None:
                sums[key[1:]] += size * weights([b""], endings)
            else:
                sums[key[1:]] += weights(alike[key][:size], dashed)
            del alike[key][:size]

        for batch in batches:
            types = [batch.schema.field(n).type for n in ("label_id", "pred_id")]
            for x, *cell in zip(*(batch.column(n).to_pylist() for n in ("_id", "label_id", "pred_id"))):
                x = None if x is None else x.encode()
                alike[None if x is None else len(x), *cell].append(x)
                count[tuple(cell)] += 1
            waiting += len(batch)
            for key in alike:
                while len(alike[key]) >= _CELLS or waiting > _HELD and alike[key]:
                    size = min(_CELLS, len(alike[key]))
                    weigh(key, size)
                    waiting -= size
        for key in alike:
            while alike[key]:
                weigh(key, min(_CELLS, len(alike[key])))
        for cell, w in sums.items():
            replicates, n = list(range(n_resamples)), w.tolist()
            if plain:
                replicates, n = [*replicates, None], [*n, count[cell]]
            label, pred = ([c] * len(n) for c in cell)
            yield pa.record_batch([pa.array(replicates, pa.int64()), pa.array(label, types[0]),
                                   pa.array(pred, types[1]), pa.array(n, pa.int64())],
                                  names=["replicate", "label_id", "pred_id", "w"])

    return run
