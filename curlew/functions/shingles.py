"""Hashed word shingles of whole texts in numpy: a text's set is a sorted array of distinct 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text worked on at once.
PIECE = 2 << 20
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word data[start:end], eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    length = end - start
    out = _mix(length.astype(np.uint64))
    todo, at = np.arange(len(start)), start
    while len(todo):
        n = np.minimum(end[todo] - at, 8)
        word = np.zeros(len(todo), np.uint64)
        for k in range(8):
            word |= np.where(k < n, padded[at + k], 0).astype(np.uint64) << np.uint64(8 * k)
        out[todo] = _mix(out[todo] * np.uint64(0x9E3779B97F4A7C15) + word)
        more = n == 8
        todo, at = todo[more], at[more] + 8
        more = at < end[todo]
        todo, at = todo[more], at[more]
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 3) -> list[np.ndarray]:
    """The sets of texts data[offsets[k]:offsets[k + 1]] of lower-cased UTF-8 bytes; a shorter text is one shingle."""
    word = _WORD[data]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    # a word ends where its text does
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    cut = cut[word[cut] & word[cut - 1]] if len(cut) else cut
    start = np.sort(np.concatenate([edge[::2], cut]))
    end = np.sort(np.concatenate([edge[1::2], cut]))
    hashes = _hash_words(data, start, end)
    first = np.searchsorted(start, offsets)
    grams = np.full(len(hashes), size, np.uint64)
    for k in range(size):
        grams[: len(hashes) - k] = _mix(grams[: len(hashes) - k] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1].view(np.int64)))
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                one = _mix(one * np.uint64(0x9E3779B97F4A7C15) + hashes[k])
            out.append(one.view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def each_set(low: pa.Array, size: int = 3) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(row of the first, sets) of stretches of at most PIECE bytes, or one text, of a binary array without nulls."""
    at, texts = 0, []
    held = 0
    for k, x in enumerate(low):
        x = x.as_py()
        if texts and held + len(x) > PIECE:
            yield at, _sets(texts, size)
            at, texts, held = k, [], 0
        texts.append(x)
        held += len(x)
    if texts:
        yield at, _sets(texts, size)


def _sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    return shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets, size)


def _lower(text: Column) -> Column:
    return F.lower(text).cast("binary").alias("_low")


def with_sets(df: DataFrame, text: Column, size: int = 3) -> DataFrame:
    """seq and its set `sh` of the rows whose text isn't null."""

    def run(batches):
        for batch in batches:
            seq = batch.column(0)
            for at, sets in each_set(batch.column(1), size):
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                sh = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([seq.slice(at, len(sets)), sh], ["seq", "sh"])

    return df.filter(text.isNotNull()).select("seq", _lower(text)).mapInArrow(run, "seq long, sh array<long>")


class Classes:
    """Classes of set sizes for pairs of Jaccard >= t: sizes of a pair are of one class or of two that follow.

    The scheme of class c is for pairs whose smaller set is of class c: such sets differ in at most `most` members, so of
    `parts` ranges of hashes over `most` are equal, at least `spare` + 1 of them.
    """

    def __init__(self, t: float):
        self.t, self.low = t, [1]

    def of(self, n: np.ndarray) -> np.ndarray:
        while self.low[-1] <= n.max(initial=0):
            self.low.append(int(self.low[-1] / self.t + 1e-9) + 1)
        return np.searchsorted(self.low, n, "right") - 1

    def scheme(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts, spare) of classes."""
        low = np.array([*self.low, int(self.low[-1] / self.t + 1e-9) + 1], np.int64)
        top = low[c + 1] - 1
        most = np.floor((1 - self.t) / (1 + self.t) * (top + np.floor(top / self.t + 1e-9)) + 1e-6).astype(np.int64)
        spare = (most + 3) // 4
        return most + 1 + spare, spare


def _about(n: np.ndarray, need: np.ndarray, back: np.ndarray | int) -> np.ndarray:
    """Set size, signatures that a pair has in common at least (by this set) and scheme (1: the class before its own)."""
    return (n.astype(np.int64) << 24) | (np.minimum(need, (1 << 23) - 1) << 1) | back


def _signatures(sets: list[np.ndarray], classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, place of its set, about it): what two sets of Jaccard >= t have in common in the smaller's scheme.

    A scheme cuts the hashes into ranges, and a range's signature covers all members in it, so sets that agree in a
    range share it. Empty ranges tell little: only sets with so many of them that a pair might agree in those alone have
    signatures for them. A pair of which one set has no signatures for its empty ranges agrees in spare + 1 ranges less
    those; else in spare + 1 ranges with signatures.
    """
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets).view(np.uint64) ^ np.uint64(1 << 63)  # unsigned in the order of the sets
    mixed, top = _mix(flat), flat >> np.uint64(32)
    owner = np.repeat(np.arange(len(sets)), n)
    own = classes.of(n)
    sigs, places, abouts = [], [], []
    for back in (0, 1):
        c = own - back
        valid = (n > 0) & (c >= 0)
        parts, spare = classes.scheme(np.maximum(c, 0))
        parts, spare = np.where(valid, parts, 0), np.where(valid, spare, 0)
        base = np.cumsum(parts) - parts
        total = int(parts.sum())
        use = valid[owner]
        cell = base[owner[use]] + ((top[use] * parts[owner[use]].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        start = np.flatnonzero(np.diff(cell, prepend=-1))
        sums, counts = np.zeros(total, np.uint64), np.bincount(cell, minlength=total).astype(np.uint64)
        if len(start):
            sums[cell[start]] = np.add.reduceat(mixed[use], start)
        at = np.repeat(np.arange(len(sets)), parts)
        salt = _mix((np.maximum(c, 0)[at].astype(np.uint64) << np.uint64(32)) + (np.arange(total) - base[at]).astype(np.uint64))
        sig = _mix(salt + _mix(sums + counts))
        empty = counts == 0
        n_empty = np.bincount(at[empty], minlength=len(sets))
        many = n_empty > spare
        need = spare + 1 - np.where(many, 0, n_empty)
        out = ~empty | many[at]
        sigs.append(sig[out].view(np.int64))
        places.append(at[out])
        abouts.append(_about(n, need, back)[at[out]])
    return np.concatenate(sigs), np.concatenate(places), np.concatenate(abouts)


def signatures(df: DataFrame, text: Column, threshold: float, size: int = 3) -> DataFrame:
    """(sig, seq, about): texts whose sets have Jaccard >= threshold share as many signatures as `about` says."""

    def run(batches):
        classes = Classes(threshold)
        for batch in batches:
            seq = batch.column(0).to_numpy()
            for at, sets in each_set(batch.column(1), size):
                sig, place, about = _signatures(sets, classes)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(seq[at : at + len(sets)][place]), pa.array(about)], ["sig", "seq", "about"])

    return df.filter(text.isNotNull()).select("seq", _lower(text)).mapInArrow(run, "sig long, seq long, about long")


def bands(df: DataFrame, text: Column, bands: int, rows: int, size: int = 3) -> DataFrame:
    """(sig, seq, about) with one signature a band of MinHash values."""
    rng = np.random.default_rng(7)
    factor = rng.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, bands * rows, np.uint64)

    def run(batches):
        for batch in batches:
            seq = batch.column(0).to_numpy()
            for at, sets in each_set(batch.column(1), size):
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                if not len(full):
                    continue
                flat = _mix(np.concatenate(sets).view(np.uint64))
                start = (np.cumsum(n) - n)[full]
                for b in range(bands):
                    sig = np.full(len(full), _mix(np.array([b], np.uint64))[0])
                    for k in range(b * rows, (b + 1) * rows):
                        sig = _mix(sig + np.minimum.reduceat(_mix_low(flat, factor[k], shift[k]), start))
                    yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(seq[at : at + len(sets)][full]), pa.array(_about(n[full], np.ones(len(full), np.int64), 0))], ["sig", "seq", "about"])

    return df.filter(text.isNotNull()).select("seq", _lower(text)).mapInArrow(run, "sig long, seq long, about long")


def _mix_low(x: np.ndarray, factor: np.uint64, shift: np.uint64) -> np.ndarray:
    x = (x ^ shift) * factor
    return (x ^ (x >> np.uint64(32))) * factor
