"""Hashed word shingles of a batch of texts, computed on the bytes of the whole batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_rng = np.random.RandomState(20260101)
#: A random number for each byte value, and odd multipliers for places in a word and in a shingle.
BYTE = _rng.randint(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all of them."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, STEP)]))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the texts and of the end) of a string column without nulls."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of UTF-8 ``data`` (ASCII and Latin-1 letters) and which belong to words: letters,
    digits and all beyond ASCII."""
    # two-byte capitals of Latin-1: C3 80 to C3 9E but the multiplication sign
    after_c3 = np.zeros(len(data), bool)
    after_c3[1:] = data[:-1] == 0xC3
    upper = (data >= 65) & (data <= 90) | after_c3 & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    lower = data + (upper.astype(np.uint8) << 5)
    return lower, (data >= 0x80) | ((lower >= 97) & (lower <= 122)) | ((data >= 48) & (data <= 57))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text's number) of every word: longest runs without ASCII white space, A-Z lower-cased."""
    word = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:-1]
    at = np.flatnonzero(start)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = np.flatnonzero(word)
    begin = np.searchsorted(inside, at)
    length = np.diff(np.append(begin, len(inside)))
    place = np.arange(len(inside)) - np.repeat(begin, length)
    part = BYTE[LOWER[data[inside]]] * powers(int(length.max()))[place]
    return mix(np.add.reduceat(part, begin)), np.searchsorted(offsets, at, side="right") - 1


def shingle_sets(texts: pa.Array, k: int = 4) -> list[np.ndarray]:
    """The sorted distinct hashes of the k-word shingles of each text; with fewer words the whole
    sequence is one shingle, without any the set is empty."""
    data, offsets = buffers(texts)
    word, doc = words(data, offsets)
    scale = mix(powers(k))
    count = np.bincount(doc, minlength=len(texts))
    end = np.cumsum(count)
    n = max(len(word) - k + 1, 0)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += word[i:i + n] * scale[i]
    whole = mix(total)
    out = []
    for e, c in zip(end.tolist(), count.tolist()):
        if c >= k:
            out.append(np.unique(whole[e - c:e - k + 1]))
        elif c:
            out.append(mix((word[e - c:e] * scale[:c]).sum(keepdims=True) + scale[k] * np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
