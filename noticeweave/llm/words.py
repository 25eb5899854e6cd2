"""Word and shingle hashes of whole Arrow batches, by numpy over the bytes of the texts.

Separators are ASCII, so work on UTF-8 bytes finds the same words as work on code points. Hashes are 64 bits: two different
words or shingles agree with a probability near 2**-64, which a comparison of two documents never sees in practice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at a time; bounds the temporary arrays whatever the length of a text.
CHUNK = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_SPACED = np.ones(256, bool)
_SPACED[[0x20, 9, 10, 11, 12, 13]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x61:0x7B] = _ALNUM[0x80:] = True
#: Which bytes belong to words, after A-Z are lower-cased.
KINDS = {"spaced": _SPACED, "alnum": _ALNUM}

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for k, base in enumerate((_BASE, inverse)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one more than there are texts); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]] if len(ends) else data[:0], (ends - ends[0]) if len(ends) else np.zeros(1, np.int64)


def _hash_words(data: np.ndarray, breaks: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one stretch; no word goes on over a place in breaks."""
    data = _LOWER[data]
    word = inside[data]
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    at = breaks[(breaks > 0) & (breaks < len(data))]
    opens[at] = word[at]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    closes = word.copy()
    closes[:-1] &= ~word[1:]
    closes[at - 1] = word[at - 1]
    ends = np.flatnonzero(closes) + 1
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return starts, mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(column: pa.Array, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For stretches of texts: the first text's index, all their word hashes, and each text's first word (one more than texts)."""
    inside = KINDS[kind]
    data, at = text_bytes(column)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK, "right")) - 1)
        part, offsets = data[at[first] : at[last]], at[first : last + 1] - at[first]
        if len(part) <= 2 * CHUNK:
            starts, hashes = _hash_words(part, offsets, inside)
        else:  # one text longer than a chunk: cut between words
            starts_, hashes_, begin = [], [], 0
            while begin < len(part):
                end = min(len(part), begin + CHUNK)
                while end < len(part) and inside[_LOWER[part[end]]]:
                    more = np.flatnonzero(~inside[_LOWER[part[end : end + CHUNK]]])
                    end = end + int(more[0]) if len(more) else min(len(part), end + CHUNK)
                s, h = _hash_words(part[begin:end], np.zeros(0, np.int64), inside)
                starts_.append(s + begin)
                hashes_.append(h)
                begin = end
            starts, hashes = np.concatenate(starts_), np.concatenate(hashes_)
        yield first, hashes, np.searchsorted(starts, offsets)
        first = last


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, in order; with fewer words, but not none, of the whole sequence as one."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    size = min(n, k)
    total = words[: n - size + 1].copy()
    for j in range(1, size):
        total *= np.uint64(0xA24BAED4963EE407)
        total += words[j : n - size + 1 + j]
    return mix(total + np.uint64(size))


def text_shingles(column: pa.Array, k: int, kind: str) -> Iterator[np.ndarray]:
    """Each text's shingles in order, repeats included."""
    for _, words, at in word_hashes(column, kind):
        rolled = shingles(words, k) if len(words) >= k else words[:0]
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield rolled[a : b - k + 1] if b - a >= k else shingles(words[a:b], k)


def distinct(values: np.ndarray) -> np.ndarray:
    """Ascending, without repeats (np.unique with less overhead)."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) > 1 else values
