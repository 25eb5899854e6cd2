"""Cutting texts into segments for tokenizers that split by PATTERN, and joining the ids of whole batches from those of distinct segments.

PATTERN ends a piece before every run of white space, gives the run's last character to what follows if that is a space, and lets it
stand alone if not. So a text may be cut before each run, before the run's last character, and behind that if it is no space; and between
a letter and a sign behind it. The ids of the segments are the ids of the text. This holds for runs of ASCII white space; texts where other
white space stands beside them are kept whole. Segments recur, so each distinct one of a stretch is looked up once, and ids are gathered
by numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from noticeweave.llm.words import text_bytes

#: Bytes of text cut at a time; a longer text is cut alone.
CHUNK = 4 << 20
#: Segments that a worker remembers, their ids, and bytes in the longest that it does; when full they are forgotten.
REMEMBERED, POOL, LONGEST = 400_000, 4 << 20, 64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: Second bytes of the letters from U+00C0 to U+00FF, whose first byte is C3.
_SECOND = np.zeros(256, bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
#: First bytes of all white space beyond ASCII (and of other characters).
_ODD = np.zeros(256, bool)
_ODD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def segment_borders(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the segments of the texts begin, and the end; at: where the texts begin, and the end."""
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    starts = np.zeros(n + 1, bool)
    starts[at] = True
    space = _SPACE[data]
    opens = space.copy()  # first of a run
    opens[1:] &= ~space[:-1] | starts[1:n]
    last = space.copy()  # last of a run that something follows in the text
    last[:-1] &= ~space[1:] & ~starts[1:n]
    last[-1] = False
    cut = starts
    cut[:n] |= opens | last
    cut[1:] |= last & (data != 0x20)
    letter = _LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & _SECOND[data[1:]]
    cut[1:n] |= letter[:-1] & _SIGN[data[1:]]
    odd = _ODD[data]
    if odd.any():  # such a character beside ASCII white space: its text stays whole
        beside = np.zeros(n, bool)
        beside[1:] |= odd[1:] & space[:-1]
        for k in (2, 3):  # it is two or three bytes long
            beside[:-k] |= odd[:-k] & space[k:]
        whole = np.unique(np.searchsorted(at, np.flatnonzero(beside), "right") - 1)
        for a, b in zip(at[whole].tolist(), at[whole + 1].tolist()):
            cut[a + 1 : b] = False
    return np.flatnonzero(cut)


class SegmentIds:
    """The ids of segments, looked up and remembered; encode(list of segments) gives the ids of new ones and how many each has."""

    #: Bytes of text cut at a time; a longer text is cut alone.
    chunk = CHUNK

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.look_up = encode
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _numbers(self, segments: list[bytes]) -> np.ndarray:
        """Each segment's number in the pool."""
        if len(self.known) > REMEMBERED or len(self.pool) > POOL:
            self.forget()
        get = self.known.get
        numbers = np.fromiter((get(s, -1) for s in segments), np.int64, len(segments))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            own = [segments[i] for i in new.tolist()]
            ids, sizes = self.look_up([s.decode() for s in own])
            first = len(self.at)
            self.known.update((s, i) for i, s in enumerate(own, first) if len(s) <= LONGEST)
            numbers[new] = np.arange(first, first + len(own))
            self.at = np.concatenate((self.at, len(self.pool) + np.cumsum(sizes) - sizes))
            self.size = np.concatenate((self.size, sizes))
            self.pool = np.concatenate((self.pool, ids))
        return numbers

    def batch(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For stretches of the texts: the first text's index, all their ids, and where each text's ids begin (one more than texts)."""
        data, at = text_bytes(column)
        first = 0
        while first < len(at) - 1:
            last = max(first + 1, int(np.searchsorted(at, at[first] + self.chunk, "right")) - 1)
            yield first, *self._stretch(data[at[first] : at[last]], at[first : last + 1] - at[first])
            first = last

    def _stretch(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        borders = segment_borders(data, at)
        if len(borders) < 2:
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        array = pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = array.dictionary_encode()
        own = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        lengths = self.size[own]
        ends = np.cumsum(lengths)
        ids = self.pool[np.repeat(self.at[own] - (ends - lengths), lengths) + np.arange(ends[-1])]
        return ids, np.concatenate(([0], ends))[np.searchsorted(borders, at)]
