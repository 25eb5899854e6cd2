"""Byte-level BPE by ranks: encoding in linear time and decoding.

Bytes are read as Latin-1 characters, so an Aho-Corasick automaton over the vocabulary finds every token that starts at every place
in one sweep. A piece is encoded from the left by its longest tokens; a token may stand only beside one that it is compatible
with, which is so if the merges of the two tokens' bytes give those two tokens again, found by taking their merges back. If no token fits, the last one is taken back
and shortened; places from which no encoding goes on are marked, so each is left once. A sequence whose neighbours are all
compatible is what the merges give for the whole piece, and there is one such sequence.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from noticeweave.llm.chunks import SegmentIds
from noticeweave.llm.memory import settling

#: Pieces and pairs of tokens remembered per worker; when full they are forgotten.
PIECES, PAIRS = 50_000, 200_000
#: Bytes of text encoded and decoded at a time; decoding takes many times that in arrays. A longer text is taken alone.
CHUNK = 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairCodec(SegmentIds):
    """Ids of texts by ranks. Each distinct segment is encoded once if the pattern lets texts be cut into such (see chunks)."""

    chunk = CHUNK

    def __init__(self, path: str, pattern: str):
        self.cut = pattern == public_tokenizers.PATTERN
        self.ranks = load_ranks(path)
        sizes = np.zeros(max(self.ranks.values(), default=0) + 1, np.int64)
        for token, rank in self.ranks.items():
            sizes[rank] = len(token)
        self.token_at, self.token_size = np.cumsum(sizes) - sizes, sizes
        self.token_bytes = np.frombuffer(b"".join(sorted(self.ranks, key=self.ranks.get)), np.uint8)
        self.pieces = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token in self.ranks:
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, token))
        self.automaton.make_automaton()
        self._compatible: dict[tuple[bytes, bytes], bool] = {}
        self._known: dict[str, bytes] = {}
        self._whole: dict[bytes, bool] = {}
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        super().__init__(self._new)

    def rest(self) -> None:
        """Forgets what it has met in texts; what follows from the vocabulary stays."""
        self.forget()
        self._known, self._compatible = {}, {}

    def merges(self, data: bytes) -> list[bytes]:
        """The parts of a short byte string after all merges, lowest rank first, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[j] + parts[j + 1], 1 << 40), j) for j in range(len(parts) - 1))
            if rank == 1 << 40:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts that a token's last merge joins; none for a byte."""
        known = self._halves.get(token, False)
        if known is False:
            rank = self.ranks.pop(token)  # the merges of its bytes without the token itself end in its halves
            parts = self.merges(token)
            self.ranks[token] = rank
            known = self._halves[token] = tuple(parts) if len(parts) == 2 else None
        return known

    def compatible(self, left: bytes, right: bytes) -> bool:
        """Whether the merges of left + right keep the border between them. Their merges are taken back, the latest first; the parts
        at the border must at no time have a merge that goes before the one taken back last (of equals the leftmost goes first)."""
        known = self._compatible.get((left, right))
        if known is None:
            x, y, limit, known = left, right, 1 << 40, None
            while known is None:
                if self.ranks.get(x + y, 1 << 40) < limit:
                    known = False
                    break
                a, b = self.halves(x), self.halves(y)
                if a is None and b is None:
                    known = True
                elif b is None or a is not None and self.ranks[x] > self.ranks[y]:
                    limit, x = self.ranks[x], a[1]
                else:
                    limit, y = self.ranks[y] + 1, b[0]
            if len(self._compatible) >= PAIRS:
                self._compatible.clear()
            self._compatible[left, right] = known
        return known

    def reachable(self, token: bytes) -> bool:
        """Whether merges give the token at all."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self.merges(token) == [token]
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        if data in self.ranks:
            return [self.ranks[data]]
        starts: list[list[bytes]] = [[] for _ in data]  # tokens at each place, the longest last
        for end, (size, token) in self.automaton.iter(data.decode("latin-1")):
            starts[end - size].append(token)
        out: list[tuple[bytes, int]] = []  # tokens, and how many longer choices at their place have been used up
        dead, at, tried = bytearray(len(data) + 1), 0, 0
        while at < len(data):
            choices = starts[at]
            for k in range(tried, len(choices)):
                token = choices[-1 - k]
                if not dead[at + len(token)] and (not out or self.compatible(out[-1][0], token)) and self.reachable(token):
                    out.append((token, k + 1))
                    at, tried = at + len(token), 0
                    break
            else:
                dead[at] = 1
                token, tried = out.pop()
                at -= len(token)
        return [self.ranks[token] for token, _ in out]

    def _pieces_of(self, text: str) -> bytes:
        out = []
        for piece in self.pieces(text):
            ids = self._known.get(piece)
            if ids is None:
                if len(self._known) >= PIECES:
                    self._known.clear()
                ids = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
                if len(piece) <= 64:
                    self._known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def _new(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self._pieces_of(s) for s in segments]
        return np.frombuffer(b"".join(found), "<u4").astype(np.uint32), np.array([len(x) // 4 for x in found], np.int64)

    def batch(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if self.cut:
            yield from super().batch(column)
            return
        for i, text in enumerate(column.to_pylist()):
            ids = np.frombuffer(self._pieces_of(text or ""), "<u4")
            yield i, ids, np.array([0, len(ids)])

    def encode(self, text: str | None) -> bytes:
        return b"".join(ids.astype("<u4").tobytes() for _, ids, _ in self.batch(pa.array([text], pa.string())))

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where each id's bytes begin (one more than ids)."""
        sizes = self.token_size[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.token_bytes[np.repeat(self.token_at[ids] - (ends - sizes), sizes) + np.arange(total)], np.concatenate(([0], ends))

    def decode(self, ids: bytes) -> bytes:
        return self.decoded(np.frombuffer(ids, "<u4"))[0].tobytes()


_codecs: dict[tuple[str, str], BytePairCodec] = {}


def codec(path: str, pattern: str) -> BytePairCodec:
    """One codec per Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = BytePairCodec(path, pattern)
    return _codecs[path, pattern]


def encode_decode(docs: DataFrame, vocabulary: str | None = None, pattern: str = public_tokenizers.PATTERN, keep: list[str] | None = None, with_ids: bool = True) -> DataFrame:
    """The columns keep (all but text if None) of docs, and ids (binary, little-endian 32 bits; if with_ids), n_tokens, ids_sha256 and
    decoded_sha256. Null texts are empty: no ids. Every row gives one row, whatever repeats; columns of docs named like a new one are
    replaced. Long texts are encoded whole; a single piece without a break takes about 200 bytes of memory a byte. An empty table gives an empty
    one. vocabulary is a file of ranks that every executor can read (a package file by default)."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    made = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in made and (c != "text" or keep)]
    frame = docs.select(docs["text"].alias("__text"), *[docs[c] for c in kept])
    schema = frame.drop("__text").schema
    for name, kind in (("ids", "binary"), ("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")):
        if name != "ids" or with_ids:
            schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        try:
            for batch in batches:
                for first, ids, at in own.batch(batch.column(0)):
                    data, begins = own.decoded(ids)
                    code, at = ids.astype("<u4"), at.tolist()
                    spans = list(zip(at, at[1:]))
                    digest = [hashlib.sha256(code[x:y]).hexdigest() for x, y in spans]
                    decoded = [hashlib.sha256(data[begins[x] : begins[y]]).hexdigest() for x, y in spans]
                    new = [pa.array([code[x:y].tobytes() for x, y in spans], pa.binary())] if with_ids else []
                    new += [pa.array([y - x for x, y in spans], pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())]
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, len(spans)).columns[1:], *new], names=schema.names)
        finally:  # the worker lives on and has other work to do
            own.rest()

    return frame.mapInArrow(settling(run), schema)
