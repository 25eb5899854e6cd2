"""Token ids in directly addressable codes.

An id is split into 8-bit chunks, lowest first. Level 0 holds the first chunk of every id; a bitmap says which ids go on, level 1
holds the next chunk of those, and so on. Rank directories (ones before every 512 bits) find an id's place in the next level, so any
id is read from a file with a few small reads, without decoding a block.

File: magic; segments of at most SEGMENT ids (the levels' chunks, bitmaps and directories); the index, zlib-packed: the documents'
ids and where each begins, and the segments' places; the index's length (8 bytes); magic.
"""

from __future__ import annotations

import io
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeweave.llm.blocks import text_size
from noticeweave.llm.chunks import SegmentIds
from noticeweave.llm.memory import settle, settling
from noticeweave.llm.shared_files import new_file, open_random
from noticeweave.operators.durable import durable, new_folder

MAGIC, SEGMENT, RANK = b"NWDAC01\n", 1 << 20, 512
#: Bytes of text in a file on average, at most.
PART = 256 << 20


def pack_segment(ids: np.ndarray) -> tuple[bytes, list[int]]:
    """The levels of a segment and the number of ids at each."""
    out, counts, left = [], [], ids.astype(np.uint32)
    while len(left) or not counts:
        goes_on = left > 255
        counts.append(len(left))
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.concatenate((bits, np.zeros(-len(bits) % (RANK // 8), np.uint8)))
        ones = np.bitwise_count(bits.view(np.uint64)).reshape(-1, RANK // 64).sum(axis=1)
        ranks = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        out += [(left & 255).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]
        left = left[goes_on] >> 8
    return b"".join(out), counts


def _level_sizes(n: int) -> tuple[int, int, int]:
    blocks = -(-n // RANK)
    return n, blocks * RANK // 8, blocks * 4


class TokenWriter:
    def __init__(self, stream):
        self.stream, self.at, self.n = stream, len(MAGIC), 0
        self.docs: list[int | None] = []
        self.starts: list[int] = []
        self.segments: list[list[int]] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.n)
        self.n += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= SEGMENT:
            self._flush(SEGMENT)

    def _flush(self, least: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        while len(ids) >= max(1, least):
            data, counts = pack_segment(ids[:SEGMENT])
            self.stream.write(data)
            self.segments.append([self.at, *counts])
            self.at += len(data)
            ids = ids[SEGMENT:]
        self.waiting, self.held = [ids], len(ids)

    def close(self) -> None:
        self._flush(1)
        known = np.array([d is not None for d in self.docs], bool)
        levels = max([len(s) for s in self.segments], default=1)
        table = np.array([s + [0] * (levels - len(s)) for s in self.segments], "<i8").reshape(-1, levels)
        head = struct.pack("<4q", len(self.docs), self.n, len(table), levels)
        index = zlib.compress(head + np.packbits(known).tobytes() + np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array(self.starts, "<i8").tobytes() + table.tobytes(), 1)
        self.stream.write(index + struct.pack("<q", len(index)) + MAGIC)


class TokenFile:
    """A file of token ids, opened for random access."""

    def __init__(self, file):
        self.file = file
        size = file.size() if hasattr(file, "size") else file.seek(0, io.SEEK_END)
        tail = self._read(size - 16, 16)
        if tail[8:] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        length = struct.unpack("<q", tail[:8])[0]
        data = zlib.decompress(self._read(size - 16 - length, length))
        docs, self.n, segments, levels = struct.unpack("<4q", data[:32])
        flags = -(-docs // 8)
        known = np.unpackbits(np.frombuffer(data, np.uint8, flags, 32))[:docs].astype(bool)
        ids, self.starts = np.frombuffer(data, "<i8", 2 * docs, 32 + flags).reshape(2, docs)
        self.docs = [int(d) if k else None for d, k in zip(ids, known)]
        self.segments = np.frombuffer(data, "<i8", segments * levels, 32 + flags + 16 * docs).reshape(segments, levels)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def token(self, i: int) -> int:
        """The i-th id of the file, from a few bytes of it."""
        segment, i = divmod(i, SEGMENT)
        at, *counts = self.segments[segment].tolist()
        value = 0
        for level, n in enumerate(counts):
            chunks, bits, ranks = _level_sizes(n)
            value |= self._read(at + i, 1)[0] << 8 * level
            block, bit = divmod(i, RANK)
            word = self._read(at + chunks + block * RANK // 8, bit // 8 + 1)
            if not word[-1] >> bit % 8 & 1:
                break
            before = int.from_bytes(word, "little") & (1 << bit) - 1
            i = struct.unpack("<I", self._read(at + chunks + bits + 4 * block, 4))[0] + before.bit_count()
            at += chunks + bits + ranks
        return value

    def segment(self, k: int) -> np.ndarray:
        """All ids of a segment."""
        at, *counts = self.segments[k].tolist()
        data = self._read(at, sum(sum(_level_sizes(n)) for n in counts))
        out, here, place = np.zeros(counts[0], np.uint32), np.arange(counts[0]), 0
        for level, n in enumerate(c for c in counts if c):
            chunks, bits, ranks = _level_sizes(n)
            out[here] |= np.frombuffer(data, np.uint8, chunks, place).astype(np.uint32) << np.uint32(8 * level)
            here = here[np.unpackbits(np.frombuffer(data, np.uint8, bits, place + chunks), bitorder="little")[:n].astype(bool)]
            place += chunks + bits + ranks
        return out

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) in order, a segment in memory at a time besides the document's own ids."""
        ends = [*self.starts[1:].tolist(), self.n]
        held, base, k = np.zeros(0, np.uint32), 0, 0
        for doc, start, end in zip(self.docs, self.starts.tolist(), ends):
            parts = [held]
            have = base + len(held)
            while have < end:
                parts.append(self.segment(k))
                have += len(parts[-1])
                k += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            held, base = held[start - base :], start
            yield doc, start, held[: end - start]


class SegmentEncoder(SegmentIds):
    """Ids of texts by the tokenizers library, which sees each distinct segment once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(self.tokenizer.get_vocab_size())])
        super().__init__(self._new)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(found.ids, np.uint32) for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Segments with a space before them are encoded many in one text: an id that opens with a space begins the next one."""
        spaced = np.array([s[0] == " " and len(s) > 1 and not s[1].isspace() for s in segments], bool)
        found: list[np.ndarray] = []
        sizes = np.zeros(len(segments), np.int64)
        order = np.concatenate((np.flatnonzero(spaced), np.flatnonzero(~spaced)))
        for i in range(0, int(spaced.sum()), 1000):
            which = order[i : min(i + 1000, int(spaced.sum()))]
            own = [segments[k] for k in which.tolist()]
            (ids,) = self._library(["".join(own)])
            at = np.flatnonzero(self.opens[ids])
            if len(at) != len(own) or at[0]:
                parts = self._library(own)
                ids, at = np.concatenate(parts), np.cumsum([0, *map(len, parts[:-1])])
            found.append(ids)
            sizes[which] = np.diff(at, append=len(ids))
        others = np.flatnonzero(~spaced)
        found += self._library([segments[k] for k in others.tolist()])
        sizes[others] = [len(x) for x in found[len(found) - len(others) :]]
        ids, moved = np.concatenate(found), sizes[order]
        begins = np.empty(len(segments), np.int64)
        begins[order] = np.cumsum(moved) - moved
        ends = np.cumsum(sizes)
        return ids[np.repeat(begins - (ends - sizes), sizes) + np.arange(len(ids))], sizes


_encoders: dict[str, SegmentEncoder] = {}


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int | None = 0) -> DataFrame:
    """Writes the ids of docs (doc_id, text), in ascending order of doc_id over all files (nulls first; equal ids by a hash of their
    texts), each document closed by id `end`; rows (part, path, n_docs, n_tokens). Compute it once: see durable()."""
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer not in _encoders:
            _encoders[tokenizer] = SegmentEncoder(tokenizer)
        encoder = _encoders[tokenizer]
        batch = next(batches, None)
        if batch is None:
            return
        part = TaskContext.get().partitionId()
        closing = np.array([] if end is None else [end], np.uint32)
        with new_file(folder, f"part-{part:06d}", ".dac") as (path, out):
            writer = TokenWriter(out)
            while batch is not None:
                doc_ids = batch.column(0).to_pylist()
                for first, ids, at in encoder.batch(batch.column(1)):
                    for doc_id, x, y in zip(doc_ids[first:], at[:-1].tolist(), at[1:].tolist()):
                        writer.add(doc_id, np.concatenate((ids[x:y], closing)))
                settle()
                batch = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([path]), pa.array([len(writer.docs)], pa.int64()), pa.array([writer.n], pa.int64())], names=["part", "path", "n_docs", "n_tokens"])

    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-text_size(docs) // PART))
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)
    return ordered.mapInArrow(settling(run), "part int, path string, n_docs long, n_tokens long")


def read_tokens(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32, ids) from the files of a manifest; start counts the ids of all documents before."""
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = manifest.select("path", before.alias("base"))  # a row a file
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.binary()) for c in columns[4:]], names=names)

        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_random(path) as file:
                    rows, size = [], 0
                    for doc, start, ids in TokenFile(file).documents():
                        data = ids.astype("<u4").tobytes()
                        rows.append((doc, base + start, len(ids), zlib.crc32(data)) + (data,) * with_ids)
                        size += len(data) * with_ids + 32
                        if size > 4 << 20:
                            yield out(rows)
                            rows, size = [], 0
                    if rows:
                        yield out(rows)

    return placed.repartition(max(1, manifest.count())).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def token_round_trip(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """Token files of docs (doc_id, text) in the shared folder, read back. A row a document, repeats included; null and empty texts
    have the end id alone. Long texts are encoded whole, in segments. Other columns are not read; an empty table gives an empty result."""
    manifest = durable(write_tokens(docs, new_folder(docs.sparkSession, "tokens")), "tokens-manifest")
    return read_tokens(manifest, with_ids)
