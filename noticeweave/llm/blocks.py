"""Documents packed into blocks, and the sorted numbers that a block asks about.

Some operators have to look up every n-gram of every text in tables that no executor can hold. A block of texts asks for its distinct
n-grams, once each and packed by shard; a shard answers all blocks; the answers meet the block's texts again by the block's number. What
is sent stays far below a row for each n-gram, and no task gets more than one block or one shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.llm.memory import settling

#: Bytes of text in a block. A longer text is a block of its own.
BLOCK = 8 << 20

_FAST, _TIGHT = pa.Codec("zstd", 3), pa.Codec("zstd", 9)


def text_size(docs: DataFrame) -> int:
    """Bytes of all texts; decides the numbers of partitions and shards."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def _cuts(sizes: np.ndarray, held: int) -> Iterator[tuple[int, int, bool]]:
    """Ranges of rows, and whether the block is full behind each; held bytes are in it before the first."""
    begin = 0
    for i, size in enumerate(sizes.tolist()):
        held += size
        if held >= BLOCK:
            yield begin, i + 1, True
            begin, held = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes), False


def _packed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = number = 0
    part = TaskContext.get().partitionId()

    def close() -> pa.RecordBatch:
        nonlocal size, number
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=_TIGHT)) as writer:
            writer.write_table(pa.Table.from_batches(held).combine_chunks())
        block = part << 32 | number
        held.clear()
        size, number = 0, number + 1
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "docs"])

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        for a, b, full in _cuts(sizes, size):
            held.append(batch.slice(a, b - a))
            size += int(sizes[a:b].sum())
            if full:
                yield close()
    if held:
        yield close()


def blocks(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (block, docs) of all rows of docs (text, ...), dealt to parts partitions by block. Plans that use it twice share the exchange."""
    return docs.mapInArrow(settling(_packed_blocks), "block long, docs binary").repartition(parts, "block")


def unpacked(data: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all().combine_chunks()


def each_block(ask: Callable[[int, pa.Table], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for mapInArrow that gives what ask(block, docs) yields for every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from ask(batch.column("block")[i].as_py(), unpacked(batch.column("docs")[i]))

    return settling(run)


def pack_planes(values: np.ndarray) -> bytes:
    """Numbers as bytes, first all their lowest bytes, then the next ones, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return _FAST.compress(planes.tobytes(), asbytes=True) if len(values) else b""


def unpack_planes(data: bytes, n: int, kind) -> np.ndarray:
    kind = np.dtype(kind)
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(_FAST.decompress(data, n * kind.itemsize), np.uint8).reshape(kind.itemsize, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return pack_planes(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, n: int, kind) -> np.ndarray:
    return np.cumsum(unpack_planes(data, n, kind), dtype=kind)
