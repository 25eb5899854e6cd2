"""Hard negatives by the threshold algorithm over sorted lists.

Rows lie in blocks; a block holds, for each dimension, the list of its rows in the order of that component. For an anchor the lists are read
from their upper end where the anchor's component is positive and from their lower end where it is negative. Every row met is scored
at once, in whole numbers. What was not met scores at most the sum of the anchor's components times the values where the lists stand, so
reading stops when that sum is strictly below the kth best score in every window of scores that the anchor asks for (below the
window's lower end, as long as it has fewer than k).

Anchors are dealt into batches and blocks into segments. A task reads the blocks of one segment one after the other for one batch and carries each
anchor's best rows along, so later blocks stop earlier; the best of all segments are merged by a window of at most k rows a segment.
Two rounds: the positives, which set the windows, then the negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeweave.llm.memory import settling
from noticeweave.operators.durable import durable

#: Rows of a block at most (their numbers have 16 bits) and components of a block at most, if it has more than one row.
ROWS, NUMBERS = 4096, 1 << 19
#: Blocks of a segment, and components of a batch of anchors, at most (about).
BLOCKS, BATCH = 64, 1 << 20
#: Entries of each list that are read first; then four times as many.
FIRST = 64
#: Lowest and highest score.
LEAST, MOST = -(1 << 63), (1 << 63) - 1

_PACKED = "dim int, part int, block int, data binary"


def _packed(columns: dict[str, np.ndarray]) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table({name: pa.array([values]) for name, values in columns.items()})
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: pa.Scalar) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(data.as_buffer()).read_all()
    return {name: table.column(name).chunk(0).flatten().to_numpy(zero_copy_only=False) for name in table.column_names}


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (dim, part, block, data) of rows (dim, part, row, id, label, x, ...) that come sorted by dim and part. Lists named w_... go along."""
    here, held, size, number = None, [], 0, 0

    def close() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        columns = {c: rows.column(c).chunk(0).to_numpy() for c in ("row", "id", "label")}
        columns["x"] = rows.column("x").chunk(0).flatten().to_numpy()
        for c in (c for c in rows.column_names if c.startswith("w_")):
            columns[c] = rows.column(c).chunk(0).flatten().to_numpy()
            columns["w_n"] = rows.column(c).chunk(0).value_lengths().to_numpy()
        return pa.RecordBatch.from_arrays([pa.array([here[0]], pa.int32()), pa.array([here[1]], pa.int32()), pa.array([number], pa.int32()), pa.array([_packed(columns)], pa.binary())], names=["dim", "part", "block", "data"])

    for batch in batches:
        keys = np.stack((batch.column("dim").to_numpy(), batch.column("part").to_numpy()), 1)
        borders = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        for a, b in zip([0, *borders.tolist()], [*borders.tolist(), len(keys)]):
            while a < b:
                key = tuple(keys[a].tolist())
                if key != here or size >= max(1, min(ROWS, NUMBERS // max(1, key[0]))):
                    if held:
                        yield close()
                    held, size, number = [], 0, number + 1 if key == here else 0
                    here = key
                take = min(b - a, max(1, min(ROWS, NUMBERS // max(1, key[0]))) - size)
                held.append(batch.slice(a, take))
                size, a = size + take, a + take
    if held:
        yield close()


class Block:
    """Rows and their sorted lists."""

    def __init__(self, row: np.ndarray, id: np.ndarray, label: np.ndarray, x: np.ndarray, **_: np.ndarray):
        self.row, self.id, self.label = row, id, label
        self.x = x.reshape(len(row), -1)
        self.lists = np.argsort(self.x, axis=0, kind="stable").T.astype(np.uint16)
        self.most = int(np.abs(self.x.astype(float)).max(initial=0))
        self.numbers = self.x.astype(float) if self.most < 1 << 53 else self.x.astype(object)
        self.sorted = np.take_along_axis(self.numbers, self.lists.T.astype(np.int64), axis=0).T

    def numeric(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Components, sorted values and the anchor as floats where all sums are exact that way, else as whole numbers without bound."""
        if self.most * int(np.abs(w.astype(float)).max(initial=0)) * max(1, len(w)) < 1 << 53:
            return self.numbers, self.sorted, w.astype(float)
        return self.x.astype(object), self.sorted.astype(object), w.astype(object)


class Windows:
    """For one anchor: the k best rows with scores from low to high, for each window. Scores beyond a long count as its ends."""

    def __init__(self, bounds: list[tuple[int, int]], k: int):
        self.bounds, self.k = bounds, k
        self.best = [[np.zeros(0, np.int64)] * 3 for _ in bounds]
        self.floor = [low for low, _ in bounds]

    def done(self, threshold: int) -> bool:
        """Whether no row that scores at most the threshold can enter any window."""
        return all(threshold < floor or low > high for floor, (low, high) in zip(self.floor, self.bounds))

    def add(self, score: np.ndarray, id: np.ndarray, row: np.ndarray) -> None:
        for i, (_, high) in enumerate(self.bounds):
            fits = np.flatnonzero((score >= self.floor[i]) & (score <= high))
            if not len(fits):
                continue
            best = [np.concatenate((old, new[fits])) for old, new in zip(self.best[i], (score, id, row))]
            order = np.lexsort((best[2], best[1], ~best[0]))[: self.k]
            self.best[i] = [c[order] for c in best]
            if len(order) == self.k:
                self.floor[i] = int(self.best[i][0][-1])


def threshold_search(block: Block, w: np.ndarray, wanted: np.ndarray, windows: Windows) -> int:
    """Brings the wanted rows of a block into the windows; the number of rows that were scored."""
    x, values, w = block.numeric(w)
    n, scored, depth = len(block.row), 0, 0
    open_, left = wanted.copy(), int(wanted.sum())
    up, down = np.flatnonzero(w > 0), np.flatnonzero(w < 0)
    while left:
        at = max(depth, 1)
        if windows.done(int(w[up] @ values[up, n - at] + w[down] @ values[down, at - 1])):
            break
        deeper = min(n, depth * 4 or FIRST)
        if len(up) or len(down):
            met = np.zeros(n, bool)
            met[block.lists[up, n - deeper : n - depth].ravel()] = True
            met[block.lists[down, depth:deeper].ravel()] = True
            fresh = np.flatnonzero(met & open_)
        else:  # all scores are 0
            fresh = np.flatnonzero(open_)
        open_[fresh] = False
        left -= len(fresh)
        scored += len(fresh)
        score = x[fresh] @ w
        score = score.astype(np.int64) if score.dtype != object else np.array([min(max(s, LEAST), MOST) for s in score], np.int64)
        windows.add(score, block.id[fresh], block.row[fresh])
        depth = deeper
    return scored


def _search(k: int, same: bool):
    """Rows (anchor, anchor_id, window_row, window_id, window_score, row, id, score) of the best of a segment for a batch."""
    names = ["anchor", "anchor_id", "window_row", "window_id", "window_score", "row", "id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, anchors = None, []

        def close() -> Iterator[pa.RecordBatch]:
            columns = [[] for _ in names]
            for own, _, windows, asked in anchors:
                for window, (score, id, row) in zip(asked, windows.best):
                    for column, value in zip(columns, (*own[:2], *window)):
                        column.append(np.full(len(score), value, np.int64))
                    for column, value in zip(columns[5:], (row, id, score)):
                        column.append(value)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                key = tuple(batch.column(c)[i].as_py() for c in ("dim", "batch", "segment"))
                if key != here:
                    yield from close()
                    here, anchors = key, []
                data = _unpacked(batch.column("data")[i])
                if batch.column("kind")[i].as_py() == 0:
                    anchors += _anchors(data, k)
                    continue
                if not anchors:
                    continue
                block = Block(**data)
                labels = set(np.unique(block.label).tolist())
                for (row, _, label), w, windows, _ in anchors:
                    if label not in labels if same else labels == {label}:
                        continue
                    wanted = (block.label == label) & (block.row != row) if same else block.label != label
                    threshold_search(block, w, wanted, windows)
        yield from close()

    return settling(run)


def _anchors(data: dict[str, np.ndarray], k: int) -> list[tuple]:
    """((row, id, label), components, windows, what each window stands for) of packed anchors."""
    x = data["x"].reshape(len(data["row"]), -1)
    out, at = [], 0
    for i, own in enumerate(zip(data["row"].tolist(), data["id"].tolist(), data["label"].tolist())):
        bounds, asked = [(LEAST, MOST)], [(-1, -1, 0)]
        if "w_n" in data:
            end = at + int(data["w_n"][i])
            bounds = list(zip(data["w_low"][at:end].tolist(), data["w_high"][at:end].tolist()))
            asked = list(zip(*(data[c][at:end].tolist() for c in ("w_row", "w_id", "w_score"))))
            at = end
        out.append((own, x[i], Windows(bounds, k), asked))
    return out


def _best(anchors: DataFrame, blocks: DataFrame, batches: int, segments: int, k: int, same: bool) -> DataFrame:
    """The best k rows for each window of all anchors, ranked from 1."""
    dealt = anchors.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int")).repartition("dim", "part").sortWithinPartitions("dim", "part")
    packed = dealt.mapInArrow(settling(_pack), _PACKED).withColumnRenamed("part", "batch")
    asked = packed.select("dim", "batch", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment"), F.lit(0).alias("kind"), "block", "data")
    read = blocks.select("dim", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))).alias("batch"), F.col("part").alias("segment"), F.lit(1).alias("kind"), "block", "data")
    tasks = batches * segments
    task = F.pmod(F.col("batch") * segments + F.col("segment") + F.col("dim"), F.lit(tasks))
    grid = asked.unionByName(read).repartitionById(tasks, task).sortWithinPartitions("dim", "batch", "segment", "kind", "block")
    columns = ["anchor", "anchor_id", "window_row", "window_id", "window_score", "row", "id", "score"]
    found = grid.mapInArrow(_search(k, same), ", ".join(f"{c} long" for c in columns))
    order = Window.partitionBy("anchor", "window_row").orderBy(F.desc("score"), "id", "row")  # k rows a segment
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, embedding, integer label).

    Components become floor(scale * x); a score is the whole inner product with the anchor. An anchor's positives are its best rows of the same label,
    the row itself left out; the negatives of each are the best rows of other labels whose score is from low to high hundredths
    of the positive's. Equal scores go by vec_id. Rows whose id, label, vector or any component is null or not finite take no part; rows
    of other lengths than the anchor's are not compared with it. Rows that repeat are rows of their own, so a repeated anchor has its rows
    twice, and the same negative may come twice. Components beyond a long count as its ends, and so do scores. Anchors without positives, and
    positives without negatives in their window, have no rows; neither has an empty table. Further columns are not read.
    """
    numbers = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    sound = F.expr("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL") & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(sound).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.size("embedding").alias("dim"), numbers.alias("x"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    rows = durable(rows, "negatives-rows")
    total, longest, asking = rows.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(0)), F.count_if("asks")).first()
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batches = max(1, -(-asking * max(1, longest) // BATCH))
    whole = max(1, -(-total // max(1, min(ROWS, NUMBERS // max(1, longest)))))  # blocks
    segments = max(1, -(-whole // BLOCKS), min(whole, -(-parts // batches)))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(segments)).cast("int")).drop("asks")
    blocks = durable(dealt.repartition("dim", "part").sortWithinPartitions("dim", "part", "label", "row").mapInArrow(settling(_pack), _PACKED), "negatives-blocks")
    anchors = rows.where("asks").drop("asks")
    best = durable(_best(anchors, blocks, batches, segments, positives, True), "positives")

    def hundredths(part: int, up: bool) -> Column:  # exact in a long for any score
        whole_, rest = F.expr("score div 100"), F.expr("score % 100")
        more = F.ceil(rest * part / F.lit(100)) if up else F.floor(rest * part / F.lit(100))
        return (whole_ * part + more).cast("long")

    best = best.where("score >= 0")  # below 0 the window is empty
    window = F.struct(F.col("row").alias("w_row"), F.col("id").alias("w_id"), F.col("score").alias("w_score"), hundredths(low, True).alias("w_low"), hundredths(high, False).alias("w_high"))
    asked = best.groupBy("anchor").agg(F.sort_array(F.collect_list(window)).alias("w"))  # at most `positives`
    fields = ["w_row", "w_id", "w_score", "w_low", "w_high"]
    anchors = anchors.join(asked, F.col("row") == F.col("anchor")).select(*anchors.columns, *[F.col("w")[f].alias(f) for f in fields])
    out = _best(anchors, blocks, batches, segments, negatives, False)
    return out.select("anchor_id", F.col("window_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("window_score").alias("positive_score"), F.col("score").alias("negative_score"))
