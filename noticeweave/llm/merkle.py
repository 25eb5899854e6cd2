"""Merkle manifest of a dataset: one tree a group of rows, one tree over the groups, kept as postorder append logs.

Leaves are numbered in their tree by ranges, so that no task sorts a tree. An aligned builder takes the leaves of one stretch of
2**LEVELS and appends every node to its task's log as soon as it is complete: a leaf, then each inner node whose last leaf it was. The
builder holds one waiting node a level. Roots of the stretches are the leaves of the next round, until each tree has one node.

A node of level k over leaves up to `end` (not included) lies at 2 * (end - 1) - popcount(end - 1) + k in its stretch's log: all nodes that
were complete before its last leaf, and k more. So the siblings of any leaf are found by computing, without an index of nodes, and a task
that reads a stretch's log gives the paths of all its leaves. Logs are files in the shared folder, one a task and round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from noticeweave.llm.shared_files import new_file, open_random
from noticeweave.operators.durable import drop_durable, durable, new_folder

#: A builder's stretch has 2**LEVELS leaves: 256 KB of digests in its log.
LEVELS = 12
#: Bytes of a digest in the logs.
SIZE = 32

_DIRECTORY = "tree string, chunk long, n long, uri string, at long, held long, digest string"


def node_digest(*children: str) -> str:
    """The digest of a node from its children's (one or two), all as lowercase hex."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves; a run of one leaf becomes a node of its own as long as other nodes are left."""
    return (n - 1).bit_length()


def postorder(end: np.ndarray, level: int) -> np.ndarray:
    """Places of nodes of a level in their log; end: where their leaves end."""
    before = end - 1
    return 2 * before - np.bitwise_count(before).astype(np.int64) + level


def sibling_places(index: np.ndarray, held: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """For leaves of a log that holds so many: the sibling's number among the nodes of a level, and its place (-1: no sibling)."""
    other = (index >> level) ^ 1
    place = postorder(np.minimum(held, (other + 1) << level), level)
    return other, np.where(other << level < held, place, -1)


class Appender:
    """Nodes of a stretch in the order of their completion."""

    def __init__(self, held: int, levels: int):
        self.held, self.seen, self.waiting = held, 0, [None] * levels

    def add(self, digest: str) -> list[str]:
        """The nodes that this leaf completes, the leaf first."""
        self.seen += 1
        done = [digest]
        for level, left in enumerate(self.waiting):
            if left is not None:
                digest = node_digest(left, digest)
                self.waiting[level] = None
            elif self.seen == self.held:  # nothing will follow: a run of one
                digest = node_digest(digest)
            else:
                self.waiting[level] = digest
                break
            done.append(digest)
        return done


def _builder(folder: str, levels: int):
    names = ["tree", "chunk", "n", "uri", "at", "held", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        rows = (row for batch in chain([first], batches) for row in zip(*(batch.column(i).to_pylist() for i in range(4))))
        made, at, begin, held, here = [], 0, 0, [], None
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        with new_file(folder, f"part-{TaskContext.get().partitionId():06d}", ".log") as (uri, out):
            for tree, index, n, digest in rows:
                if (tree, index >> levels) != here:
                    here, begin = (tree, index >> levels), at
                    stretch = Appender(min(1 << levels, n - (index >> levels << levels)), min(levels, height(n)))
                done = stretch.add(digest.hex())
                held += done
                at += len(done)
                if len(held) >= 1 << 14:
                    out.write(bytes.fromhex("".join(held)))
                    held.clear()
                if stretch.seen == stretch.held:
                    made.append((*here, n, uri, begin, stretch.held, done[-1]))
            out.write(bytes.fromhex("".join(held)))
        for i in range(0, len(made), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made[i : i + 10_000]), kinds)], names=names)

    return run


def _build(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The directories of all rounds over nodes (tree, index, n, digest): rows (tree, chunk, n, uri, at, held, digest), a row a stretch."""
    rounds = []
    while True:
        chunk = F.shiftright("index", levels)
        dealt = nodes.withColumn("chunk", chunk).repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "index")
        folder = new_folder(nodes.sparkSession, "merkle-log")
        rounds.append(durable(dealt.select("tree", "index", "n", "digest").mapInArrow(_builder(folder, levels), _DIRECTORY), "merkle-directory"))
        stretches = F.ceil(F.col("n") / F.lit(1 << levels)).cast("long")
        more = rounds[-1].where(stretches > 1)
        if more.isEmpty():
            return rounds
        nodes = more.select("tree", F.col("chunk").alias("index"), stretches.alias("n"), F.unhex("digest").alias("digest"))


def _finished(directory: DataFrame, levels: int) -> Column:
    return directory["n"] <= (1 << levels)


def _descend(children: DataFrame, directory: DataFrame, levels: int) -> DataFrame:
    """children (tree, index, ...) with path, subroot and root; directory: their stretches with the same three columns for each root."""
    schema = StructType([*children.schema.fields, StructField("path", ArrayType(StringType())), StructField("subroot", StringType()), StructField("root", StringType())])
    wanted = to_arrow_schema(schema)

    def run(own: pa.Table, stretch: pa.Table) -> pa.Table:
        if not own.num_rows:
            return wanted.empty_table()
        row = stretch.slice(0, 1).to_pylist()[0]
        held, levels_here = row["held"], min(levels, height(row["n"]))
        nodes = int(postorder(np.array(held), levels_here)) + 1
        with open_random(row["uri"]) as file:
            hexes = file.read_at(nodes * SIZE, row["at"] * SIZE).hex()
        index = own.column("index").to_numpy() & ((1 << levels) - 1)
        steps = []
        for level in range(levels_here):
            other, place = sibling_places(index, held, level)
            steps.append(["" if p < 0 else ("r" if o & 1 else "l") + hexes[64 * p : 64 * p + 64] for o, p in zip(other.tolist(), place.tolist())])
        above = row["path"]
        paths = [[*own_steps, *above] for own_steps in zip(*steps)] if steps else [above] * own.num_rows
        made = {"path": paths, "subroot": [row["subroot"]] * own.num_rows, "root": [row["root"]] * own.num_rows}
        return pa.Table.from_arrays([pa.array(made[f.name], f.type) if f.name in made else own.column(f.name).cast(f.type) for f in wanted], schema=wanted)

    keyed = children.groupBy("tree", F.shiftright("index", levels).alias("chunk"))
    return keyed.cogroup(directory.groupBy("tree", "chunk")).applyInArrow(lambda key, a, b: run(a, b), schema)


def _stretch_paths(rounds: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """The first round's directory with path, subroot and root of each stretch's root; tops: (tree, path, subroot, root)."""
    known = None
    for directory in reversed(rounds):
        here = directory.where(_finished(directory, levels)).join(tops, "tree")
        if known is not None:
            inner = directory.where(~_finished(directory, levels)).withColumn("index", F.col("chunk"))
            here = here.unionByName(_descend(inner, known, levels).drop("index"))
        known = durable(here, "merkle-paths")
    return known


@dataclass
class Manifest:
    """What build() has written: leaves (tree, index, n, ...), the directories of the trees' logs, and those of the tree over trees."""

    leaves: DataFrame
    rounds: list[DataFrame]
    trees: DataFrame  # tree, index, n, digest
    top: list[DataFrame]
    levels: int

    def root(self) -> DataFrame:
        """One row (root), none without leaves."""
        return self.top[-1].where(_finished(self.top[-1], self.levels)).select(F.col("digest").alias("root"))

    def proofs(self) -> DataFrame:
        """All leaves' columns with path (the siblings from the leaf to the root: 'l' or 'r' and the digest, empty where the run has no
        other), subroot and root."""
        whole = self.root().select(F.lit("").alias("tree"), F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"), "root")
        over = _stretch_paths(self.top, whole, self.levels)
        children = self.trees.select(F.lit("").alias("tree"), "index", F.col("tree").alias("name"), F.lower(F.hex("digest")).alias("own"))
        tops = durable(_descend(children, over, self.levels).select(F.col("name").alias("tree"), "path", F.col("own").alias("subroot"), "root"), "merkle-tops")
        return _descend(self.leaves, _stretch_paths(self.rounds, tops, self.levels), self.levels)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (tree, ...) with index, in this order in the tree, and n, the rows of the tree. Ranges are numbered, then the rows in each."""
    ranged = durable(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("__at", F.monotonically_increasing_id()), "merkle-ranges")
    part = F.shiftright("__at", 33)
    sizes = ranged.groupBy("tree", part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    tree = Window.partitionBy("tree")  # a row a range
    before = F.coalesce(F.sum("__n").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("tree", "__part", (before - F.col("__first")).alias("__shift"), F.sum("__n").over(tree).alias("n"))
    kept = [c for c in rows.columns if c != "tree"]
    return ranged.withColumn("__part", part).join(sizes, ["tree", "__part"]).select("tree", (F.col("__at") + F.col("__shift")).alias("index"), "n", *kept)


def leaf_digest(*columns: Column) -> Column:
    """The leaf (lowercase hex) of a row: '-' for each null, else the value's UTF-8 byte count, ':' and the value, all joined."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def build(rows: DataFrame, tree: Column, order: Column, leaf: Column, keep: dict[str, Column], levels: int = LEVELS) -> Manifest:
    """Writes the logs of all rows: a tree for each value of `tree` (null is one of its own and comes first, the rest by their UTF-8 bytes), its
    leaves (hex digests) by `order` (nulls first), then by digest. Rows that repeat are leaves of their own. `keep` names columns that
    leaves carry along."""
    name = F.coalesce(F.concat(F.lit("+"), tree.cast("string")), F.lit(""))
    digests = rows.select(name.alias("tree"), order.alias("__order"), F.unhex(leaf).alias("digest"), F.monotonically_increasing_id().alias("__row"), *[c.alias(k) for k, c in keep.items()])
    plain = durable(digests, "merkle-leaves")
    leaves = durable(_placed(plain, ["__order", "digest", "__row"]).drop("__order", "__row"), "merkle-leaves")
    drop_durable(plain)
    rounds = _build(leaves.select("tree", "index", "n", "digest"), levels)
    done = [d.where(_finished(d, levels)).select("tree", "digest") for d in rounds]
    subroots = done[0]
    for more in done[1:]:
        subroots = subroots.unionByName(more)
    trees = durable(_placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.unhex("digest").alias("digest")), ["name"]), "merkle-trees")
    top = _build(trees.select("tree", "index", "n", "digest"), levels)
    return Manifest(leaves, rounds, trees.select(F.col("name").alias("tree"), "index", "n", "digest"), top, levels)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) gives with the siblings of a path."""

    def step(own: Column, side: Column) -> Column:
        other = F.substring(side, 2, 64)
        pair = F.when(side.startswith("l"), F.concat(other, own)).when(side.startswith("r"), F.concat(own, other)).otherwise(own)
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(path, leaf, step)


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, one after the other."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), "").cast("binary"), 256)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def audit(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """A row for each of docs (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof_sha256 of the manifest, folded_root
    and verified (folded_root = root) for the row as it is found later: where 7 divides the CRC-32 of doc_id, n_chars is then one more.

    Nulls in any column are told from empty texts; a null lang is a tree of its own, null ids come first and are never changed. Rows that
    repeat are leaves beside each other, ordered by their digests. Texts of any length enter their leaf whole, in the JVM; only digests are
    shuffled. Further columns are not read. An empty table gives an empty result.
    """
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    plain = [F.col(c) for c in FIELDS]
    found = leaf_digest(*[c + 1 if name == "n_chars" else c for name, c in zip(FIELDS, plain)])
    manifest = build(docs, F.col("lang"), F.col("doc_id"), leaf_digest(*plain), {"doc_id": F.col("doc_id"), "found": F.when(changed, F.unhex(found))}, levels)
    leaf = F.lower(F.hex("digest"))
    proofs = manifest.proofs()
    out = proofs.select("doc_id", leaf.alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded(F.lower(F.hex(F.coalesce("found", "digest"))), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
