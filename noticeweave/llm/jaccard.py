"""N-gram Jaccard join by prefix trees: which texts share at least four fifths of their word shingles.

1. Every text becomes a set of 64-bit shingle hashes; texts with equal sets (126 bits) form a class, and only classes are compared.
2. Shingles get one global order, rare ones first, by their exact numbers of texts: blocks of texts send their distinct shingles to ranges
   of hashes and get ranks back (see blocks.py). Hashes are cut for that to the bits that keep nearly all shingles apart, which changes the
   order but no result.
3. Two sets with similarity t share one of their first n - ceil(t n) + 1 shingles. Those that no other text has can be in no overlap, so
   they only take up places, and nothing is sent for them. A class's seat at a shingle counts the met shingles before it, and two classes
   whose seats and remaining shingles can't add up to t are not paired. So an altered copy too far from its original meets nobody,
   however large the group.
4. Of the classes that meet at a shingle the one with the most frequent shingles (the likely original) is the hub. Each class
   is compared with one hub first; where classes of different components still meet, with the shingle's hub; and only what
   remains apart after that is paired with each other. A group of linked near copies costs pairs in proportion to its size.
5. Pairs are checked exactly: the sets that a class is compared with are stored in a prefix tree in ascending order of their hashes, the
   traversal reuses the overlap of shared beginnings, and leaves a subtree once the shingles that remain cannot reach t.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeweave.llm.blocks import BLOCK, blocks, each_block, pack_planes, pack_sorted, text_size, unpack_planes, unpack_sorted, unpacked
from noticeweave.llm.memory import settle
from noticeweave.llm.words import distinct, mix, text_shingles
from noticeweave.operators.components import connected_components
from noticeweave.operators.durable import drop_durable, durable

#: Most sets in one prefix tree; a class with more partners has several trees.
TREE = 256
#: Bytes of text for each range of hashes that is counted at a time.
RANGE = 4 << 20


class PrefixTree:
    """Ascending sets of one global order, stored as a prefix tree: in lexicographic order, each with the length that it shares
    with the one before (the depth at which its branch leaves)."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.shared = [0] * len(sets)
        for i in range(1, len(sets)):
            a, b = self.sets[i - 1], self.sets[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.shared[i] = int(differ[0]) if len(differ) else m

    def matches(self, query: np.ndarray, num: int, den: int) -> Iterator[int]:
        """Indexes of the sets (as given) with den * |intersection| >= num * |union|."""
        n, pruned = len(query), None
        overlap = np.zeros(1, np.int64)
        least = -(-num * n // den)  # no smaller set can match
        for i, s in enumerate(self.sets):
            at = self.shared[i]
            if pruned is not None and at >= pruned:
                continue
            pruned = None
            rest = s[at:]
            place = np.searchsorted(query, rest)
            found = query[np.minimum(place, n - 1)] == rest
            overlap = np.concatenate((overlap[: at + 1], overlap[at] + np.cumsum(found)))
            # What any set below a node can still reach: the overlap so far and the query's shingles behind the node's.
            reach = overlap[at + 1 :] + n - (place + found)
            need = -(-num * (n + max(least, 1)) // (num + den))
            if len(reach) and reach[-1] < need:
                pruned = at + 1 + int(np.argmax(reach < need))
                continue
            both = int(overlap[len(s)])
            if den * both >= num * (n + len(s) - both):
                yield self.order[i]


def _signatures(sets: list[np.ndarray]) -> pa.Array:
    """The sets' classes: 126 bits of two sums over their shingles, null for the empty set."""
    low = np.array([np.add.reduce(mix(s)) if len(s) else 0 for s in sets], np.uint64)
    high = np.array([np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(s)) if len(s) else 0 for s in sets], np.uint64)
    both = np.stack((mix(low), mix(high) >> np.uint64(2)), 1) if sets else np.zeros((0, 2), np.uint64)
    empty = np.array([not len(s) for s in sets], bool)
    flags = pa.py_buffer(np.packbits(~empty, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(sets), [flags, pa.py_buffer(np.ascontiguousarray(both).tobytes())])


def _counted(sets: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The block's distinct shingles, cut to so many bits, and the number of its texts that have each."""
    grams = np.concatenate(sets) >> np.uint64(64 - bits) if sets else np.zeros(0, np.uint64)
    grams.sort()
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.zeros(0, np.int64)
    return grams[first], np.diff(first, append=len(grams))


def _sets(docs: pa.Table, k: int, kind: str) -> list[np.ndarray]:
    return [distinct(grams) for grams in text_shingles(docs.column("text"), k, kind)]


def _ask(k: int, kind: str, bits: int, ranges: int):
    """Rows (range, block, n, grams, counts) for the shingles of a block."""

    def ask(block: int, docs: pa.Table) -> Iterator[pa.RecordBatch]:
        grams, counts = _counted(_sets(docs, k, kind), bits)
        borders = np.searchsorted(grams, np.array([(r << bits) // ranges for r in range(1, ranges)], np.uint64)).tolist()
        rows = []
        for r, (a, b) in enumerate(zip([0, *borders], [*borders, len(grams)])):
            if b > a:
                rows.append((r, block, b - a, pack_sorted(grams[a:b]), pack_planes(np.minimum(counts[a:b], 0xFFFF).astype(np.uint16))))
        if rows:
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["range", "block", "n", "grams", "counts"])

    return ask


def _rank(asked: pa.Table) -> pa.Table:
    """Rows (block, range, n, ranks): for each shingle of each block 0 if no other text has it, else eighths of its number's logarithm."""
    settle()
    sizes = asked.column("n").to_pylist()
    grams = np.concatenate([unpack_sorted(x.as_buffer(), n, np.uint64) for n, x in zip(sizes, asked.column("grams"))])
    counts = np.concatenate([unpack_planes(x.as_buffer(), n, np.uint16) for n, x in zip(sizes, asked.column("counts"))])
    order = np.argsort(grams, kind="stable")
    opens = np.concatenate(([True], grams[order][1:] != grams[order][:-1]))
    total = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(opens))
    ranks = np.empty(len(grams), np.uint8)
    ranks[order] = np.minimum(255, np.ceil(np.log2(total) * 8)).astype(np.uint8)[np.cumsum(opens) - 1]
    ends = np.cumsum(sizes)
    packed = [pack_planes(ranks[end - n : end]) for n, end in zip(sizes, ends)]
    return pa.table({"block": asked.column("block"), "range": asked.column("range"), "n": asked.column("n"), "ranks": pa.array(packed, pa.binary())})


_ROWS = "kind int, doc_id long, digest long, signature decimal(38,0), n int, shingle long, position int, common int, grams binary"


def _found(k: int, kind: str, bits: int, num: int, den: int):
    """Rows of kind 0 for each text, 1 for the shingles of a set's beginning that other texts have, 2 for the sets of those."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        settle()
        docs = unpacked(block.column("docs")[0])
        sets = _sets(docs, k, kind)
        signatures = _signatures(sets)
        sizes = np.array([len(s) for s in sets], np.int32)
        by_range = sorted(zip(answers.column("range").to_pylist(), answers.column("n").to_pylist(), answers.column("ranks"))) if answers.num_rows else []
        known, _ = _counted(sets, bits)
        ranks = np.concatenate([unpack_planes(x.as_buffer(), n, np.uint8) for _, n, x in by_range]) if by_range else np.zeros(0, np.uint8)
        if len(known) != len(ranks):  # a lost task ran again on other rows
            raise ValueError("a block holds shingles that it did not ask for; write the documents to files first")
        which, shingles, positions, commons, seen, whole = [], [], [], [], set(), []
        for i, s in enumerate(sets):
            n = len(s)
            if not n:
                continue
            own = ranks[np.searchsorted(known, s >> np.uint64(64 - bits))]
            met = np.flatnonzero(own)
            places = n - -(-num * n // den) + 1 - (n - len(met))  # those that no other text has come first
            if places <= 0 or (signature := signatures[i].as_py()) in seen:
                continue
            seen.add(signature)
            first = met[np.argsort(own[met], kind="stable")][:places]
            which.append(np.full(len(first), i))
            shingles.append(s[first])
            positions.append(np.arange(len(first)) + n - len(met))
            commons.append(np.full(len(first), int(own.mean() * 100)))
            whole.append(i)

        def table(kind: int, rows: np.ndarray, **columns: pa.Array) -> pa.Table:
            made = {"kind": pa.array(np.full(len(rows), kind, np.int32)), "signature": signatures.take(pa.array(rows, pa.int64())), "n": pa.array(sizes[rows])} | columns
            types = {"kind": pa.int32(), "doc_id": pa.int64(), "digest": pa.int64(), "signature": pa.decimal128(38, 0), "n": pa.int32(), "shingle": pa.int64(), "position": pa.int32(), "common": pa.int32(), "grams": pa.binary()}
            return pa.table({name: made.get(name, pa.nulls(len(rows), t)) for name, t in types.items()})

        every = table(0, np.arange(len(sets)), doc_id=docs.column("doc_id").cast(pa.int64()), digest=docs.column("digest"))
        if not whole:
            return every
        flat = [np.concatenate(x) for x in (which, shingles, positions, commons)]
        met = table(1, flat[0], shingle=pa.array(flat[1].view(np.int64)), position=pa.array(flat[2].astype(np.int32)), common=pa.array(flat[3].astype(np.int32)))
        return pa.concat_tables([every, met, table(2, np.array(whole), grams=pa.array([sets[i].astype("<u8").tobytes() for i in whole], pa.binary()))])

    return run


def _compare(num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        sides, sigs, sets = table.column("b"), table.column("a"), [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("grams")]
        partner = sides.is_valid().to_pylist()
        query = next(s for p, s in zip(partner, sets) if not p)
        others = [i for i, p in enumerate(partner) if p]
        hits = pa.array([others[j] for j in PrefixTree([sets[i] for i in others]).matches(query, num, den)], pa.int64())
        return pa.table({"a": sigs.take(hits), "b": sides.take(hits)})

    return run


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int, name: str) -> DataFrame:
    """The pairs (a, b) that are similar, by one prefix tree for up to TREE partners of a."""
    trees = pairs.groupBy("a").agg(F.ceil(F.count("*") / TREE).alias("trees"))
    dealt = pairs.join(trees, "a").select("a", "b", F.pmod(F.xxhash64("b"), "trees").alias("tree"))
    # Written first, so that its size is known: Spark moves the sets to the requests only where these are too many to broadcast.
    asked = dealt.select(F.col("a").alias("signature"), "a", F.lit(None).cast("decimal(38,0)").alias("b"), "tree").distinct()
    requests = durable(dealt.select(F.col("b").alias("signature"), "a", "b", "tree").unionByName(asked), "requests")
    sent = requests.join(sets, "signature").select("a", "tree", "b", "grams")
    found = durable(sent.groupBy("a", "tree").applyInArrow(_compare(num, den), "a decimal(38,0), b decimal(38,0)"), name)
    drop_durable(requests)
    return found


def set_rows(docs: DataFrame, k: int = 5, kind: str = "spaced", num: int = 80, den: int = 100) -> DataFrame:
    """The rows of _found() for docs (doc_id, text), written to the shared folder."""
    size = text_size(docs)
    parts = max(1, math.ceil(size / BLOCK), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bits = min(64, max(32, size.bit_length() + 10))  # a thousandth of the shingles at most shares its bits with another
    packed = blocks(docs.select("doc_id", F.xxhash64("text").alias("digest"), "text"), parts)
    asked = packed.mapInArrow(each_block(_ask(k, kind, bits, max(1, math.ceil(size / RANGE)))), "range int, block long, n int, grams binary, counts binary")
    answers = asked.groupBy("range").applyInArrow(_rank, "block long, range int, n int, ranks binary")
    return durable(packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_found(k, kind, bits, num, den), _ROWS), "shingle-sets")


def similar_sets(docs: DataFrame, k: int = 5, kind: str = "spaced", num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(profile, classes): profile has doc_id, digest (xxhash64 of the text), signature and n_shingles of every row of docs (doc_id, text),
    signature null for a text without words; classes has (signature, component) for the classes that are linked to others, component being the
    smallest signature in reach. Links are 100 * intersection >= 80 * union by default."""
    rows = set_rows(docs, k, kind, num, den)
    profile = rows.where("kind = 0").select("doc_id", "digest", "signature", F.col("n").cast("long").alias("n_shingles"))

    begun = rows.where("kind = 1").select("shingle", "signature", "n", "position", "common")
    shared = begun.groupBy("shingle").agg(F.min("signature").alias("least"), F.max("signature").alias("most"), F.max(F.struct("common", "signature")).alias("hub"))
    met = begun.join(shared.where("least < most"), "shingle").select("shingle", "signature", "n", "position", F.col("hub.signature").alias("hub")).distinct()
    # A class has at most a fifth of its shingles here. mask has a bit for each met shingle before this one (of 64, some in common).
    seats = Window.partitionBy("signature").orderBy("position", "shingle")
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(shingle), 64) AS int))")
    met = met.withColumn("seat", F.row_number().over(seats) - 1).withColumn("mask", F.coalesce(F.bit_or(bit).over(seats.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    met = durable(met, "met")

    def possible(a: str, b: str) -> str:
        """Sizes allow the link, and so do the places of the shared shingle: what both may share before it, it, and the rest. Each bit of
        one mask that the other lacks stands for a met shingle before it that they don't share."""
        before = f"least({a}.seat - bit_count({a}.mask & ~{b}.mask), {b}.seat - bit_count({b}.mask & ~{a}.mask))"
        reach = f"{before} + least({a}.n - {a}.position, {b}.n - {b}.position)"
        return f"{den} * least({a}.n, {b}.n) >= {num} * greatest({a}.n, {b}.n) AND {num + den} * ({reach}) >= {num} * ({a}.n + {b}.n)"

    needed = met.select("signature").distinct()
    sets = durable(rows.where("kind = 2").select("signature", "grams").join(needed, "signature", "left_semi").dropDuplicates(["signature"]), "sets")

    # First each class with the one among its hubs that it shares most shingles with.
    hub = met.alias("h").where("signature = hub")
    pairs = met.alias("m").where("signature <> hub").join(hub, F.expr("h.shingle = m.shingle")).where(possible("h", "m"))
    pairs = pairs.groupBy(F.col("m.signature").alias("b"), F.col("h.signature").alias("a")).agg(F.count("*").alias("times"))
    tried = durable(pairs.groupBy("b").agg(F.max_by("a", F.struct("times", "a")).alias("a")).select("a", "b"), "tried")
    links, done = _verify(tried, sets, num, den, "links"), [met, sets, tried]
    done.append(links)
    # Then, where components still meet, their classes with the shingle's hub; and what is left apart, pair by pair.
    for last in (False, True):
        label = connected_components(links, "a", "b").select(F.col("node").alias("signature"), "component")
        apart = met.join(label, "signature", "left").withColumn("component", F.coalesce("component", "signature"))
        several = apart.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("shingle")
        apart = durable(apart.join(several, "shingle"), "apart")
        left, once = (apart, "x.signature < y.signature") if last else (apart.where("signature = hub"), "true")
        rest = left.alias("x").join(apart.alias("y"), F.expr(f"x.shingle = y.shingle AND x.component <> y.component AND {once} AND {possible('x', 'y')}"))
        rest = rest.select(F.col("x.signature").alias("a"), F.col("y.signature").alias("b")).distinct()
        both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rest = durable(rest.join(both, ["a", "b"], "left_anti"), "rest")
        more = _verify(rest, sets, num, den, "links")
        links, tried = links.unionByName(more), tried.unionByName(rest)
        done += [apart, rest, more]
    classes = connected_components(links, "a", "b").select(F.col("node").alias("signature"), "component")
    for table in done:
        drop_durable(table)
    return profile, classes


def jaccard_components(docs: DataFrame, k: int = 5) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id reachable by links), digest
    (xxhash64 of the text) and component, the component's own number (null without shingles), which null ids have too.

    Null and empty texts, and texts of separators only, have no shingles and are linked with nothing. Texts with equal sets are
    linked. Rows that repeat a doc_id give a row each, with the component of their own text. A null doc_id keeps its row with the
    component that its text gives, null if no other doc_id is in reach. Other columns of docs are ignored. What comes out are components,
    not pairs: inside a component only the pairs that tie it together have been compared. A long text has all of its shingles; an empty table
    gives an empty result.
    """
    profile, classes = similar_sets(docs, k)
    least = profile.where("signature IS NOT NULL").groupBy("signature").agg(F.min("doc_id").alias("doc_id"))
    placed = least.join(classes, "signature", "left").withColumn("component", F.coalesce("component", "signature"))
    firsts = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    numbered = placed.join(firsts, "component").select("signature", "component", "component_id")
    columns = ["doc_id", "n_shingles", "component_id", "digest", "component"]
    alone = profile.where("signature IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "digest", F.lit(None).cast("decimal(38,0)").alias("component"))
    return profile.join(numbered, "signature").select(*columns).unionByName(alone)
