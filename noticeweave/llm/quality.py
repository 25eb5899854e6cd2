"""Quality classifier: interpolated modified Kneser-Ney over bytes, trained on trusted text, one model per language.

Counts of all n-grams of the trusted texts are combined in each task and summed by shuffle. Texts are scored in blocks (see blocks.py): a
block asks for its distinct n-grams, the requests meet the model's shards, and the answers meet the block's texts again. All n-grams and
contexts that an n-gram can fall back on have its middle pair of bytes in common, so a shard is chosen by a hash of that pair; what is shorter (at most
65,792 n-grams and 257 contexts a model) goes to every shard. So the model is never held whole anywhere, and what a block gets is bounded
by its own size. A document is kept if its perplexity a byte is within a quantile of the perplexities of the trusted texts of its
language, each by a model of the other half of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.llm.blocks import BLOCK, blocks, each_block, pack_planes, pack_sorted, text_size, unpack_planes, unpack_sorted, unpacked
from noticeweave.llm.memory import settle, settling
from noticeweave.llm.words import text_bytes
from noticeweave.operators.durable import drop_durable, durable

#: Distinct ids of trusted documents that are broadcast at most (8 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 2_000_000
#: Length of the n-grams in bytes; the mark before a text is a byte that UTF-8 never has.
ORDER, BITS, BEGIN = 5, 8, 0xFF
#: Bytes worked on at a time.
SLICE = 1 << 19
#: Shards of each language's model, and the most blocks that one copy of a shard answers.
SHARDS, ANSWERED = 64, 512
#: Quantile of the trusted texts' perplexities up to which documents are kept.
QUANTILE = 0.97


def _mask(n: int) -> int:
    return (1 << BITS * n) - 1


def byte_grams(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slices of the texts' bytes: the ORDER-grams that end at each byte (with begin marks before each text) and the text that the
    byte belongs to. at: where each text begins, one more than there are texts."""
    for x in range(0, len(data), SLICE):
        y = min(len(data), x + SLICE)
        lengths = np.diff(np.clip(at, x, y))
        text = np.repeat(np.arange(len(at) - 1), lengths)
        inside = np.arange(x, y) - at[text]
        grams = np.zeros(y - x, np.int64)
        for k in range(ORDER - 1, -1, -1):
            byte = data[max(0, x - k) : y - k]
            if x < k:
                byte = np.concatenate((np.full(min(k - x, y - x), BEGIN, np.uint8), data[: max(0, y - k)]))
            grams <<= BITS
            grams |= np.where(inside >= k, byte, BEGIN)
        yield grams, text


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams = np.concatenate([g for g, _ in parts])
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], np.concatenate([c for _, c in parts])[order]
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[first], np.add.reduceat(counts, first, axis=0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, gram, c0, c1) of texts (lang, text, half), summed in the task as far as memory allows."""
    held: dict[str, list] = {}

    def out(lang: str) -> pa.RecordBatch:
        grams, counts = _merged(held.pop(lang))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["lang", "gram", "c0", "c1"])

    for batch in batches:
        for lang in pc.unique(batch.column(0)).to_pylist():
            for half in (0, 1):
                own = batch.column(1).filter(pc.and_(pc.equal(batch.column(0), lang), pc.equal(batch.column(2), half)))
                for slice_, _ in byte_grams(*text_bytes(own)):
                    grams, found = np.unique(slice_, return_counts=True)
                    counts = np.zeros((len(grams), 2), np.int64)
                    counts[:, half] = found
                    held.setdefault(lang, []).append((grams, counts))
                    if len(held[lang]) >= 8:
                        held[lang] = [_merged(held[lang])]
                        if len(held[lang][0][0]) > 4_000_000:
                            yield out(lang)
    for lang in list(held):
        yield out(lang)


def count_halves(trusted: DataFrame) -> DataFrame:
    """Rows (lang, gram, c) for three models of each language of trusted (lang, text, half): a:lang counts all texts, 0:lang those that are
    not of half 0, 1:lang those that are not of half 1."""
    counts = trusted.select("lang", "text", "half").mapInArrow(settling(_count), "lang string, gram long, c0 long, c1 long").groupBy("lang", "gram").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    model = lambda name, c: F.struct(F.concat(F.lit(name), "lang").alias("lang"), c.alias("c"))
    three = F.array(model("a:", F.col("c0") + F.col("c1")), model("0:", F.col("c1")), model("1:", F.col("c0")))
    return counts.select("gram", F.inline(three)).where("c > 0").select("lang", "gram", "c")


def train(counts: DataFrame) -> DataFrame:
    """The model tables of n-gram counts (lang, gram, c): rows (lang, n, gram, kind, value). Kind 0: value is the discounted probability of
    the n-gram's last byte after the others; kind 1: the weight left to shorter contexts after the whole n-gram as a context."""
    top = durable(counts, "grams")
    # Lower orders count the distinct bytes before an n-gram.
    suffixes = F.array(*[F.struct(F.lit(n).alias("n"), F.col("gram").bitwiseAND(F.lit(_mask(n))).alias("gram"), F.col("gram").bitwiseAND(F.lit(_mask(n + 1))).alias("longer")) for n in range(1, ORDER)])
    lower = top.select("lang", F.inline(suffixes)).distinct().groupBy("lang", "n", "gram").agg(F.count("*").alias("c"))
    levels = durable(lower.unionByName(top.select("lang", F.lit(ORDER).alias("n"), "gram", "c")), "levels")

    ones = levels.groupBy("lang", "n").agg(*[F.count(F.when(F.col("c") == k, 1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
    ratio = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> F.Column:  # within (0, k), for texts too short to tell
        value = k - (k + 1) * ratio * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        return F.least(F.greatest(F.coalesce(value, F.lit(0.75)), F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}")

    discounts = ones.select("lang", "n", *[discount(k) for k in (1, 2, 3)])
    kinds = [F.count(F.when(F.col("c") == 1, 1)).alias("k1"), F.count(F.when(F.col("c") == 2, 1)).alias("k2"), F.count(F.when(F.col("c") > 2, 1)).alias("k3")]
    contexts = levels.groupBy("lang", "n", F.shiftright("gram", BITS).alias("context")).agg(F.sum("c").alias("total"), *kinds).join(discounts, ["lang", "n"])
    contexts = contexts.select("lang", "n", "context", "total", "d1", "d2", "d3", ((F.col("d1") * F.col("k1") + F.col("d2") * F.col("k2") + F.col("d3") * F.col("k3")) / F.col("total")).alias("g"))
    contexts = durable(contexts, "contexts")
    less = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    seen = levels.withColumn("context", F.shiftright("gram", BITS)).join(contexts, ["lang", "n", "context"]).select("lang", "n", "gram", F.lit(0).alias("kind"), ((F.col("c") - less) / F.col("total")).cast("float").alias("value"))
    after = contexts.select("lang", (F.col("n") - 1).alias("n"), F.col("context").alias("gram"), F.lit(1).alias("kind"), F.col("g").cast("float").alias("value"))
    model = durable(seen.unionByName(after), "model")
    for table in (top, levels, contexts):
        drop_durable(table)
    return model


def _shard(pair):
    """The shard of a pair of bytes, for arrays and for columns."""
    if isinstance(pair, np.ndarray):
        return (pair * 40503 >> 8) % SHARDS
    return F.pmod(F.shiftright(pair * 40503, 8), F.lit(SHARDS)).cast("int")


def _sharded(model: DataFrame, copies: int) -> DataFrame:
    """Rows (lang, shard, copy, n, gram, kind, value) of the model."""
    pair = F.when(F.col("kind") == 1, F.col("gram")).otherwise(F.shiftright("gram", BITS)).bitwiseAND(F.lit(_mask(2)))
    long = F.col("n") >= 3 - F.col("kind")
    shards = F.when(long, F.array(_shard(pair))).otherwise(F.sequence(F.lit(0), F.lit(SHARDS - 1)))
    rows = model.select("lang", F.explode(shards).alias("shard"), "n", "gram", "kind", "value")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def _ask(copies: int):
    """Rows (lang, shard, copy, block, n, grams) for the distinct n-grams of a block."""

    def ask(block: int, docs: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = []
        for lang in pc.unique(docs.column("lang")).to_pylist():
            own = docs.column("text").filter(pc.equal(docs.column("lang"), lang))
            found = [np.unique(grams) for grams, _ in byte_grams(*text_bytes(own))]
            if not found:
                continue
            grams = np.unique(np.concatenate(found))
            shards = _shard(grams >> BITS & _mask(2))
            grams = grams[np.argsort(shards, kind="stable")]
            ends = np.cumsum(np.bincount(shards, minlength=SHARDS))
            for shard in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
                part = grams[ends[shard - 1] if shard else 0 : ends[shard]]
                rows.append((lang, shard, (block * 0x9E3779B97F4A7C15 >> 20) % copies, block, len(part), pack_sorted(part)))
        if rows:
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["lang", "shard", "copy", "block", "n", "grams"])

    return ask


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def log_probabilities(grams: np.ndarray, model: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Natural logarithms of the interpolated probabilities of ORDER-grams; model[n, kind] has the n-grams, ascending, and their values."""
    p = np.full(len(grams), 1.0 / (1 << BITS))
    none = np.zeros(0, np.int64), np.zeros(0)
    for n in range(1, ORDER + 1):
        own = grams & _mask(n)
        p = _find(*model.get((n, 0), none), own, 0.0) + _find(*model.get((n - 1, 1), none), own >> BITS, 1.0) * p
    return np.log(p)


def model_tables(n: np.ndarray, kind: np.ndarray, gram: np.ndarray, value: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Rows of a model or shard as log_probabilities() takes them."""
    out = {}
    for k, c in {(int(a), int(b)) for a, b in np.unique(np.stack((n, kind), 1), axis=0)} if len(n) else ():
        rows = np.flatnonzero((n == k) & (kind == c))
        rows = rows[np.argsort(gram[rows])]
        out[k, c] = gram[rows], value[rows].astype(float)
    return out


def _answer(asked: pa.Table, shard: pa.Table) -> pa.Table:
    """Rows (block, lang, n, grams, values) for the questions of some blocks, by one shard."""
    empty = not shard.num_rows
    tables = {} if empty else model_tables(*(shard.column(c).to_numpy() for c in ("n", "kind", "gram", "value")))
    values = []
    for n, data in zip(asked.column("n").to_pylist(), asked.column("grams")):
        values.append(None if empty else pack_planes(log_probabilities(unpack_sorted(data.as_buffer(), n, np.int64), tables).astype(np.float32)))
    return pa.table({"block": asked.column("block"), "lang": asked.column("lang"), "n": asked.column("n"), "grams": asked.column("grams"), "values": pa.array(values, pa.binary())})


class _Table:
    """Numbers by 64-bit key, looked up for whole arrays: open addressing, linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(math.ceil(math.log2(max(1, len(keys)) * 2))))
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.float32)
        slots, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slots[left]] == -1
            self.keys[slots[left[free]]] = keys[left[free]]  # the last of those that meet in a slot stays
            done = self.keys[slots[left]] == keys[left]
            self.values[slots[left[done]]] = values[left[done]]
            left = left[~done]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all there."""
        slots = self._slots(keys)
        left = np.flatnonzero(self.keys[slots] != keys)
        while len(left):
            if (self.keys[slots[left]] == -1).any():  # a lost task ran again on other rows
                raise ValueError("a block holds n-grams that it did not ask for; write the documents to files first")
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
            left = left[self.keys[slots[left]] != keys[left]]
        return self.values[slots]


def _scored(schema: pa.Schema):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for data in block.column("docs"):
            docs = unpacked(data)
            score = np.full(docs.num_rows, np.nan)
            for lang in pc.unique(docs.column("lang")).to_pylist():
                own = answers.filter(pc.equal(answers.column("lang"), lang)).filter(pc.field("values").is_valid())
                rows = np.flatnonzero(pc.equal(docs.column("lang"), lang).to_numpy())
                if not own.num_rows or not len(rows):
                    continue
                sizes = own.column("n").to_pylist()
                grams = np.concatenate([unpack_sorted(x.as_buffer(), n, np.int64) for n, x in zip(sizes, own.column("grams"))])
                values = np.concatenate([unpack_planes(x.as_buffer(), n, np.float32) for n, x in zip(sizes, own.column("values"))])
                table = _Table(grams, values)
                data_, at = text_bytes(docs.column("text").take(pa.array(rows)))
                sums = np.zeros(len(rows))
                for found, text in byte_grams(data_, at):
                    sums += np.bincount(text, table.get(found), len(rows))
                lengths = np.diff(at)
                score[rows] = np.where(lengths > 0, -sums / np.maximum(lengths, 1), np.nan)
            columns = [pa.array(score, from_pandas=True) if f.name == "surprise" else docs.column(f.name).cast(f.type) for f in schema]
            out.append(pa.Table.from_arrays(columns, schema=schema))
        settle()
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def surprise(docs: DataFrame, model: DataFrame) -> DataFrame:
    """docs (lang, text, ...) with surprise: the mean negative log probability of a byte by the model of that name (null for texts that are
    null or empty, and where there is no such model)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    count = math.ceil(text_size(docs) / BLOCK)
    parts = max(1, count, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    copies = max(1, math.ceil(count / ANSWERED))
    packed = blocks(docs, parts)
    asked = packed.mapInArrow(each_block(_ask(copies)), "lang string, shard int, copy int, block long, n int, grams binary")
    by = ["lang", "shard", "copy"]
    answers = asked.groupBy(*by).cogroup(_sharded(model, copies).groupBy(*by)).applyInArrow(_answer, "block long, lang string, n int, grams binary, values binary")
    schema = docs.schema.add("surprise", "double")
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored(to_arrow_schema(schema)), schema)


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """All rows and columns of docs (doc_id, lang, text, ...), and perplexity, threshold and keep; columns of these names are replaced.

    Trusted are the texts whose doc_id has a label of quality 1 in labels (doc_id, quality); repeated labels count once. A hash of doc_id deals
    them into two halves. The language's threshold is the given quantile of their perplexities, each by a model of the other half; documents are
    judged by a model of all. A null language is one of its own. Rejected (keep false) are texts above the threshold and texts that are null or
    empty; texts of languages without trusted text are kept, with null perplexity, and so are those of languages whose trusted texts are all in
    one half (such as a single one), with a null threshold. Without labels everything but empty texts stays. Rows that repeat are judged alike.
    Long texts are scored whole, in a block of their own. An empty table gives an empty one.
    """
    made = ["perplexity", "threshold", "keep"]
    rest = [c for c in docs.columns if c not in (*made, "lang", "text")]
    names = {c: f"__{i}" for i, c in enumerate(rest)}
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__good")).distinct()
    good = F.broadcast(good) if good.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else good
    plain = docs.select(*[docs[c].alias(n) for c, n in names.items()], F.concat(F.lit("a:"), F.coalesce("lang", F.lit(""))).alias("lang"), "text", F.col("lang").isNull().alias("__no_lang"))
    key = names["doc_id"]
    half = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(2)).cast("int")
    trusted = plain.where("text <> ''").join(good, F.col(key) == F.col("__good"), "left_semi").select(F.substring("lang", 3, 1 << 30).alias("lang"), "text", half.alias("half"))
    model = train(count_halves(trusted))
    held = surprise(trusted.select(F.concat_ws(":", "half", "lang").alias("lang"), "text"), model.where("lang NOT LIKE 'a:%'"))
    limits = held.groupBy(F.concat(F.lit("a:"), F.substring("lang", 3, 1 << 30)).alias("lang")).agg(F.percentile_approx(F.exp("surprise"), quantile, 100_000).alias("threshold"))
    limits = durable(limits, "limits")
    judged = surprise(plain, model.where("lang LIKE 'a:%'")).join(limits, "lang", "left").withColumn("perplexity", F.exp("surprise"))
    keep = (F.coalesce(F.length("text"), F.lit(0)) > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    back = {n: F.col(n).alias(c) for c, n in names.items()} | {"lang": F.when(~F.col("__no_lang"), F.substring("lang", 3, 1 << 30)).alias("lang"), "text": F.col("text")}
    order = [names.get(c, c) for c in docs.columns if c not in made]
    return judged.select(*[back[c] for c in order], "perplexity", "threshold", keep.alias("keep"))
