"""Languages of texts as mixtures: expectation-maximisation over stretches of words.

A language's model is the distribution of its byte 4-grams, hashed into BUCKETS, smoothed by the distribution over all languages. Counts
are made of every training text, summed in each task and then by shuffle; what tasks get is one number a bucket and language.

A text is a series of units of WORDS words; a unit comes from one language. EM estimates the text's proportions of languages from the units'
likelihoods. Its languages are the largest shares of that estimate, as many as give the best likelihood less a penalty for
each further one; the estimate over all languages bounds what a further one can bring, so most texts are settled with their first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from noticeweave.llm.memory import settling
from noticeweave.llm.words import text_bytes

BUCKETS_LOG = 16
BUCKETS = 1 << BUCKETS_LOG
#: Most languages; the model of all of them has BUCKETS floats each, 64 MB together.
LANGUAGES = 256
#: Words of a unit.
WORDS = 8
#: Weight of the distribution over all languages in a language's model, in n-grams.
SMOOTHING = 200.0
#: Rounds of EM at most, and the change of shares below which it ends.
ROUNDS, CHANGE = 50, 1e-4
#: What a further language must bring to the log likelihood: PENALTY, and half the logarithm of the number of units.
PENALTY = 6.0
#: Bytes of text, and numbers of a table of n-grams by language, worked on at a time.
CHUNK, CELLS = 4 << 20, 1 << 20

_SPACE = 0x20
_CLASS = np.full(256, _SPACE, np.uint8)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def stretches(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For stretches of texts: the first text's index, the bytes of their words (lower-case, one space behind each word that is not the
    text's last) and where each text begins in them, one more than there are texts."""
    data, at = text_bytes(column)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK, "right")) - 1)
        part, begins = _CLASS[data[at[first] : at[last]]], at[first : last + 1] - at[first]
        keep = part != _SPACE
        gap = np.zeros(len(part), bool)
        gap[1:] = keep[:-1]
        gap[begins[:-1][begins[:-1] < len(part)]] = False
        keep |= gap
        yield first, part[keep], np.concatenate(([0], np.cumsum(keep)))[begins]
        first = last


def buckets(letters: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The bucket of the 4-gram that ends at each byte; spaces stand before each text."""
    padded = np.concatenate((np.full(3, _SPACE, np.uint8), letters)).astype(np.uint32)
    gram = padded[3:].copy()
    for back in (1, 2, 3):
        before = padded[3 - back : len(padded) - back].copy()
        for step in range(back):
            at = begins[:-1] + step
            before[at[at < begins[1:]]] = _SPACE
        gram |= before << np.uint32(8 * back)
    return gram * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKETS_LOG)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, bucket, n) of texts (lang, text), summed in the task."""
    held: dict[str, np.ndarray] = {}

    def out(lang: str) -> pa.RecordBatch:
        counts = held.pop(lang)
        seen = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["lang", "bucket", "n"])

    for batch in batches:
        for lang in pc.unique(batch.column(0)).to_pylist():
            total = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for _, letters, begins in stretches(batch.column(1).filter(pc.equal(batch.column(0), lang))):
                total += np.bincount(buckets(letters, begins), minlength=BUCKETS)
        if len(held) > LANGUAGES:
            for lang in list(held):
                yield out(lang)
    for lang in list(held):
        yield out(lang)


@dataclass
class Model:
    names: list[str]  # ascending
    logs: np.ndarray  # a row a bucket, a column a language


def train(texts: DataFrame) -> Model:
    """The model of all texts (lang, text); rows without language or text teach nothing. More than LANGUAGES languages are refused."""
    known = texts.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    sums = known.mapInArrow(settling(_count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    names = [r[0] for r in sums.select("lang").distinct().limit(LANGUAGES + 1).collect()]
    if len(names) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    rows = sums.toArrow()  # at most BUCKETS rows a language
    names = sorted(set(names) | set(pc.unique(rows.column("lang")).to_pylist()), key=str.encode)
    counts = np.zeros((BUCKETS, len(names)))
    if names:
        number = pc.index_in(rows.column("lang").combine_chunks(), pa.array(names)).to_numpy()
        counts[rows.column("bucket").to_numpy(), number] = rows.column("n").to_numpy()
    common = (counts.sum(1, keepdims=True) + 0.5) / (counts.sum() + 0.5 * BUCKETS)
    return Model(names, np.log((counts + SMOOTHING * common) / (counts.sum(0) + SMOOTHING)).astype(np.float32))


def units(letters: np.ndarray, begins: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihoods of the units of a stretch by language, and where each text's units begin, one more than there are texts."""
    opens = np.ones(len(letters) + 1, bool)
    opens[1:-1] = letters[:-1] == _SPACE
    opens[begins] = True
    starts = np.flatnonzero(opens[:-1])  # of words
    text = np.searchsorted(begins, starts, "right") - 1
    inside = np.arange(len(starts)) - np.searchsorted(starts, begins)[text]
    starts = starts[inside % WORDS == 0]
    out = np.zeros((len(starts), logs.shape[1]))
    found = buckets(letters, begins)
    step = max(1, CELLS // max(1, logs.shape[1]))
    for x in range(0, len(found), step):
        y = min(len(found), x + step)
        a, b = np.searchsorted(starts, x, "right") - 1, np.searchsorted(starts, y)
        out[a:b] += np.add.reduceat(logs[found[x:y]].astype(float), np.maximum(starts[a:b] - x, 0), axis=0)
    return out, np.searchsorted(starts, begins)


def _mixtures(likelihood: np.ndarray, at: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of languages after EM from the given ones (0 stays 0), and logarithms of the likelihood. likelihood: a row a unit, scaled so
    that its largest is 1; at: where each text's units begin; every text has some."""
    shares, text = shares.copy(), np.repeat(np.arange(len(at) - 1), np.diff(at))
    active, n = np.arange(len(shares)), np.diff(at)[:, None]
    own, rows, begins = likelihood, text, at[:-1]
    for _ in range(ROUNDS):
        part = own * shares[active][rows]
        part /= np.maximum(part.sum(1, keepdims=True), 1e-300)
        new = np.add.reduceat(part, begins, axis=0) / n[active]
        moved = np.abs(new - shares[active]).max(1) > CHANGE
        shares[active] = new
        if not moved.any():
            break
        if moved.sum() * 2 < len(active):  # go on with those alone
            keep = moved[rows]
            own, active = own[keep], active[moved]
            rows = np.repeat(np.arange(len(active)), n[active, 0])
            begins = np.concatenate(([0], np.cumsum(n[active, 0])[:-1]))
    fit = np.log(np.maximum((likelihood * shares[text]).sum(1), 1e-300))
    return shares, np.add.reduceat(fit, at[:-1])


def choose(logs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shares of the chosen languages of each text; logs: the units' log likelihoods; at: where each text's units begin; every text
    has some. Equal shares go by the order of the languages."""
    likelihood = np.exp(logs - logs.max(1, keepdims=True))
    count, width = len(at) - 1, logs.shape[1]
    whole, best = _mixtures(likelihood, at, np.full((count, width), 1.0 / width))
    order = np.argsort(-whole, axis=1, kind="stable")
    cost = PENALTY + 0.5 * np.log(np.diff(at))
    chosen, value = np.zeros((count, width)), np.full(count, -np.inf)
    left = np.arange(count)
    for m in range(1, width + 1):
        start = np.zeros((len(left), width))
        np.put_along_axis(start, order[left, :m], np.maximum(np.take_along_axis(whole[left], order[left, :m], axis=1), 1e-6), axis=1)
        start /= start.sum(1, keepdims=True)
        sizes = np.diff(at)[left]
        rows = np.repeat(at[left] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        shares, fit = _mixtures(likelihood[rows], np.concatenate(([0], np.cumsum(sizes))), start)
        gain = fit - (m - 1) * cost[left]
        better = gain > value[left]
        chosen[left[better]], value[left[better]] = shares[better], gain[better]
        left = left[best[left] - m * cost[left] > value[left]]  # no larger set can bring more
        if not len(left):
            break
    return chosen


_MADE = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("languages", ArrayType(StructType([StructField("lang", StringType()), StructField("share", DoubleType())])))]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of docs (text, ...), and lang_pred, score and languages; columns of these names are replaced.

    languages are the chosen ones of the model with their shares, the largest first; lang_pred is the first and score its share. Texts that are
    null or have no letter are `und` with score 0 and no languages, and so are all texts if the model has no language. Digits and signs are gaps between
    words. Texts of any length are read whole, a text longer than CHUNK by itself. Rows that repeat are judged alike; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "languages")]
    told = docs.select(*kept, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letters"), F.col("text").alias("__text"))
    schema = StructType([*told.drop("__letters", "__text").schema.fields, *_MADE])
    wanted, names, shared = to_arrow_schema(schema), model.names, spark.sparkContext.broadcast(model.logs)

    def judge(column: pa.Array, letters: np.ndarray) -> list[list[tuple[str, float]]]:
        found: list[list[tuple[str, float]]] = [[] for _ in range(len(column))]
        if not names:
            return found
        for first, own, begins in stretches(column):
            logs, at = units(own, begins, shared.value)
            some = np.flatnonzero(np.diff(at) > 0)
            shares = choose(logs, np.append(at[some], at[-1])) if len(some) else np.zeros((0, len(names)))
            order = np.argsort(-shares, axis=1, kind="stable")
            for i, share, by in zip(some.tolist(), shares, order):
                if letters[first + i]:
                    found[first + i] = [(names[k], float(min(share[k], 1.0))) for k in by.tolist() if share[k] > 0]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("__letters").to_numpy(zero_copy_only=False)
            found = judge(pc.if_else(batch.column("__letters"), batch.column("__text"), None), letters)
            made = {"lang_pred": [x[0][0] if x else "und" for x in found], "score": [x[0][1] if x else 0.0 for x in found], "languages": [[{"lang": a, "share": b} for a, b in x] for x in found]}
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name).cast(f.type) for f in wanted], schema=wanted)

    return told.mapInArrow(settling(run), schema)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves 1 when divided by 3; ids that are null are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    """All of docs (doc_id, lang, text, ...) with held_out, lang_pred, score and languages, by a model of the texts that are not held out and have a
    language and an id. See identify() and held_out(); neither lang nor doc_id is read for a prediction. Without such texts all are `und`."""
    kept = [c for c in docs.columns if c != "held_out"]
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text"))
    return identify(docs.select(*kept, held_out(F.col("doc_id")).alias("held_out")), model)
