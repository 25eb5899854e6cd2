"""Language mixtures, hard negatives and Merkle manifests on small tables with nulls, ties, repeats and clashing names, held against brute force."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeweave.llm import language, merkle, negatives, registry

R = random.Random(11)
FOLDER = "/root/testdata/sf0.001"


def rows_of(df, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_merkle_manifest"])
def test_against_duckdb(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = duck.execute(registry.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert rows_of(registry.QUERIES[name](spark, FOLDER), *columns) == collections.Counter(found.fetchall())


# Merkle manifests


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, more=0):
    return h(field(r[0]), field(r[3]), field(r[2]), field(r[4] if r[4] is None else r[4] + more), field(r[1]))


def tree(nodes):
    """The root, and each leaf's siblings: ('l' or 'r', digest), or None where the run has no other."""
    paths, cover = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, under = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for j in range(len(run)):
                for x in cover[i + j]:
                    paths[x].append(None if len(run) == 1 else ("l", run[0]) if j else ("r", run[1]))
            up.append(h(*run))
            under.append(sum(cover[i : i + 2], []))
        nodes, cover = up, under
    return nodes[0], paths


def audited(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    ordered = [sorted(groups[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for k in names]
    trees = [tree([leaf(r) for r in g]) for g in ordered]
    root, above = tree([t[0] for t in trees])
    out = collections.Counter()
    for group, (subroot, paths), upper in zip(ordered, trees, above):
        for r, path in zip(group, paths):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            own = leaf(r, int(changed))
            for s in path + upper:
                own = h(own) if s is None else h(s[1], own) if s[0] == "l" else h(own, s[1])
            out[r[0], leaf(r), subroot, root, h(*[s[1] for s in path + upper if s]), own, own == root] += 1
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, path string, tree int, __row int"


@pytest.mark.parametrize("levels", [1, 3, 12])
@pytest.mark.parametrize("count", [1, 2, 300])
def test_merkle_audit(spark, levels, count):
    made = random.Random(count)
    rows = [(made.choice([None, *range(90)]), made.choice([None, "", "x y", "é" * 5, "long " * 40_000 if made.random() < 0.02 else "z"]), made.choice([None, "", "en", "en", "en", "de", "é"]), made.choice([None, "a"]), made.choice([None, 3])) for _ in range(count)]
    df = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA).repartition(3)
    assert rows_of(merkle.audit(df, levels), *COLUMNS) == audited(rows)


def test_merkle_empty(spark):
    assert merkle.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_merkle_tampering_shows(spark):
    df = spark.createDataFrame([(i, "t", "en", "s", 5, "", "", 0, 0) for i in range(60)], SCHEMA)
    for r in merkle.audit(df).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)


def test_postorder_places():
    for n in (1, 2, 3, 5, 8, 11, 64):
        height = merkle.height(n)
        appender, log = merkle.Appender(n, height), []
        for i in range(n):
            log += appender.add(h(str(i)))
        level, nodes = 0, [h(str(i)) for i in range(n)]
        while True:
            ends = np.minimum(n, (np.arange(len(nodes)) + 1) << level)
            assert [log[p] for p in merkle.postorder(ends, level)] == nodes
            if level == height:
                break
            nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
            level += 1
        assert len(log) == merkle.postorder(np.array([n]), height)[0] + 1


# Hard negatives


def mined(rows, asks, positives=5, limit=10):
    sound = [(i, r[0], r[2], [math.floor(256 * x) for x in r[1]]) for i, r in enumerate(rows) if None not in (r[0], r[1], r[2]) and all(x is not None and math.isfinite(x) for x in r[1])]
    out = collections.Counter()
    for a in sound:
        if not asks(a[1]):
            continue
        scores = [(-sum(x * y for x, y in zip(a[3], b[3])), b[1], b[0], b[2]) for b in sound if b[0] != a[0] and len(b[3]) == len(a[3])]
        for p in sorted(s for s in scores if s[3] == a[2])[:positives]:
            near = sorted(s for s in scores if s[3] != a[2] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0])
            for rank, s in enumerate(near[:limit], 1):
                out[a[1], p[1], rank, s[1], -p[0], -s[0]] += 1
    return out


def vectors(kind, n, width):
    made = random.Random(n + width)
    for i in range(n):
        size = made.choice([width, width, width - 1]) if kind == "mixed" else width
        v = [made.choice([0.0, -1.0, 1.0]) if kind == "ties" else made.gauss(0, 1) for _ in range(size)]
        if kind == "mixed" and made.random() < 0.15:
            v = made.choice([None, [None] * size, [float("nan")] * size, [float("-inf")] * size, [0.0] * size])
        id = i if kind == "plain" else made.choice([None, *range(150)])
        yield id, v, made.choice([0, 1, 2, None] if kind == "mixed" else [0, 0, 0, 1, 2]), 7, "x"


@pytest.mark.parametrize("kind, n, width, block", [("plain", 400, 3, 4096), ("plain", 300, 1, 50), ("ties", 300, 8, 17), ("mixed", 500, 16, 64), ("plain", 60, 0, 4096), ("plain", 0, 3, 4096), ("plain", 1, 3, 4096)])
def test_hard_negatives(spark, monkeypatch, kind, n, width, block):
    monkeypatch.setattr(negatives, "ROWS", block)
    rows = list(vectors(kind, n, width))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, row int, part string").repartition(3)
    found = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert rows_of(found, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") == mined(rows, lambda v: v % 10 == 0)


def test_hard_negatives_many_batches(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BATCH", 40)
    rows = list(vectors("plain", 300, 4))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, row int, part string")
    found = negatives.hard_negatives(df, F.col("vec_id") % 3 == 0)
    assert rows_of(found, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") == mined(rows, lambda v: v % 3 == 0)


def test_threshold_stops_early_and_huge_numbers_do_not_crash(spark):
    x = np.random.default_rng(1).integers(-300, 300, (4000, 2))
    block = negatives.Block(np.arange(4000), np.arange(4000), np.zeros(4000, np.int64), x)
    windows = negatives.Windows([(negatives.LEAST, negatives.MOST)], 5)
    scored = negatives.threshold_search(block, np.array([200, 150]), np.ones(4000, bool), windows)
    score = x @ np.array([200, 150])
    assert scored < 2000 and windows.best[0][1].tolist() == np.lexsort((np.arange(4000), -score))[:5].tolist()
    df = spark.createDataFrame([(i, [1e300, -1e300 if i % 2 else 1e300], i % 2) for i in range(20)], "vec_id long, embedding array<double>, label int")
    assert negatives.hard_negatives(df, F.col("vec_id") % 5 == 0).count() == 0  # all positives score the largest long, all negatives 0


# Languages

SOUNDS = {"aa": "ba be bi do du".split(), "bb": "ka ke ki to tu".split(), "cc": "ñu ñe çi ço éa".split()}


def speech(lang, words, made):
    return " ".join("".join(made.choice(SOUNDS[lang]) for _ in range(made.randint(1, 4))) for _ in range(words))


def test_language_held_out(spark):
    made = random.Random(2)
    rows = [(i, lang, speech(lang, made.choice([2, 9, 80]), made), "x", 0.5) for i, lang in ((i, made.choice(list(SOUNDS))) for i in range(600))]
    odd = [(1001, "aa", None), (1002, "aa", ""), (1003, "bb", " 12 -- \n"), (1004, None, speech("aa", 30, made)), (None, "bb", speech("cc", 30, made)), (1005, "cc", speech("cc", 60_000, made)), (1005, "cc", "12 ñuñe"), (1006, "aa", "ка ки")]
    rows += [(*o, "x", 0.5) for o in odd] + rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, lang_pred string, score double").repartition(3)
    found = language.predict(df).collect()
    assert len(found) == len(rows)
    assert set(found[0].asDict()) == {"doc_id", "lang", "text", "held_out", "lang_pred", "score", "languages"}
    held = [r for r in found if r.held_out and r.text and r.doc_id < 1000]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
        assert r.lang_pred == "und" or r.lang_pred in SOUNDS
    by = {(r.doc_id, len(r.text or "")): r for r in found}
    assert by[1004, len(odd[3][2])].lang_pred == "aa" and by[None, len(odd[4][2])].lang_pred == "cc"


def test_language_never_reads_what_it_predicts(spark):
    made = random.Random(3)
    rows = [(i, lang, speech(lang, 20, made)) for i, lang in ((i, made.choice(["aa", "bb"])) for i in range(200))]
    changed = [(i, "bb" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, t) for i, lang, t in rows]
    schema = "doc_id long, lang string, text string"
    first, second = (rows_of(language.predict(spark.createDataFrame(x, schema)), "doc_id", "lang_pred", "score") for x in (rows, changed))
    assert first == second


def test_language_mixtures(spark):
    made = random.Random(4)
    model = language.train(spark.createDataFrame([(k, speech(k, 400, made)) for k in SOUNDS for _ in range(5)] + [(None, "x"), ("aa", None)], "lang string, text string"))
    texts = [speech("aa", 80, made) + " " + speech("bb", 160, made), speech("cc", 240, made), speech("cc", 3, made)]
    found = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).orderBy("doc_id").collect()
    assert [x.lang for x in found[0].languages] == ["bb", "aa"] and abs(found[0].score - 2 / 3) < 0.05
    assert [[x.lang for x in r.languages] for r in found[1:]] == [["cc"], ["cc"]]


def test_language_em_is_the_best_mixture():
    draw = np.random.default_rng(5)
    logs, at = draw.normal(0, 2, (60, 3)), np.array([0, 1, 20, 60])
    likelihood = np.exp(logs - logs.max(1, keepdims=True))
    shares, fit = language._mixtures(likelihood, at, np.full((3, 3), 1 / 3))
    grid = np.array([(a, b, 200 - a - b) for a in range(201) for b in range(201 - a)]) / 200
    for i in range(3):
        best = np.log(np.maximum(likelihood[at[i] : at[i + 1]] @ grid.T, 1e-300)).sum(0).max()
        assert best - 0.01 <= fit[i]
    assert np.allclose(shares.sum(1), 1)


def test_language_grams_are_those_of_each_text_alone():
    import pyarrow as pa

    texts = ["Ab, cd", None, "", "xyz é", "12", "q"]
    ((_, letters, begins),) = list(language.stretches(pa.array(texts)))
    found = language.buckets(letters, begins)
    for i, t in enumerate(texts):
        ((_, own, at),) = list(language.stretches(pa.array([t])))
        assert language.buckets(own, at).tolist() == found[begins[i] : begins[i + 1]].tolist()


def test_language_nothing_to_learn(spark):
    schema = "doc_id long, lang string, text string"
    assert language.predict(spark.createDataFrame([], schema)).count() == 0
    (row,) = language.predict(spark.createDataFrame([(1, None, "ab cd")], schema)).collect()
    assert (row.lang_pred, row.score, row.languages) == ("und", 0.0, [])


def test_too_many_languages(spark):
    many = spark.range(language.LANGUAGES + 1).selectExpr("cast(id AS string) AS lang", "'some words' AS text")
    with pytest.raises(ValueError, match="languages"):
        language.train(many)
