"""License scans by diagonal voting.

Every run of k words of a document is joined with the places of the same run in the templates. A match, verified by its words, votes
for its diagonal, the document's place less the template's. A phrase stands where one diagonal has all its votes; for the longer
notices, votes of neighbouring diagonals are merged, since a changed, added or missing word moves the rest, and a span is reported if
it covers enough of the template within about its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeweave.llm.words import mix, shingles, text_bytes, word_hashes

# The phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Openings of public license notices.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", "mit"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version", "gpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
]

#: Words of a run for phrases and for notices; diagonals this near are one span; share of a notice's runs that a span must have.
K_PHRASE, K_NOTICE, NEAR, COVER = 2, 4, 3, 0.5
#: Runs of a text in one row; longer texts have several.
PIECE = 100_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def templates(phrases: list[tuple[str, str]], notices: list[tuple[str, str]]) -> list[tuple]:
    """Rows (hash, said, template, label, phrase, length, runs, at) for every run of the templates; said are its words."""
    rows = []
    for i, (text, label) in enumerate([*phrases, *notices]):
        k = K_PHRASE if i < len(phrases) else K_NOTICE
        (_, words, _), = word_hashes(pa.array([text]), "alnum")
        if len(words) < k:
            raise ValueError(f"too few words: {text}")
        own = shingles(words, k).view(np.int64).tolist()
        rows += [(h, said, i, label, i < len(phrases), len(words), len(own), at) for at, (h, said) in enumerate(zip(own, _said(text.encode(), k, list(range(len(own))))))]
    return rows


def _said(text: bytes, k: int, places: list[int]) -> list[str]:
    """The k words from each of places (ascending), joined by spaces; holds k words at a time, however long the text."""
    said, last, i = [], [], 0
    for at, word in enumerate(_WORD.finditer(text.lower())):
        if i == len(places):
            break
        last = [*last, word[0]][-k:]
        if at == places[i] + k - 1:
            said.append(b" ".join(last).decode())
            i += 1
    return said


def _digests(column: pa.Array) -> np.ndarray:
    data, at = text_bytes(column)
    return np.array([hash_bytes(data[a:b]) for a, b in zip(at[:-1], at[1:])], np.int64)


def hash_bytes(data: np.ndarray) -> int:
    """64 bits of a text, to tell rows with the same doc_id apart."""
    padded = np.concatenate((data, np.zeros(-len(data) % 8, np.uint8))).view(np.uint64)
    spread = mix(padded + np.arange(1, len(padded) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return int(mix(np.array([np.add.reduce(spread) + np.uint64(len(data))], np.uint64)).view(np.int64)[0])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, digest and number of words of every text."""
    for batch in batches:
        for i in range(0, batch.num_rows, 1000):
            part = batch.slice(i, 1000)
            counts = [n for _, _, at in word_hashes(part.column(1), "alnum") for n in np.diff(at).tolist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_digests(part.column(1))), pa.array(counts, pa.int64())], names=["doc_id", "digest", "n_words"])


def _rolled(known: np.ndarray):
    """Rows (doc_id, digest, phrase, start, runs): the rolling runs of K_PHRASE words (phrase) and of K_NOTICE words of every text, as
    (hash, own), those from start on, at most PIECE a row. Only runs with a known hash carry their words; no other can meet a template."""
    bits = np.zeros(1 << 16, bool)
    bits[(known & np.uint64(0xFFFF)).astype(np.int64)] = True

    def table(ids: pa.Array, digests: np.ndarray, rows: list) -> pa.RecordBatch:
        which, phrase, start, hashes, words = zip(*rows)
        values = pa.StructArray.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), pa.concat_arrays(words)], names=["hash", "own"])
        ends = np.concatenate(([0], np.cumsum([len(h) for h in hashes]))).astype(np.int32)
        columns = [ids.take(pa.array(which, pa.int64())), pa.array(digests[list(which)]), pa.array(phrase), pa.array(start, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), values)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "phrase", "start", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                digests, (data, ends) = _digests(part.column(1)), text_bytes(part.column(1))
                rows, held = [], 0
                for first, words, at in word_hashes(part.column(1), "alnum"):
                    for t, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist()), first):
                        for k, phrase in ((K_PHRASE, True), (K_NOTICE, False)):
                            if b - a < k:
                                continue
                            own = shingles(words[a:b], k)
                            met = np.flatnonzero(bits[(own & np.uint64(0xFFFF)).astype(np.int64)])
                            met = met[np.isin(own[met], known)]
                            if len(met):
                                said = np.full(len(own), None, object)
                                said[met] = _said(data[ends[t] : ends[t + 1]].tobytes(), k, met.tolist())
                            for start in range(0, len(own), PIECE):
                                piece = own[start : start + PIECE]
                                rows.append((t, phrase, start, piece, pa.array(said[start : start + PIECE], pa.string()) if len(met) else pa.nulls(len(piece), pa.string())))
                                held += len(piece)
                                if held >= PIECE:
                                    yield table(part.column(0), digests, rows)
                                    rows, held = [], 0
                if rows:
                    yield table(part.column(0), digests, rows)

    return run


def spans(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """Rows (doc_id, digest, label, phrase, first, last, cover): the places of the templates in docs (doc_id long, text). A template's
    place counts once in a span, however often the span repeats it."""
    rows = templates(phrases, notices)
    known = docs.sparkSession.createDataFrame(rows, "hash long, said string, template int, label string, phrase boolean, length int, runs int, at int")
    told = docs.select("doc_id", "text").mapInArrow(_rolled(np.array([r[0] for r in rows], np.int64).view(np.uint64)), "doc_id long, digest long, phrase boolean, start int, runs array<struct<hash:bigint,own:string>>")
    rolled = told.select("doc_id", "digest", "phrase", "start", F.posexplode("runs").alias("place", "run")).select("doc_id", "digest", "phrase", (F.col("start") + F.col("place")).alias("place"), "run.hash", "run.own")
    votes = rolled.join(F.broadcast(known), ["phrase", "hash"]).where("own = said")  # templates are a fixed list, a few hundred rows
    keys = ["doc_id", "digest", "template", "label", "phrase", "length", "runs"]
    lines = votes.groupBy(*keys, (F.col("place") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("places"), F.min("place").alias("first"), F.max("place").alias("last"))

    # Neighbouring diagonals of one notice in one document; a document's own lines only. A phrase's diagonals stand alone.
    order = Window.partitionBy(*keys).orderBy("diagonal")
    merged = lines.withColumn("new", (F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR)).cast("int"))
    merged = merged.withColumn("span", F.sum(F.coalesce("new", F.lit(0))).over(order)).withColumn("at", F.explode("places"))
    merged = merged.groupBy(*keys, "span").agg(F.countDistinct("at").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    last = F.col("last") + F.when(F.col("phrase"), K_PHRASE).otherwise(K_NOTICE) - 1
    cover = F.col("votes") / F.col("runs")
    enough = F.when(F.col("phrase"), cover == 1).otherwise((cover >= COVER) & (last - F.col("first") + 1 <= F.col("length") * 1.5 + NEAR))
    return merged.where(enough).select("doc_id", "digest", "label", "phrase", "first", last.alias("last"), cover.alias("cover"))


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """A row for each of docs (doc_id, text): doc_id, n_words, n_base (places of phrases), first_word and last_word (their smallest and
    largest start, null if none), base_labels, labels (with those of notices; distinct, sorted, comma-joined, empty if none), and
    score (the largest cover of a template, 0 to 1).

    Null and empty texts have no words. Rows that repeat a doc_id are judged by their own texts; null ids stay. Overlapping places
    of one phrase count each. Long texts are read whole, a stretch at a time. Other columns are ignored, also those named like the result's. An
    empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spans(docs, phrases, notices).distinct().groupBy("doc_id", "digest").agg(
        F.count(F.when(F.col("phrase"), 1)).alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    ).select(F.col("doc_id").alias("found_doc"), F.col("digest").alias("found_digest"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    told = docs.mapInArrow(_counts, "doc_id long, digest long, n_words long")
    return told.join(found, F.expr("doc_id <=> found_doc AND digest = found_digest"), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
