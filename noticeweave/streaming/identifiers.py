"""Stable identifiers kept up to date by a stream, as state: no run looks at older rows again.

Two steps share the work. By identifier, the state counts its members in each root and remembers the winner, the root with most of them (the
smallest of equals); when another root wins, the loser and the winner are told. By root, the state holds the least member and the
identifiers won; when the one that counts changes, the root's new identifier is written with a running number, and the last
one of each root holds. Counts only grow and each change is told once, so the order and the grouping of the rows make no difference.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from noticeweave.operators.durable import new_folder
from noticeweave.streaming.ingest import run_available

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Winners(StatefulProcessor):
    """By identifier: rows (stable_id, root) in, changes (root, member, stable_id, won) out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "root string", "n long")
        self.winner = handle.getValueState("winner", "root string, n long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers: object) -> Iterator[Row]:
        added: dict[str, int] = {}
        for row in rows:
            added[row.root] = added.get(row.root, 0) + 1
        before = tuple(self.winner.get()) if self.winner.exists() else None
        best = before
        for root, n in added.items():
            n += self.counts.getValue((root,))[0] if self.counts.containsKey((root,)) else 0
            self.counts.updateValue((root,), (n,))
            if best is None or root == best[0] or (-n, root) < (-best[1], best[0]):
                best = (root, n)
        self.winner.update(best)
        if before is None or before[0] != best[0]:
            if before is not None:
                yield Row(root=before[0], member=None, stable_id=key[0], won=False)
            yield Row(root=best[0], member=None, stable_id=key[0], won=True)

    def close(self) -> None:
        pass


class Roots(StatefulProcessor):
    """By root: members and changes in, (root, stable_id, number) out."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.least = handle.getValueState("least", "member string, told string, number long")
        self.won = handle.getMapState("won", "stable_id string", "won boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers: object) -> Iterator[Row]:
        member, told, number = tuple(self.least.get()) if self.least.exists() else (None, None, 0)
        changes: dict[str, int] = {}
        for row in rows:
            if row.stable_id is None:
                member = row.member if member is None else min(member, row.member)
            else:  # an identifier may be lost and won again in one batch
                changes[row.stable_id] = changes.get(row.stable_id, 0) + (1 if row.won else -1)
        for stable_id, change in changes.items():
            if change > 0:
                self.won.updateValue((stable_id,), (True,))
            elif change < 0:
                self.won.removeKey((stable_id,))
        first = min((k[0] for k in self.won.keys()), default=None)
        own = first or (member and self.prefix + hashlib.sha1(member.encode()).hexdigest()[:12].upper())
        if own != told:
            number += 1
        self.least.update((member, own, number))
        if own != told:
            yield Row(root=key[0], stable_id=own, number=number)

    def close(self) -> None:
        pass


def identifier_changes(groups: DataFrame, known: DataFrame, prefix: str = "FARM") -> DataFrame:
    """The stream of (root, stable_id, number) for a stream of groups (member, root), given the identifiers (member, stable_id) of earlier runs."""
    named = groups.select(F.col("member").cast("string").alias("member"), F.col("root").cast("string").alias("root"))
    held = named.join(known.select(F.col("member").cast("string").alias("member"), "stable_id"), "member").select("stable_id", "root")
    change = "root string, member string, stable_id string, won boolean"
    won = held.groupBy("stable_id").transformWithState(statefulProcessor=Winners(), outputStructType=change, outputMode="Append", timeMode="None")
    members = named.select("root", "member", F.lit(None).cast("string").alias("stable_id"), F.lit(None).cast("boolean").alias("won"))
    return members.unionByName(won).groupBy("root").transformWithState(statefulProcessor=Roots(prefix), outputStructType="root string, stable_id string, number long", outputMode="Append", timeMode="None")


def stream_ids(groups: DataFrame, known: DataFrame, folder: str | None = None, prefix: str = "FARM") -> DataFrame:
    """Takes in what is there of a stream of groups (member, root) and returns (root, stable_id) as identity.stable_ids gives them for all
    rows so far; roots and members are compared as texts. Run again with the same folder it goes on where it stopped. `known` must stay
    the same for a folder."""
    spark = groups.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        changes = run_available(identifier_changes(groups, known, prefix), folder or new_folder(spark, "identifiers"))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return changes.groupBy("root").agg(F.max_by("stable_id", "number").alias("stable_id"))
