"""Entities from shared keys, stable identifiers between runs, and running numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeweave.operators.components import connected_components


def hashed_id(c: Column | str, prefix: str = "FARM") -> Column:
    """The prefix and twelve signs of the SHA-1."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha1(F.col(c) if isinstance(c, str) else c), 1, 12)))


def group_by_shared(rows: DataFrame, member: str, key: str) -> DataFrame:
    """(member, root) for all members of rows (member, key): members that share a key, over any steps, have one root, the
    smallest member. A key's members are tied to its smallest one, so a frequent key costs no more than its rows."""
    hub = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(member).alias("__hub"))
    edges = rows.join(hub, key).select(F.col(member).alias("src"), F.col("__hub").alias("dst"))
    found = connected_components(edges)
    return rows.select(member).where(F.col(member).isNotNull()).distinct().join(found, F.col(member) == F.col("node"), "left").select(member, F.coalesce("component", member).alias("root"))


def stable_ids(groups: DataFrame, known: DataFrame, member: str, root: str, prefix: str = "FARM") -> DataFrame:
    """(root, stable_id) for groups (member, root) given the identifiers of members in earlier runs (member, stable_id).

    An identifier goes to the root with most of its members (the smallest of equals); a root takes the smallest it wins, and a hash
    of its smallest member if it wins none."""
    held = groups.join(known, member).groupBy("stable_id", root).agg(F.count("*").alias("n"))
    won = held.groupBy("stable_id").agg(F.max("n").alias("most")).join(held, "stable_id").where("n = most").groupBy("stable_id").agg(F.min(root).alias(root))
    taken = won.groupBy(root).agg(F.min("stable_id").alias("won"))
    least = groups.groupBy(root).agg(F.min(member).alias("__least"))
    return least.join(taken, root, "left").select(root, F.coalesce("won", hashed_id(F.col("__least").cast("string"), prefix)).alias("stable_id"))


def identifier_map(groups: DataFrame, ids: DataFrame, known: DataFrame, member: str, root: str, run_date: str) -> DataFrame:
    """The state for the next run: (member, stable_id, created_at), created_at from the first run that saw the member."""
    return groups.join(ids, root).select(member, "stable_id").join(known.select(member, F.col("created_at").alias("__old")), member, "left").select(member, "stable_id", F.coalesce("__old", F.lit(run_date)).alias("created_at"))


def numbered(df: DataFrame, order: str, name: str, prefix: str, width: int, start: int = 0) -> DataFrame:
    """Consecutive numbers in the order of a column, counted by ranges so that no task sorts all rows."""
    from noticeweave.operators.durable import durable

    ranged = durable(df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("__part", F.spark_partition_id()), "numbered")
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("__base", F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).select("__part", F.coalesce("__base", F.lit(0)).alias("__base"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    number = (within + F.col("__base") + start).cast("string")
    padded = F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))
    return ranged.join(F.broadcast(before), "__part").withColumn(name, F.concat(F.lit(prefix), padded)).drop("__part", "__base")
