"""Sums over entities and their relations, where a relation may belong to several entities and counts for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _relations(links: DataFrame, entity: str, rel: str) -> DataFrame:
    return links.select(entity, rel).na.drop().distinct()


def _amounts(amounts: DataFrame, rel: str, category: str, amount: str) -> DataFrame:
    """Sums by relation and category; what has no positive amount or no category is left out."""
    some = amounts.where((F.col(amount) > 0) & (F.col(category) != "") & F.col(rel).isNotNull())
    return some.groupBy(rel, category).agg(F.sum(amount).alias(amount))


def closure_totals(links: DataFrame, amounts: DataFrame, entity: str, rel: str, category: str, amount: str) -> DataFrame:
    """(category, amount): the sums of amounts (rel, category, amount) over all entities of links (entity, rel). Links that repeat count once.

    An amount counts once for each entity of its relation, so it is weighted by their number and no entity's rows are made: both sides are
    combined by relation before they meet."""
    weights = _relations(links, entity, rel).groupBy(rel).agg(F.count("*").alias("__entities"))
    weighted = _amounts(amounts, rel, category, amount).join(weights, rel)
    return weighted.groupBy(category).agg(F.sum(F.col(amount) * F.col("__entities")).alias(amount))


def closure_sums(links: DataFrame, amounts: DataFrame, entity: str, rel: str, category: str, amount: str) -> DataFrame:
    """(entity, category, amount): each entity's sums over all its relations."""
    own = _relations(links, entity, rel).join(_amounts(amounts, rel, category, amount), rel)
    return own.groupBy(entity, category).agg(F.sum(amount).alias(amount))


def closure_entities(links: DataFrame, amounts: DataFrame, entity: str, rel: str, category: str, amount: str) -> DataFrame:
    """(entity): the entities with any amount that counts."""
    told = _amounts(amounts, rel, category, amount).select(rel).distinct()
    return _relations(links, entity, rel).join(told, rel, "left_semi").select(entity).distinct()
