"""The master table: permits and recipients with the registry relations that link them, in one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeweave.operators.matching import staged_links
from noticeweave.operators.records import filled

UNLINKED = "niet_gelinkt"
VIA_RELATION = "linked_via_rel"


def master_rows(permits: DataFrame, permit_stages: list[tuple[str, DataFrame]], recipients: DataFrame, recipient_stages: list[tuple[str, DataFrame]], key: str, farm: str, rel: str, order: str | None = None) -> DataFrame:
    """A row for each relation of each permit and recipient (both with the columns key and farm, and others), unlinked ones once with a null rel.

    The first stage (method, pairs of key and rel) that links an entity counts. A recipient whose relation a permit has too takes that permit's
    farm (of several the first by `order`, a column of permits, or by key) and the method linked_via_rel. source says permit or recipient; columns that one side lacks are null."""
    own = permits.join(staged_links(permits, permit_stages, key, rel, UNLINKED), key).withColumn("source", F.lit("permit"))
    theirs = recipients.join(staged_links(recipients, recipient_stages, key, rel, UNLINKED), key).withColumn("source", F.lit("recipient"))
    first = own.where(filled(rel, farm)).groupBy(rel).agg(F.min_by(farm, order or key).alias("__farm"))
    shared = theirs.join(first, rel, "left")
    taken = shared.withColumns({farm: F.coalesce("__farm", farm), "link_method": F.when(F.col("__farm").isNotNull(), VIA_RELATION).otherwise(F.col("link_method"))}).drop("__farm")
    return own.unionByName(taken, allowMissingColumns=True)


def with_derived(rows: DataFrame, columns: list[str], **derived: Column) -> DataFrame:
    """The columns in their order (null where rows lacks them), with those that are computed from the others."""
    whole = rows.withColumns(derived)
    return whole.select(*[F.col(c) if c in whole.columns else F.lit(None).cast("string").alias(c) for c in columns])


def farm_relations(rows: DataFrame, farm: str, rel: str, method: str = "link_method") -> DataFrame:
    """The distinct (farm, rel) of linked rows."""
    return rows.where((F.col(method) != UNLINKED) & filled(farm, rel)).select(farm, rel).distinct()


def with_any_count(relations: DataFrame, counts: DataFrame, farm: str, rel: str, amount: str) -> DataFrame:
    """The farms of which a relation has a positive count."""
    return relations.join(counts.where(F.col(amount) > 0).select(rel), rel, "left_semi").select(farm).distinct()


def folded_notices(entities: DataFrame, entity: str, listed: str, notices: DataFrame, doc: str, label: str) -> DataFrame:
    """(entity, n, labels): the labels of an entity's list of documents (a text, commas between) in the order of the list; unknown documents
    have none, entities without documents an empty text."""
    each = entities.select(entity, F.posexplode(F.split(F.coalesce(F.col(listed), F.lit("")), ",")).alias("__at", "__doc")).withColumn("__doc", F.trim("__doc"))
    known = notices.select(F.col(doc).cast("string").alias("__doc"), F.col(label).alias("__label"))
    found = each.join(known, "__doc", "left")
    ordered = F.array_sort(F.collect_list(F.when(F.col("__label").isNotNull(), F.struct("__at", "__label"))))
    return found.groupBy(entity).agg(F.count("__label").alias("n"), F.array_join(F.transform(ordered, lambda x: x["__label"]), " | ").alias("labels"))
