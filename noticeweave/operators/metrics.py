"""Report metrics over entities and a registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def category_share(registry: DataFrame, linked: DataFrame, entity: str, category: str, amount: str, categories: DataFrame) -> DataFrame:
    """Per category: total, linked total (entities in linked), share in percent and the rest up to 100; zero where nothing is."""
    marked = registry.join(linked.select(entity).distinct().withColumn("__in", F.lit(True)), entity, "left")
    sums = marked.groupBy(category).agg(F.sum(amount).alias("total"), F.sum(F.when(F.col("__in"), F.col(amount))).alias("linked"))
    filled = categories.join(sums, category, "left").select(category, F.coalesce("total", F.lit(0)).cast("double").alias("total"), F.coalesce("linked", F.lit(0)).cast("double").alias("linked"))
    share = F.coalesce(F.try_divide(F.col("linked"), F.col("total")) * 100, F.lit(0.0))
    return filled.withColumns({"share": F.round(share, 4), "rest": F.round(F.greatest(F.lit(0.0), 100 - share), 4)})


def dominant_category(registry: DataFrame, entity: str, category: str, amount: str, most: float = 50, mixed: str = "Gemengde bedrijven") -> DataFrame:
    """(entity, dominant): mixed if two categories exceed `most`; the one that does; else the largest, the first by name of equals."""
    sums = registry.groupBy(entity, category).agg(F.sum(amount).alias("__sum"))
    above = F.count(F.when(F.col("__sum") > most, 1))
    only = F.max(F.when(F.col("__sum") > most, F.col(category)))
    top = F.max("__sum")
    largest = sums.groupBy(entity).agg(above.alias("__n"), only.alias("__only"), top.alias("__top"))
    first = sums.join(largest, entity).where("__sum = __top").groupBy(entity).agg(F.min(category).alias("__first"), F.any_value("__n").alias("__n"), F.any_value("__only").alias("__only"))
    return first.select(entity, F.when(F.col("__n") > 1, mixed).when(F.col("__n") == 1, F.col("__only")).otherwise(F.col("__first")).alias("dominant"))


def by_stage(rows: DataFrame, category: str, stage: str, amount: str, categories: list[str], stages: list[str]) -> DataFrame:
    """(category, a column a stage): sums of the rows' own stages for the given categories and stages, zero where nothing is."""
    sums = [F.coalesce(F.sum(F.when(F.col(stage) == s, F.col(amount))), F.lit(0)).cast("long").alias(s) for s in stages]
    own = rows.where(F.col(category).isin(categories) & F.col(stage).isin(stages)).groupBy(category).agg(*sums)
    whole = rows.sparkSession.createDataFrame([(c,) for c in categories], f"`{category}` string")
    return whole.join(own, category, "left").na.fill(0, stages)


def histogram(df: DataFrame, value: Column | str, width: int) -> DataFrame:
    """(bin, n): counts of values by multiples of the width from zero."""
    v = F.col(value) if isinstance(value, str) else value
    return df.where(v.isNotNull()).groupBy((F.floor(v / width) * width).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def conditional_distinct(column: str, **conditions: Column) -> list[Column]:
    """Distinct counts of a column under each condition."""
    return [F.countDistinct(F.when(c, F.col(column))).alias(name) for name, c in conditions.items()]


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(truth, predicted).agg(F.count("*").alias("n"))


def scores(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: the number of rows, of those whose two labels differ (two nulls agree), and the part that agrees (0 without rows)."""
    same = F.col(truth).eqNullSafe(F.col(predicted))
    sums = df.agg(F.count("*").alias("n"), F.count(F.when(~same, 1)).alias("mismatches"))
    return sums.withColumn("accuracy", F.round(F.coalesce(F.try_divide(F.col("n") - F.col("mismatches"), "n"), F.lit(0.0)), 6))


def against_totals(totals: DataFrame, own: DataFrame, key: str, outside: str, amount: str) -> DataFrame:
    """The outside totals with one's own amounts (0 without any) and their percentage (0 of nothing)."""
    joined = totals.select(key, outside).join(own.select(key, amount), key, "left").na.fill(0, [amount])
    return joined.withColumn("percent", F.round(F.coalesce(F.try_divide(F.col(amount) * 100.0, F.col(outside)), F.lit(0.0)), 4))
