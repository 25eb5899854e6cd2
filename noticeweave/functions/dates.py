"""Dates in several notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_date(c: Column | str) -> Column:
    """A date from dd-MM-yyyy, yyyy-MM-dd (a time may follow) or dd/MM/yyyy; null otherwise."""
    given = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.coalesce(F.try_to_date(given, "dd-MM-yyyy"), F.try_to_date(F.substring(given, 1, 10), "yyyy-MM-dd"), F.try_to_date(given, "dd/MM/yyyy"))


def day_month_year(c: Column | str) -> Column:
    """dd-MM-yyyy; what is no date stays as it is."""
    given = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.date_format(any_date(given), "dd-MM-yyyy"), F.trim(given), F.lit(""))


def elapsed_days(c: Column | str, reference: str) -> Column:
    return F.datediff(F.lit(reference).cast("date"), c)


def irrevocable(stage: Column | str, date: Column | str, reference: str, days: int = 42) -> Column:
    """A definitive decision whose term for appeal is over at the reference date."""
    stage, date = (F.col(x) if isinstance(x, str) else x for x in (stage, date))
    return F.coalesce((stage == "definitive_decision") & (date <= F.date_sub(F.lit(reference).cast("date"), days)), F.lit(False))


def within_year(columns: list[str], year: int, undated: bool = True) -> Column:
    """Any of the year columns says the year, or (if undated) none says anything."""
    years = [F.expr(f"try_cast(`{c}` AS int)") for c in columns]
    some = F.lit(False)
    for y in years:
        some = some | F.coalesce(y == year, F.lit(False))
    return some | F.coalesce(*[y.cast("string") for y in years]).isNull() if undated else some
