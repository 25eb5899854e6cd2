"""Records: predicates and fills, lookups with fallbacks, identity kept and rewritten, and ordered output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeweave.functions.text import clean_missing, province, text
from noticeweave.operators.durable import durable
from noticeweave.operators.identity import hashed_id, numbered

# --- predicates and fills ---


def filled(*columns: str) -> Column:
    """Whether all columns hold something."""
    out = F.lit(True)
    for c in columns:
        out = out & (clean_missing(c) != "")
    return out


def or_else(*columns: Column | str) -> Column:
    """The first text that is not blank, else the empty one (fallback keys, prefer the right side, conditional updates)."""
    return F.coalesce(*[F.nullif(F.trim(text(c)), F.lit("")) for c in columns], F.lit(""))


def not_matching(c: Column | str, pattern: str) -> Column:
    """Rows whose text does not hold the pattern, whatever its case; null is a text that does not."""
    return ~F.rlike(text(c), F.lit(f"(?iu){pattern}"))


def in_province(df: DataFrame, column: str, name: str) -> DataFrame:
    """The rows of a province, both names made alike; none if df has no such column."""
    return df.where(province(column) == province(F.lit(name))) if column in df.columns else df.where("false")


def split_by_path(path: Column | str, known: Column) -> Column:
    """eligible, missing_path or not_found: three sets that share no row."""
    return F.when(clean_missing(path) == "", "missing_path").when(known, "eligible").otherwise("not_found")


def work_list(df: DataFrame, order: str, limit: int | None, done: Column, manual: Column) -> DataFrame:
    """The rows still to do: of the first `limit` those not done, without those labelled by hand."""
    first = df.orderBy(order).limit(limit) if limit is not None else df
    return first.where(~F.coalesce(done, F.lit(False)) & ~F.coalesce(manual, F.lit(False)))


def overwritten(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left with the values of right's row of the same key where right has a row: right wins for every column it has."""
    shared = [c for c in right.columns if c != key]
    marked = right.select(key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in shared])
    joined = left.join(marked, key, "left")
    take = [F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c) if c in left.columns else F.lit(None)).alias(c) for c in shared]
    return joined.select(key, *[c for c in left.columns if c != key and c not in shared], *take)


def first_of_group(df: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    """Sums over the keys, the other columns from the group's first row."""
    rest = [c for c in df.columns if c not in (*keys, *sums)]
    row = F.min_by(F.struct(*rest), order).alias("__row")
    return df.groupBy(*keys).agg(row, *[F.sum(c).alias(c) for c in sums]).select(*keys, *[F.col("__row")[c].alias(c) for c in rest], *sums)


def running_sum(value: str, keys: list[str], order: str) -> list[Column]:
    """sum and place: each row's place in its group, in an order, and the values added up to it one by one. A sum of doubles depends on the order
    in which they are added; the sum at a group's last place is the same however the rows are partitioned, and no group is held in memory."""
    from pyspark.sql import Window

    rows = Window.partitionBy(*keys).orderBy(order, value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return [F.sum(value).over(rows).alias("sum"), F.row_number().over(rows).alias("place")]


def whole_number(c: Column | str) -> Column:
    """A sum as text: without decimals if it is whole."""
    value = F.col(c) if isinstance(c, str) else c
    return F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def half_even(c: Column | str) -> Column:
    """A number without decimals as text, halves to the even side."""
    return F.bround(F.col(c) if isinstance(c, str) else c, 0).cast("bigint").cast("string")


# --- lookups ---


def first_rows(df: DataFrame, key: str, order: str, *needed: str) -> DataFrame:
    """Of each filled key the first row (of those where the needed columns are filled)."""
    rest = [c for c in df.columns if c != key]
    some = df.where(filled(key, *needed))
    return some.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("__row")).select(key, *[F.col("__row")[c].alias(c) for c in rest])


def combined(df: DataFrame, dimension: DataFrame, key: str, order: str, missing: bool = False) -> DataFrame:
    """df with the other columns of the dimension's last row of its key (by order, which is not taken), blank where they are null; rows of df
    without one are left out, or blank with `missing`."""
    values = [c for c in dimension.columns if c not in (key, order)]
    last = dimension.where(filled(key)).groupBy(key).agg(F.max_by(F.struct(*values), order).alias("__row"))
    joined = df.join(last, key, "left" if missing else "inner")
    return joined.select(*df.columns, *[text(F.col("__row")[v].cast("string")).alias(v) for v in values])


def lookup(df: DataFrame, dimension: DataFrame, keys: list[str], key: str, values: list[str]) -> DataFrame:
    """df with the values of the dimension's row by the first of several keys that finds one; blank without any. The dimension has a row a
    key; a frequent key of df is left to AQE."""
    out = df
    for i, k in enumerate(keys):
        side = dimension.select(F.col(key).alias(f"__k{i}"), F.lit(True).alias(f"__hit{i}"), *[F.col(v).alias(f"__{i}{v}") for v in values])
        out = out.join(side, F.nullif(text(k), F.lit("")) == F.col(f"__k{i}"), "left")
    choose = []
    for v in values:
        found = F.lit("")
        for i in range(len(keys) - 1, -1, -1):
            found = F.when(F.col(f"__hit{i}"), text(F.col(f"__{i}{v}").cast("string"))).otherwise(found)
        choose.append(found.alias(v))
    return out.select(*[c for c in df.columns if c not in values], *choose)


def place_variants(c: Column | str) -> Column:
    """A place's name as it is, with spaces for hyphens, and with hyphens for spaces."""
    name = F.trim(F.lower(text(c)))
    return F.array_distinct(F.array(name, F.replace(name, F.lit("-"), F.lit(" ")), F.replace(name, F.lit(" "), F.lit("-"))))


def province_of_place(df: DataFrame, place: str, places: DataFrame, hint: str | None = None) -> DataFrame:
    """df with province: the one province of the first spelling of its place that places (place, provinces) knows. Where a place lies in
    several, the one that hint names, else the first, else (without hint) none."""
    tries = df.select(place).distinct().select(place, F.posexplode(place_variants(place)).alias("__n", "__name"))
    known = places.select(F.col("place").alias("__name"), "provinces")
    found = tries.join(known, "__name").groupBy(place).agg(F.min_by("provinces", "__n").alias("__provinces"))
    joined = df.join(found, place, "left")
    options = F.col("__provinces")
    if hint is None:
        chosen = F.when(F.size(options) == 1, F.get(options, F.lit(0)))
    else:
        same = F.filter(options, lambda p: province(p) == province(hint))
        chosen = F.coalesce(F.get(same, F.lit(0)), F.get(options, F.lit(0)))
    return joined.withColumn("province", F.coalesce(chosen, F.lit(""))).drop("__provinces")


# --- identity ---


def kept_or_numbered(df: DataFrame, given: str, order: str, prefix: str, width: int) -> DataFrame:
    """df with its valid old numbers kept (of repeated ones the first row's) and the other rows numbered on behind the largest."""
    valid = F.col(given).rlike(f"^{prefix}[0-9]+$")
    keeper = df.where(valid).groupBy(given).agg(F.min(order).alias("__keeper"))
    told = df.join(keeper, given, "left").withColumn("__old", F.when(F.col("__keeper") == F.col(order), F.col(given)))
    most = told.agg(F.max(F.substring("__old", len(prefix) + 1, 18).try_cast("bigint"))).first()[0] or 0
    rest = [c for c in df.columns if c != given]
    new = numbered(told.where("__old IS NULL").select(*rest), order, given, prefix, width, most)
    return told.where("__old IS NOT NULL").select(*rest, F.col("__old").alias(given)).unionByName(new.select(*rest, given))


def group_numbers(df: DataFrame, key: str, order: str, name: str, prefix: str, width: int, first_seen: bool = True) -> DataFrame:
    """df with a number for each key, in the order of the keys' first rows, or of the keys themselves."""
    firsts = df.groupBy(key).agg(F.min(order).alias("__first"))
    if first_seen:
        return df.join(numbered(firsts, "__first", name, prefix, width).select(key, name), key)
    return df.join(numbered(firsts, key, name, prefix, width).select(key, name), key)


def reused_identity(recipients: DataFrame, farms: DataFrame, register: str, name: str, order: str, farm: str, prefix: str = "FARM") -> DataFrame:
    """recipients with farm: that of the first farm row with their register number, else with their name; the others are numbered behind the
    largest in use, one number for each register number (or name, or row)."""
    by = lambda c: farms.where(filled(c, farm)).groupBy(c).agg(F.min_by(farm, order).alias(f"__{c}"))
    told = recipients.join(by(register), register, "left").join(by(name), name, "left").withColumn("__farm", F.coalesce(f"__{register}", f"__{name}"))
    told = told.withColumn("__new", F.when(filled(register), F.concat(F.lit("r:"), register)).when(filled(name), F.concat(F.lit("n:"), name)).otherwise(F.concat(F.lit("o:"), F.col(order).cast("string"))))
    most = farms.agg(F.max(F.substring(farm, len(prefix) + 1, 18).try_cast("bigint"))).first()[0] or 0
    firsts = told.where("__farm IS NULL").groupBy("__new").agg(F.min(order).alias("__first"))
    fresh = numbered(firsts, "__first", "__number", prefix, 4, most).select("__new", "__number")
    return told.join(fresh, "__new", "left").select(*recipients.columns, F.coalesce("__farm", "__number").alias(farm), F.col("__farm").isNotNull().alias("reused"))


def rewritten_identity(recipients: DataFrame, permits: DataFrame, shared: str, farm: str, order: str) -> DataFrame:
    """recipients with the farm of the first permit that has their shared key, else their own."""
    first = permits.where(filled(shared)).groupBy(shared).agg(F.min_by(farm, order).alias("__farm"))
    return recipients.join(first, shared, "left").withColumn(farm, F.coalesce("__farm", farm)).drop("__farm")


def known_or_hashed(df: DataFrame, key: str, known: DataFrame, name: str, prefix: str = "FARM") -> DataFrame:
    """df with the known identifier of its key (known has a row a key), else a hash of the key; blank keys have none."""
    held = known.select(F.col(key).alias("__key"), F.col(name).alias("__known"))
    own = F.when(filled(key), F.coalesce("__known", hashed_id(F.col(key).cast("string"), prefix))).otherwise("")
    return df.join(held, F.col(key) == F.col("__key"), "left").withColumn(name, own).drop("__key", "__known")


def recipient_label(linked: Column, shared: Column, by_name: Column) -> Column:
    """How a recipient row is linked: by a relation it shares with a permit, by its register's address, by its name, or not."""
    return F.when(shared, "linked_via_rel").when(linked, "minfin_kvk_adres").when(by_name, "fosfaat_adres").otherwise("niet_gelinkt")


def visiting_or_postal(visiting: list[str], postal: list[str], names: list[str]) -> list[Column]:
    """The visiting address if any of its parts is filled, else the postal one."""
    some = F.lit(False)
    for c in visiting:
        some = some | (clean_missing(c) != "")
    return [F.when(some, clean_missing(v)).otherwise(clean_missing(p)).alias(n) for v, p, n in zip(visiting, postal, names)]


def postcodes(df: DataFrame, code: str, components: list[str], codes: DataFrame, found: str) -> DataFrame:
    """df with its blank postcodes filled and differing ones corrected by codes (a row for each combination of the components), and
    change: filled, corrected, missing_components, no_match or empty."""
    whole = filled(*components)
    joined = df.join(codes.select(*components, F.col(found).alias("__found")), components, "left")
    blank, hit = clean_missing(code) == "", F.col("__found").isNotNull()
    change = F.when(~whole, F.when(blank, "missing_components").otherwise("")).when(~hit, "no_match").when(blank, "filled").when(F.col(code) != F.col("__found"), "corrected").otherwise("")
    fixed = F.when(whole & hit, F.col("__found")).otherwise(clean_missing(code))
    return joined.withColumn("change", change).withColumn(code, fixed).select(*df.columns, "change")


# --- ordered output ---


def business_order(c: Column | str, order: list[str]) -> Column:
    """A value's place in a fixed order, those not in it behind (sort by this, then by the value)."""
    value = F.col(c) if isinstance(c, str) else c
    place = F.array_position(F.array(*map(F.lit, order)), value)
    return F.when(F.coalesce(place, F.lit(0)) == 0, len(order) + 1).otherwise(place)


def ranked(df: DataFrame, limit: int, *order: Column) -> DataFrame:
    """The first rows in an order with their place from 1, for reports of the top rows; Spark keeps `limit` rows of each task, so no task
    sorts the table."""
    from pyspark.sql import Window

    first = df.orderBy(*order).limit(limit)
    return first.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def placed(df: DataFrame, *order: Column) -> DataFrame:
    """All rows with their place from 1 in the ascending order of these columns (nulls first), counted by ranges."""
    from pyspark.sql import Window

    keys = [f"__o{i}" for i in range(len(order))]
    asked = df.select("*", *[c.alias(k) for c, k in zip(order, keys)])
    ranged = durable(asked.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("__at", 33)
    sizes = ranged.groupBy(part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    shift = sizes.select("__part", (before - F.col("__first") + 1).alias("__shift"))
    numbered_ = ranged.withColumn("__part", part).join(F.broadcast(shift), "__part")
    return numbered_.select(*df.columns, (F.col("__at") + F.col("__shift")).cast("int").alias("place"))
