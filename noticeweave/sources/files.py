"""Files as sources: CSV of several shapes, statistics with label codes, XML records, and state of earlier runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeweave.functions.text import clean_missing, html_text, text
from noticeweave.operators.durable import durable


def string_csv(spark: SparkSession, path: str, columns: list[str], sep: str = ",", header: bool = True) -> DataFrame:
    """All columns as texts: what is empty stays empty, quotes are doubled, values may hold line breaks; missing cells are empty too."""
    options = {"header": header, "sep": sep, "escape": '"', "multiLine": True, "nullValue": "\u0000", "emptyValue": "", "enforceSchema": True}
    frame = spark.read.options(**options).schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    return frame.select(*[text(c).alias(c) for c in columns])


def typed_csv(spark: SparkSession, path: str, types: dict[str, str], sep: str = ",") -> DataFrame:
    """Columns of given types; what is empty or can't be read so is null."""
    raw = string_csv(spark, path, list(types), sep)
    return raw.select(*[F.nullif(F.trim(c), F.lit("")).try_cast(kind).alias(c) for c, kind in types.items()])


def _before(rows: DataFrame, by: list[str], at: str, values: dict[str, str]) -> DataFrame:
    """rows with the sums of values over the rows before them in their group, under other names."""
    earlier = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns({name: F.coalesce(F.sum(value).over(earlier), F.lit(0)) for name, value in values.items()})


def file_lines(spark: SparkSession, path: str, quotes: bool = False) -> DataFrame:
    """(file, line_no from 1, value) of the lines of files of any size. A file is read in as many blocks as Spark cuts it into: lines are
    numbered in their block, and the blocks of a file, a row each, tell how many lines stand before.

    With `quotes` a line goes on behind a line break between double quotes; line_no is then the first line's. Only such lines are gathered,
    the others stay where they were read."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    lines = durable(lines.withColumn("signs", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))), "lines")
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"), F.sum("signs").alias("s"))
    blocks = _before(blocks, ["file"], "block", {"lines_before": "n", "signs_before": "s"}).drop("n", "s")
    placed = lines.join(blocks, ["file", "block"]).withColumn("line_no", F.col("at") - F.col("first") + F.col("lines_before") + 1)
    if not quotes:
        return placed.select("file", "line_no", "value")
    inner = _before(placed, ["file", "block"], "at", {"own_before": "signs"})
    begins = (F.col("signs_before") + F.col("own_before")) % 2 == 0
    told = durable(inner.select("file", "block", "line_no", "value", begins.alias("begins"), ((F.col("signs") % 2 == 0) & begins).alias("whole"), (begins & (F.col("signs") % 2 == 1)).cast("int").alias("opens")), "quoted-lines")
    broken = told.where("NOT whole")
    opened = _before(broken.groupBy("file", "block").agg(F.sum("opens").alias("o")), ["file"], "block", {"opened_before": "o"}).drop("o")
    number = F.sum("opens").over(Window.partitionBy("file", "block").orderBy("line_no")) + F.col("opened_before")
    pieces = broken.join(opened, ["file", "block"]).withColumn("__record", number)
    joined = pieces.groupBy("file", "__record").agg(F.min("line_no").alias("line_no"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "value"))), lambda x: x["value"]), "\n").alias("value"))  # the lines of one row
    return told.where("whole").select("file", "line_no", "value").unionByName(joined.drop("__record"))


def _cells(sep: str) -> Column:
    """The cells of a row; quoted ones may hold the separator and line breaks."""
    mark = "\u0001"
    parts = F.split(F.regexp_replace("value", rf'{sep}(?=(?:[^"]*"[^"]*")*[^"]*$)', mark), mark)
    return F.transform(parts, lambda c: F.replace(F.regexp_replace(F.trim(c), r'^"|"$', ""), F.lit('""'), F.lit('"')))


def headless_csv(spark: SparkSession, path: str, columns: list[str], skip: int, sep: str = ";") -> DataFrame:
    """(line_no, columns) of CSV files with `skip` lines before their rows and no header; rows without any text are left out."""
    rows = file_lines(spark, path, quotes=True).where(F.col("line_no") > skip).select("line_no", _cells(sep).alias("cells"))
    named = rows.select("line_no", *[F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])
    return named.where(F.concat_ws("", *columns) != "")


def multi_header_csv(spark: SparkSession, path: str, labels: int, wanted: dict[str, str], sep: str = ",") -> DataFrame:
    """CSV files with `labels` rows of labels above their header. wanted names the columns by the labels or headers they stand under, in each
    file for itself; of several the last counts. (file, line_no, names)."""
    lines = file_lines(spark, path, quotes=True).where("value <> ''").select("file", "line_no", _cells(sep).alias("cells"))
    head = lines.where(F.col("line_no") <= labels + 1).select("file", F.posexplode("cells").alias("at", "cell")).where(F.col("cell").isin(*wanted.values()))
    places = head.groupBy("file", "cell").agg(F.max("at").alias("at")).groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("cell", "at"))).alias("__at"))  # a row a wanted column
    body = lines.where(F.col("line_no") > labels + 1).join(places, "file", "left")
    cell = lambda label: F.coalesce(F.get("cells", F.try_element_at("__at", F.lit(label))), F.lit(""))
    return body.select("file", "line_no", *[cell(label).alias(n) for n, label in wanted.items()])


def distinct_in_order(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, values): each key's distinct values that are not blank, in the order of their first row."""
    some = rows.where((text(key) != "") & (text(value) != ""))
    first = some.groupBy(key, value).agg(F.min(order).alias("__at"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", value))), lambda x: x[value]).alias(f"{value}s"))


def labelled_totals(rows: DataFrame, label: str, value: str, groups: dict[str, list[str]]) -> DataFrame:
    """(name, total): sums over the rows whose label is exactly one of a group's; a label may be in several groups; groups without rows
    have 0."""
    pairs = rows.sparkSession.createDataFrame([(n, x) for n, xs in groups.items() for x in xs], f"name string, `{label}` string")
    sums = rows.select(label, F.col(value).try_cast("double").alias("v")).groupBy(label).agg(F.sum("v").alias("v"))
    return pairs.join(sums, label, "left").groupBy("name").agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("total"))


# --- XML records ---

def xml_records(pages: DataFrame, xml: str, record: str, fields: dict[str, list[str]]) -> DataFrame:
    """(page columns, position, fields): the records of XML pages; a field is the first of its local names with a text. Pages of a source
    that is asked page by page are rows like any others."""
    parts = F.regexp_extract_all(F.col(xml), F.lit(rf"(?is)<(?:\w+:)?{record}\b[^>]*>(.*?)</(?:\w+:)?{record}\s*>"), 1)
    rows = pages.select(*[c for c in pages.columns if c != xml], F.posexplode(parts).alias("position", "__record"))
    value = lambda n: F.nullif(html_text(F.regexp_extract("__record", rf"(?is)<(?:\w+:)?{n}\b[^>]*>(.*?)</(?:\w+:)?{n}\s*>", 1)), F.lit(""))
    return rows.select(*[c for c in rows.columns if c != "__record"], *[F.coalesce(*map(value, names), F.lit("")).alias(f) for f, names in fields.items()])


def wanted_records(rows: DataFrame, kind: str, kinds: list[str], subject: str, subjects: list[str], part: str) -> DataFrame:
    """Rows of the given kinds whose subject is one of the given or holds a word."""
    return rows.where(F.col(kind).isin(kinds) & (F.col(subject).isin(subjects) | F.contains(F.lower(text(subject)), F.lit(part))))


def more_pages(pages: DataFrame, xml: str, order: str, limit: int) -> DataFrame:
    """Of pages asked one after the other those that count: up to the first without records or without a next position, and no more than
    hold `limit` records; (order, records, fetched so far). Ranges of pages are summed first, then the pages within each."""
    seen = pages.select(order, F.size(F.regexp_extract_all(F.col(xml), F.lit(r"(?i)<(?:\w+:)?record\b"), 0)).alias("records"), F.col(xml).rlike(r"(?i)nextRecordPosition").alias("more"))
    told = seen.withColumn("last", ((F.col("records") == 0) | ~F.col("more")).cast("int"))
    ranged = durable(told.repartitionByRange(order).withColumn("__part", F.spark_partition_id()), "pages")

    def before(rows: DataFrame, by: list[str], at: str, prefix: str) -> DataFrame:
        earlier = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns({f"{prefix}_ended": F.coalesce(F.max("last").over(earlier), F.lit(0)), f"{prefix}_fetched": F.coalesce(F.sum("records").over(earlier), F.lit(0))})

    ranges = ranged.groupBy("__part").agg(F.max("last").alias("last"), F.sum("records").alias("records"))
    ranges = before(ranges, [], "__part", "__range").drop("last", "records")  # a row a range
    whole = before(ranged, ["__part"], order, "__own").join(F.broadcast(ranges), "__part")
    fetched = F.col("__range_fetched") + F.col("__own_fetched")
    return whole.where((F.col("__range_ended") + F.col("__own_ended") == 0) & (F.col("records") > 0) & (fetched < limit)).select(order, "records", (fetched + F.col("records")).alias("fetched"))


# --- what earlier runs left ---


def last_rows(rows: DataFrame, key: str, order: str, *needed: str) -> DataFrame:
    """Of each key the last row, of those where the needed columns are filled (labels, clusters)."""
    some = rows
    for c in (key, *needed):
        some = some.where(clean_missing(c) != "")
    rest = [c for c in rows.columns if c != key]
    return some.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__row")).select(key, *[F.col("__row")[c].alias(c) for c in rest])


def by_either_key(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A row for each filled key of each row, under one name (annotations by new and by old id)."""
    each = F.array_distinct(F.filter(F.array(*[clean_missing(c) for c in keys]), lambda k: k != ""))
    return rows.withColumn(name, F.explode(each))


def high_water_mark(rows: DataFrame, date: Column) -> DataFrame:
    """One row: the number of rows and the latest date, null for none."""
    return rows.agg(F.count("*").alias("n"), F.max(date).alias("latest"))


def since_clause(query: str, since: str | None, field: str = "dt.available") -> str:
    """A source's query with the high-water mark added."""
    return f"({query}) AND {field}>={since}" if since and query else query


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """The first of several paths that exists; the last sub-folder by name where one ends in '*'."""
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    for candidate in candidates:
        place = path(candidate)
        found = place.getFileSystem(conf).globStatus(place)
        if found:
            return max(str(f.getPath()) for f in found)
    raise FileNotFoundError(", ".join(candidates))
