"""Sources and sinks over the driver's tables: written in the shape of the source, read back through its reader."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.functions import dates
from noticeweave.operators.durable import new_folder
from noticeweave.plans.registry import Tables, query
from noticeweave.sources import files, paged, sinks, tags, versions


def _lines(t: Tables, df: DataFrame, name: str) -> str:
    """Writes rows of one text column as a folder of text files."""
    folder = new_folder(t._spark, name)
    df.write.text(folder)
    return folder


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ', "x"' || chr(10) || 'y' AS c_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def csv_strings(t: Tables) -> DataFrame:
    """Quotes, line breaks and empty cells survive."""
    rows = t.customer.select("c_custkey", F.concat("c_name", F.lit(', "x"\ny')).alias("c_name"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return sinks.write_csv(rows, new_folder(t._spark, "csv"), ["c_custkey", "c_name", "c_mktsegment"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 1 THEN o_totalprice END AS price FROM orders")
def csv_typed(t: Tables) -> DataFrame:
    """What is empty or no number is null."""
    price = F.when(F.col("o_orderkey") % 4 == 0, "").when(F.col("o_orderkey") % 4 == 1, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    folder = new_folder(t._spark, "csv")
    sinks.write_csv(t.orders.select("o_orderkey", price.alias("price")), folder, ["o_orderkey", "price"])
    return files.typed_csv(t._spark, folder, {"o_orderkey": "bigint", "price": "double"})


@query("""SELECT c_nationkey AS nation, c_custkey AS key, c_name || CASE WHEN c_custkey % 7 = 0 THEN chr(10) || ', "x"' || chr(10) ELSE ', x' END AS name FROM customer""")
def csv_multi_header(t: Tables) -> DataFrame:
    """A file a nation, three rows of labels and a header each, names with line breaks; the last column of a label counts, and one nation's
    columns stand otherwise."""
    name = F.concat(F.lit('"'), "c_name", F.when(F.col("c_custkey") % 7 == 0, '\n, ""x""\n').otherwise(", x"), F.lit('"'))
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    row = F.when(F.col("c_nationkey") == 3, F.concat_ws(",", name, F.lit("0"), nation, key)).otherwise(F.concat_ws(",", key, F.lit("0"), name, nation))
    usual, other = ["label,DIERCATEGORIE 1,naam,DIERCATEGORIE 1", ",,,", ",,,", "key,a,b,c"], ["naam,DIERCATEGORIE 1,DIERCATEGORIE 1,x", ",,,", ",,,", "a,b,c,key"]
    heads = t.customer.select("c_nationkey").distinct().select("c_nationkey", F.posexplode(F.when(F.col("c_nationkey") == 3, F.array(*map(F.lit, other))).otherwise(F.array(*map(F.lit, usual)))).alias("at", "line"))
    lines = heads.unionByName(t.customer.select("c_nationkey", (F.col("c_custkey") + 4).alias("at"), row.alias("line")))
    folder = new_folder(t._spark, "multi")
    lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "at").select("line", F.col("c_nationkey").alias("part")).write.partitionBy("part").text(folder)
    rows = files.multi_header_csv(t._spark, folder, 3, {"key": "key", "nation": "DIERCATEGORIE 1", "name": "naam"})
    return rows.select(F.col("nation").cast("int").alias("nation"), F.col("key").cast("bigint").alias("key"), "name")


@query("""SELECT lower(n_name) AS place, string_agg(DISTINCT r_name, ',' ORDER BY r_name) AS provinces FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def csv_headless_places(t: Tables) -> DataFrame:
    """Five lines to skip, no header, semicolons; each place's provinces."""
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat_ws(";", F.lower("n_name"), F.lit("gemeente"), "r_name").alias("line"))
    text = rows.agg(F.concat(F.lit("\n".join(f"junk {i}" for i in range(5)) + "\n"), F.array_join(F.array_sort(F.collect_list("line")), "\n")).alias("value"))  # 25 rows
    places = files.headless_csv(t._spark, _lines(t, text, "places"), ["place", "municipality", "province"], 5)
    return files.distinct_in_order(places, "place", "province", "line_no").select("place", F.array_join("provinces", ",").alias("provinces"))


@query("SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(count(*) AS BIGINT) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1")
def csv_headless_large(t: Tables) -> DataFrame:
    """One file of all lines of orders behind five others, read in blocks by many tasks; some cells hold a line break."""
    note = F.when(F.col("l_linenumber") == 1, '"a\n;b"').otherwise("c")
    line = F.concat_ws(";", F.col("l_orderkey").cast("string"), note, F.col("l_quantity").cast("string"))
    junk = t._spark.range(5).select(F.lit(0).alias("at"), F.concat(F.lit("junk "), F.col("id").cast("string")).alias("line"))
    folder = new_folder(t._spark, "large")
    junk.unionByName(t.lineitem.select(F.lit(1).alias("at"), line.alias("line"))).repartition(1).sortWithinPartitions("at").select("line").write.text(folder)  # a task writes its file, sorted on disk if need be
    rows = files.headless_csv(t._spark, folder, ["l_orderkey", "note", "quantity"], 5).where("note RLIKE '^(c|a\n;b)$'")
    return rows.groupBy(F.col("l_orderkey").cast("bigint").alias("l_orderkey")).agg(F.count("*").alias("n"), F.sum(F.col("quantity").cast("double")).cast("bigint").alias("quantity"))


@query("""WITH s AS (SELECT p_type, CAST(count(*) AS DOUBLE) AS v FROM part GROUP BY 1)
  SELECT g AS name, coalesce(sum(v), 0) AS total FROM (VALUES ('kippen', 'ECONOMY'), ('kippen', 'STANDARD'), ('varkens', 'PROMO'), ('geiten', 'none')) x(g, p_type) LEFT JOIN s USING (p_type) GROUP BY 1""")
def labelled_statistics(t: Tables) -> DataFrame:
    """Exact labels, two of them in one group, one that is not there."""
    rows = t.part.groupBy("p_type").agg(F.count("*").cast("string").alias("n"))
    return files.labelled_totals(rows, "p_type", "n", {"kippen": ["ECONOMY", "STANDARD"], "varkens": ["PROMO"], "geiten": ["none"]})


@query("""SELECT c_nationkey AS page, c_custkey AS id, c_name || ' caf\u00e9 \u00e9&' AS title, 'https://x.nl/doc/' || c_custkey AS url, CASE WHEN c_custkey % 2 = 0 THEN 'https://x.nl/p/' || c_custkey || '.pdf' ELSE '' END AS pdf, c_mktsegment AS kind
  FROM customer WHERE c_custkey % 5 <> 0""")
def html_result_list(t: Tables) -> DataFrame:
    """Entries of result pages, by subtitle or heading, with items that are not ended, lists within them, and lists before and behind;
    those without title go. A page a hundred customers."""
    key, own = F.col("c_custkey"), F.col("c_custkey").cast("string")
    title = F.when(key % 5 == 0, " ").otherwise(F.concat("c_name", F.lit(" caf&eacute; &#233;&amp;")))
    link = F.concat(F.lit('<a href="/doc/'), own, F.lit('" class="'), F.when(key % 3 == 0, "b result--subtitle").otherwise("x"), F.lit('">'), title, F.lit("</a>"))
    terms = F.concat(F.lit("<dl><dt>SOORT<dd>"), "c_mktsegment", F.lit("<dt> Nr </dt><dd>"), own, F.lit("</dl>"))
    pdf = F.when(key % 2 == 0, F.concat(F.lit('<a href="p/'), own, F.lit('.pdf">pdf</a>'))).otherwise("")
    item = F.concat(F.lit("<li><h2>"), link, F.lit("</h2><ul><li>within</li></ul>"), terms, pdf, F.when(key % 2 == 0, "</li>").otherwise("</b>"))
    pages = t.customer.groupBy(F.floor(key / 100).alias("__page"), "c_nationkey").agg(F.array_join(F.collect_list(item), "").alias("items"))  # a hundred rows at most
    other = '<ul><li><h2><a href="/menu">menu</a></h2><dl><dt>Nr</dt><dd>1</dd></dl></li></ul>'
    pages = pages.select(F.col("c_nationkey").alias("page"), F.concat(F.lit(f'{other}<div id="Publicaties"><ul>'), "items", F.lit(f"</ul></div>{other}")).alias("html"))
    rows = tags.result_items(pages, "html", "https://x.nl", "Publicaties", {"kind": "Soort", "id": "Nr"})
    return rows.select("page", F.col("id").cast("bigint").alias("id"), "title", "url", "pdf", "kind")


@query("SELECT o_custkey AS page, o_orderkey AS id, o_orderpriority AS subject FROM orders WHERE o_orderstatus = 'F' AND (o_orderpriority = '1-URGENT' OR contains(lower(o_orderpriority), 'medium'))")
def xml_record_filter(t: Tables) -> DataFrame:
    """Records of XML pages, a field under either of two names, filtered by kind and subject."""
    key = F.col("o_orderkey").cast("string")
    name = F.when(F.col("o_orderkey") % 2 == 0, "subject").otherwise("rubriek")
    record = F.concat(F.lit("<sru:record><dt:id>"), key, F.lit("</dt:id><kind>"), "o_orderstatus", F.lit("</kind><"), name, F.lit(">"), "o_orderpriority", F.lit("</"), name, F.lit("></sru:record>"))
    pages = t.orders.groupBy(F.col("o_custkey").alias("page")).agg(F.array_join(F.collect_list(record), "").alias("xml"))
    rows = files.xml_records(pages, "xml", "record", {"id": ["id"], "kind": ["kind"], "subject": ["subject", "rubriek"]})
    return files.wanted_records(rows, "kind", ["F"], "subject", ["1-URGENT"], "medium").select("page", F.col("id").cast("bigint").alias("id"), "subject")


@query("""WITH p AS (SELECT o_custkey AS page, count(*) AS records FROM orders GROUP BY 1), w AS (SELECT page, records, coalesce(sum(records) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p)
  SELECT page, CAST(records AS INTEGER) AS records, CAST(before + records AS BIGINT) AS fetched FROM w WHERE before < 200""")
def xml_paging(t: Tables) -> DataFrame:
    """The pages that are fetched until the cap is reached."""
    pages = t.orders.groupBy(F.col("o_custkey").alias("page")).agg(F.concat(F.repeat(F.lit("<record>x</record>"), F.count("*").cast("int")), F.lit("<nextRecordPosition>9</nextRecordPosition>")).alias("xml"))
    return files.more_pages(pages, "xml", "page", 200)


@query("""SELECT user_id, event_type AS label, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) k FROM events WHERE event_type <> 'error') WHERE k = 1""")
def truth_labels(t: Tables) -> DataFrame:
    """The last row of each key that has a label."""
    rows = t.events.select("user_id", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("label"), "event_id")
    return files.last_rows(rows, "user_id", "event_id", "label")


@query("SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 2 = 0 THEN ['n' || o_orderkey, 'o' || o_custkey] ELSE ['o' || o_custkey] END) AS key FROM orders")
def annotations_by_either_key(t: Tables) -> DataFrame:
    """An annotation is found by its new and by its old id."""
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("n"), F.col("o_orderkey").cast("string"))).otherwise("nan").alias("doc_id"), F.concat(F.lit("o"), F.col("o_custkey").cast("string")).alias("old_id"))
    return files.by_either_key(rows, ["doc_id", "old_id"], "key").select("o_orderkey", "key")


@query("SELECT count(*) AS n, strftime(max(o_orderdate), '%Y-%m-%d') AS latest FROM orders")
def high_water_mark(t: Tables) -> DataFrame:
    """What an earlier run has, by its dates as text."""
    return files.high_water_mark(t.orders, dates.any_date(F.date_format("o_orderdate", "dd-MM-yyyy"))).select("n", F.date_format("latest", "yyyy-MM-dd").alias("latest"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def append_without_repeats(t: Tables) -> DataFrame:
    """Three overlapping runs append each order once."""
    folder, rows = new_folder(t._spark, "appended"), t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    for part in ("o_orderkey % 2 = 0", "o_orderkey % 3 = 0", "true"):
        out = sinks.append_new(rows.where(part), folder, ["o_orderkey"])
    return out


@query("SELECT 'stages' AS metric, event_type AS name, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'segments', c_mktsegment, count(*) FROM customer GROUP BY 2")
def metrics_bundle(t: Tables) -> DataFrame:
    """Metrics written as JSON and read again."""
    parts = {"stages": t.events.groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("n")), "segments": t.customer.groupBy(F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("n"))}
    return sinks.write_metrics(parts, new_folder(t._spark, "metrics")).select("metric", F.inline(F.array(F.from_json("value", "name string, n long"))))


@query("SELECT 'failures' AS name, count(*) AS rows FROM orders WHERE o_totalprice > 400000 UNION ALL SELECT 'none', 0")
def side_outputs(t: Tables) -> DataFrame:
    """A side output with rows, one without, and the log of both."""
    log = new_folder(t._spark, "log")
    for name, rows in (("failures", t.orders.where("o_totalprice > 400000")), ("none", t.orders.where("o_orderkey < 0"))):
        out = sinks.log_run(t._spark, log, name, sinks.write_side(rows, new_folder(t._spark, name)))
    return out.select(F.col("run_id").alias("name"), "rows")


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'low' ELSE 'ok' END AS scheme, c_name FROM customer")
def enriched_in_place(t: Tables) -> DataFrame:
    """A table's next version, computed from the one before it, with one more column, known columns first."""
    folder = sinks.free_path(t._spark, new_folder(t._spark, "table"))
    before = versions.write_version(t.customer.select("c_custkey", "c_acctbal", "c_name"), folder)
    now = before.withColumn("scheme", F.when(F.col("c_acctbal") < 0, "low").otherwise("ok"))
    versions.write_version(sinks.arranged(now, ["c_custkey", "scheme"]), folder)
    return versions.read_version(t._spark, folder).drop("c_acctbal")


def _recorded(t: Tables, chunk: int) -> tuple[str, int]:
    """The orders as recorded responses of a paged source."""
    folder = new_folder(t._spark, "responses")
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("kind"), F.concat("o_orderpriority", F.lit(" <&>")).alias("subject"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("available"))
    return folder, paged.record_responses(rows, folder, chunk, "id")


@query("SELECT o_orderkey AS id, o_orderstatus AS kind, o_orderpriority || ' <&>' AS subject, strftime(o_orderdate, '%Y-%m-%d') AS available FROM orders WHERE o_orderdate >= DATE '1998-01-01'")
def paged_since(t: Tables) -> DataFrame:
    """A paged source from the date on that an earlier run has reached."""
    rows = paged.paged(t._spark, _recorded(t, 1_000)[0], since="1998-01-01")
    return rows.select(F.col("id").cast("bigint").alias("id"), "kind", "subject", "available")


@query("SELECT least(count(*), 2500) AS fetched_rows, count(*) FILTER (o_orderkey % 3 <> 0 AND n <= 2500) AS new_rows, count(*) AS total_available, count(*) >= 2500 AS reached_cap, count(*) > 2500 AS more_available FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)")
def fetch_metadata(t: Tables) -> DataFrame:
    """What a run with a cap has fetched and what of it is new, counted while it is written, in the file beside the table."""
    folder, total = _recorded(t, 1_000)
    out, known = new_folder(t._spark, "fetched"), F.col("id").cast("bigint") % 3 == 0
    rows = paged.paged(t._spark, folder, limit=2_500)
    seen = sinks.write_observed(rows, lambda own: own.where(~known).write.parquet(out), fetched=F.count(F.lit(1)), new=F.count_if(~known))
    told = sinks.write_metadata(t._spark, f"{out}-metadata", seen["fetched"], seen["new"], total, limit=2_500, chunk=1_000)
    return told.select("fetched_rows", "new_rows", "total_available", "reached_cap", "more_available")
