"""Lookups, identity, fills and ordered output over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.functions import text
from noticeweave.operators import records
from noticeweave.plans.registry import Tables, query


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey % 3 <> 0 AND NOT contains(c_name, '77')")
def filled_and_not_matching(t: Tables) -> DataFrame:
    """P05 and P12."""
    rows = t.customer.select("c_custkey", "c_name", F.when(F.col("c_mktsegment") == "BUILDING", " nan ").otherwise(F.col("c_mktsegment")).alias("s"), F.when(F.col("c_custkey") % 3 != 0, "x").alias("k"))
    return rows.where(records.filled("s", "k") & records.not_matching("c_name", "77|TOTAAL")).select("c_custkey", "c_name")


#: Spellings of provinces.
SPELLINGS = ["Provincie Noord-Brabant", "brabant", " N.Brabant", "NoordBrabant", "noord_brabant", "Gelderland", "Zuidholland", "Z.Holland", "provincie zuid-holland ", "Noord  Holland", "n-holland", "Fryslân", "fryslan", "", "West-Brabant"]
_SPELLED = "list_value(" + ", ".join(f"'{s}'" for s in SPELLINGS) + f")[1 + c_custkey % {len(SPELLINGS)}]"
_PROVINCE = f"trim(regexp_replace(replace(trim(lower({_SPELLED})), 'provincie ', ''), '[-_. ]+', ' ', 'g'))"
_ONE_NAME = f"""CASE WHEN {_PROVINCE} IN ('noord brabant', 'noordbrabant', 'brabant', 'n brabant') THEN 'noord-brabant' WHEN {_PROVINCE} IN ('zuid holland', 'zuidholland', 'z holland') THEN 'zuid-holland'
  WHEN {_PROVINCE} IN ('noord holland', 'noordholland', 'n holland') THEN 'noord-holland' WHEN {_PROVINCE} IN ('fryslan', 'fryslân') THEN 'friesland' ELSE {_PROVINCE} END"""


def _spelled(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.element_at(F.array(*map(F.lit, SPELLINGS)), (1 + F.col("c_custkey") % len(SPELLINGS)).cast("int")).alias("p"))


@query(f"SELECT c_custkey FROM customer WHERE {_ONE_NAME} = 'noord-brabant'")
def in_province(t: Tables) -> DataFrame:
    """Names of one province in several spellings."""
    return records.in_province(_spelled(t), "p", "Noord.Brabant").select("c_custkey")


@query(f"SELECT c_custkey, {_ONE_NAME} AS province, replace(replace({_ONE_NAME}, ' ', '_'), '/', '_') AS slug FROM customer")
def province_names(t: Tables) -> DataFrame:
    """F20 and F21."""
    return _spelled(t).select("c_custkey", text.province("p").alias("province"), text.slug("p").alias("slug"))


@query("SELECT o_orderkey FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 500) WHERE o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT'")
def work_list(t: Tables) -> DataFrame:
    """The limit goes first, then what is done or labelled by hand."""
    return records.work_list(t.orders, "o_orderkey", 500, F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")


@query("SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'missing_path' WHEN o_orderstatus = 'F' THEN 'eligible' ELSE 'not_found' END AS status, count(*) AS n FROM orders GROUP BY 1")
def eligibility(t: Tables) -> DataFrame:
    """P10."""
    path = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise("x")
    return t.orders.groupBy(records.split_by_path(path, F.col("o_orderstatus") == "F").alias("status")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'farm ' || c_custkey END AS id, coalesce(c_acctbal > 0, false) AS has_animals, CASE WHEN c_nationkey = 3 THEN 'Onbekend' ELSE CAST(c_nationkey AS VARCHAR) END AS grp FROM customer""")
def fallback_fills(t: Tables) -> DataFrame:
    """P13, P15, P16, P20, P22 and P23."""
    new = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(" ")
    grp = F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string"))
    return t.customer.select("c_custkey", records.or_else(new, F.concat(F.lit("farm "), F.col("c_custkey").cast("string"))).alias("id"), text.positive(F.col("c_acctbal").cast("string")).alias("has_animals"), records.or_else(grp, F.lit("Onbekend")).alias("grp"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE o_orderpriority END AS o_orderpriority, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS extra FROM orders""")
def overwritten_rows(t: Tables) -> DataFrame:
    """The right side wins for the columns that it has."""
    right = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("done").alias("o_orderpriority"), F.col("o_totalprice").alias("extra"))
    return records.overwritten(t.orders.select("o_orderkey", "o_orderpriority", "o_custkey"), right, "o_orderkey")


@query("""SELECT l_partkey, l_suppkey, min_by(l_returnflag, l_orderkey * 10 + l_linenumber) AS flag, CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS quantity FROM lineitem GROUP BY 1, 2""")
def sum_with_first_row(t: Tables) -> DataFrame:
    """G01."""
    rows = t.lineitem.select("l_partkey", "l_suppkey", F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("quantity"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return records.first_of_group(rows, ["l_partkey", "l_suppkey"], "seq", ["quantity"]).select("l_partkey", "l_suppkey", "flag", records.whole_number("quantity").alias("quantity"))


@query("""SELECT o_custkey, CAST(CAST(round_even(sum(o_totalprice), 0) AS BIGINT) AS VARCHAR) AS total, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS keys FROM orders GROUP BY 1""")
def summary_by_entity(t: Tables) -> DataFrame:
    """Added up in the order of the rows, as halves depend on it."""
    keys = F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ";")
    orders = t.orders.select("o_custkey", "o_orderpriority", *records.running_sum("o_totalprice", ["o_custkey"], "o_orderkey"))
    return orders.groupBy("o_custkey").agg(records.half_even(F.max_by("sum", "place")).alias("total"), keys.alias("keys"))


@query("""WITH f AS (SELECT o_custkey, min_by(o_orderkey, o_orderkey) AS first_order FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)
  SELECT c_custkey, coalesce(CAST(first_order AS VARCHAR), '') AS first_order FROM customer LEFT JOIN f ON o_custkey = c_custkey""")
def first_hit_lookup(t: Tables) -> DataFrame:
    """The first row of each key, of those where a column is filled."""
    rows = t.orders.select(F.col("o_custkey").cast("string").alias("k"), "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"), F.col("o_orderkey").alias("first_order"))
    first = records.first_rows(rows, "k", "o_orderkey", "p")
    return records.lookup(t.customer.select("c_custkey", F.col("c_custkey").cast("string").alias("k")), first, ["k"], "k", ["first_order"]).select("c_custkey", "first_order")


@query("""WITH a AS (SELECT 's' || s_suppkey AS id, s_name AS label FROM supplier)
  SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_suppkey % 2 = 0 THEN n.label END, o.label, '') AS label
  FROM lineitem LEFT JOIN a n ON n.id = 's' || l_suppkey LEFT JOIN a o ON o.id = 's' || (l_partkey % 200)""")
def lookup_with_fallback_key(t: Tables) -> DataFrame:
    """By the new key, else by the old one."""
    known = t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("label"))
    new = F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("s"), F.col("l_suppkey").cast("string")))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", new.alias("doc_id"), F.concat(F.lit("s"), (F.col("l_partkey") % 200).cast("string")).alias("old_id"))
    return records.lookup(rows, known, ["doc_id", "old_id"], "id", ["label"]).select("l_orderkey", "l_linenumber", "label")


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN '' WHEN c_nationkey % 5 = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN 'Utrecht' ELSE 'Gelderland' END ELSE 'P' || (c_nationkey % 5) END AS province FROM customer""")
def province_with_tie_break(t: Tables) -> DataFrame:
    """Of several provinces the one that the authority names, else the first; places are told by their variants."""
    places = t.region.select((F.col("r_regionkey") % 5).alias("i")).distinct().where("i > 0").select(F.concat(F.lit("oud-"), F.col("i").cast("string")).alias("place"), F.when(F.col("i") == 1, F.array(F.lit("Gelderland"), F.lit("Utrecht"))).otherwise(F.array(F.concat(F.lit("P"), F.col("i").cast("string")))).alias("provinces"))
    rows = t.customer.select("c_custkey", F.concat(F.lit("Oud "), (F.col("c_nationkey") % 5).cast("string")).alias("place"), F.when(F.col("c_custkey") % 2 == 0, "provincie utrecht").otherwise("elders").alias("authority"))
    return records.province_of_place(rows, "place", places, "authority").select("c_custkey", "province")


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 5 < 2 THEN '' ELSE 'P' || (c_nationkey % 5) END AS province FROM customer""")
def province_unless_ambiguous(t: Tables) -> DataFrame:
    """J22."""
    places = t.region.select((F.col("r_regionkey") % 5).alias("i")).distinct().where("i > 0").select(F.concat(F.lit("oud "), F.col("i").cast("string")).alias("place"), F.when(F.col("i") == 1, F.array(F.lit("Gelderland"), F.lit("Utrecht"))).otherwise(F.array(F.concat(F.lit("P"), F.col("i").cast("string")))).alias("provinces"))
    rows = t.customer.select("c_custkey", F.concat(F.lit("oud-"), (F.col("c_nationkey") % 5).cast("string")).alias("place"))
    return records.province_of_place(rows, "place", places).select("c_custkey", "province")


@query("""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'doc_' || lpad(CAST(o_orderkey // 8 AS VARCHAR), 5, '0') END AS given FROM orders),
  k AS (SELECT given, min(o_orderkey) AS keeper FROM r WHERE given IS NOT NULL GROUP BY 1), o AS (SELECT r.*, keeper = o_orderkey AS kept FROM r LEFT JOIN k USING (given)),
  m AS (SELECT max(CAST(substr(given, 5) AS BIGINT)) AS most FROM o WHERE kept)
  SELECT o_orderkey, given AS doc_id FROM o WHERE kept UNION ALL
  SELECT o_orderkey, 'doc_' || lpad(CAST(most + row_number() OVER (ORDER BY o_orderkey) AS VARCHAR), CAST(greatest(5, len(CAST(most + row_number() OVER (ORDER BY o_orderkey) AS VARCHAR))) AS INTEGER), '0') FROM o, m WHERE kept IS DISTINCT FROM true""")
def kept_sequence_ids(t: Tables) -> DataFrame:
    """Valid old numbers stay, of repeated ones the first; the others go on behind the largest."""
    old = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("doc_"), F.lpad(F.floor(F.col("o_orderkey") / 8).cast("string"), 5, "0")))
    return records.kept_or_numbered(t.orders.select("o_orderkey", old.alias("doc_id")), "doc_id", "o_orderkey", "doc_", 5).select("o_orderkey", "doc_id")


@query("""WITH f AS (SELECT o_custkey, min(o_orderkey) AS first FROM orders GROUP BY 1), n AS (SELECT o_custkey, row_number() OVER (ORDER BY first) AS i, row_number() OVER (ORDER BY o_custkey) AS j FROM f)
  SELECT o_orderkey, 'c' || lpad(CAST(i AS VARCHAR), CAST(greatest(5, len(CAST(i AS VARCHAR))) AS INTEGER), '0') AS company_id, 'FARM' || lpad(CAST(j AS VARCHAR), CAST(greatest(4, len(CAST(j AS VARCHAR))) AS INTEGER), '0') AS farm_id FROM orders JOIN n USING (o_custkey)""")
def group_numbers(t: Tables) -> DataFrame:
    """W06 (first seen) and W05 (sorted)."""
    rows = t.orders.select("o_orderkey", "o_custkey")
    seen = records.group_numbers(rows, "o_custkey", "o_orderkey", "company_id", "c", 5)
    return records.group_numbers(seen, "o_custkey", "o_orderkey", "farm_id", "FARM", 4, first_seen=False).select("o_orderkey", "company_id", "farm_id")


@query("""WITH farms AS (SELECT o_orderkey AS seq, 'k' || (o_custkey % 400) AS kvk, 'n' || (o_custkey % 700) AS name, 'FARM' || lpad(CAST(o_custkey % 300 AS VARCHAR), 4, '0') AS farm FROM orders WHERE o_orderstatus = 'F'),
  bk AS (SELECT kvk, min_by(farm, seq) AS fk FROM farms GROUP BY 1), bn AS (SELECT name, min_by(farm, seq) AS fn FROM farms GROUP BY 1),
  r AS (SELECT c_custkey AS seq, 'k' || (c_custkey * 7 % 900) AS kvk, 'n' || (c_custkey * 3 % 1000) AS name FROM customer),
  j AS (SELECT r.*, coalesce(fk, fn) AS farm FROM r LEFT JOIN bk USING (kvk) LEFT JOIN bn USING (name)),
  firsts AS (SELECT kvk, min(seq) AS first FROM j WHERE farm IS NULL GROUP BY 1), num AS (SELECT kvk, row_number() OVER (ORDER BY first) + (SELECT max(CAST(substr(farm, 5) AS BIGINT)) FROM farms) AS i FROM firsts)
  SELECT seq, coalesce(farm, 'FARM' || lpad(CAST(i AS VARCHAR), CAST(greatest(4, len(CAST(i AS VARCHAR))) AS INTEGER), '0')) AS farm, farm IS NOT NULL AS reused FROM j LEFT JOIN num USING (kvk)""")
def reused_identity(t: Tables) -> DataFrame:
    """By register number, else by name, else a new number."""
    key = F.col("o_custkey")
    farms = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("k"), (key % 400).cast("string")).alias("kvk"), F.concat(F.lit("n"), (key % 700).cast("string")).alias("name"), F.concat(F.lit("FARM"), F.lpad((key % 300).cast("string"), 4, "0")).alias("farm"))
    own = F.col("c_custkey")
    recipients = t.customer.select(own.alias("seq"), F.concat(F.lit("k"), (own * 7 % 900).cast("string")).alias("kvk"), F.concat(F.lit("n"), (own * 3 % 1000).cast("string")).alias("name"))
    return records.reused_identity(recipients, farms, "kvk", "name", "seq", "farm").select("seq", "farm", "reused")


@query("""WITH p AS (SELECT o_custkey AS rel, min_by('F' || o_orderkey, o_orderkey) AS farm FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
  SELECT c_custkey, coalesce(farm, 'R' || c_custkey) AS farm FROM customer LEFT JOIN p ON rel = c_custkey""")
def rewritten_identity(t: Tables) -> DataFrame:
    """J18."""
    permits = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("rel"), F.concat(F.lit("F"), F.col("o_orderkey").cast("string")).alias("farm"), "o_orderkey")
    own = t.customer.select("c_custkey", F.col("c_custkey").cast("string").alias("rel"), F.concat(F.lit("R"), F.col("c_custkey").cast("string")).alias("farm"))
    return records.rewritten_identity(own, permits, "rel", "farm", "o_orderkey").select("c_custkey", "farm")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN 'KNOWN' || c_custkey ELSE 'FARM' || upper(substr(sha1(CAST(c_custkey AS VARCHAR)), 1, 12)) END AS farm_id FROM customer""")
def known_or_hashed_id(t: Tables) -> DataFrame:
    """E05."""
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_custkey").cast("string")).alias("rel"))
    known = t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("rel"), F.concat(F.lit("KNOWN"), F.col("c_custkey").cast("string")).alias("farm_id"))
    return records.known_or_hashed(rows, "rel", known, "farm_id").select("c_custkey", "farm_id")


@query("""SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'linked_via_rel' WHEN c_acctbal > 0 THEN 'minfin_kvk_adres' WHEN c_mktsegment = 'BUILDING' THEN 'fosfaat_adres' ELSE 'niet_gelinkt' END AS label, count(*) AS n FROM customer GROUP BY 1""")
def recipient_labels(t: Tables) -> DataFrame:
    """E07 and E08."""
    label = records.recipient_label(F.col("c_acctbal") > 0, F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment") == "BUILDING")
    return t.customer.groupBy(label.alias("label")).agg(F.count("*").alias("n"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'post' ELSE s_name END AS street, CASE WHEN s_suppkey % 3 = 0 THEN 'box' WHEN s_suppkey % 3 = 1 THEN '' ELSE '7' END AS number FROM supplier""")
def visiting_or_postal(t: Tables) -> DataFrame:
    """E11."""
    rows = t.supplier.select("s_suppkey", F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("v1"), F.when(F.col("s_suppkey") % 3 == 2, "7").otherwise("nan").alias("v2"), F.lit("post").alias("p1"), F.lit("box").alias("p2"))
    return rows.select("s_suppkey", *records.visiting_or_postal(["v1", "v2"], ["p1", "p2"], ["street", "number"]))


@query("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE 's' || c_nationkey END AS street, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN '1000 AA' ELSE CAST(1000 + c_nationkey AS VARCHAR) || ' AB' END AS code FROM customer),
  k AS (SELECT 's' || n_nationkey AS street, CAST(1000 + n_nationkey AS VARCHAR) || ' AB' AS found FROM nation WHERE n_nationkey < 20)
  SELECT c_custkey, CASE WHEN street <> '' AND found IS NOT NULL THEN found ELSE code END AS code,
    CASE WHEN street = '' THEN CASE WHEN code = '' THEN 'missing_components' ELSE '' END WHEN found IS NULL THEN 'no_match' WHEN code = '' THEN 'filled' WHEN code <> found THEN 'corrected' ELSE '' END AS change FROM r LEFT JOIN k USING (street)""")
def filled_postcodes(t: Tables) -> DataFrame:
    """E15."""
    code = F.concat((1000 + F.col("c_nationkey")).cast("string"), F.lit(" AB"))
    own = F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, "1000 AA").otherwise(code)
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 11 == 0, "").otherwise(F.concat(F.lit("s"), F.col("c_nationkey").cast("string"))).alias("street"), own.alias("code"))
    known = t.nation.where("n_nationkey < 20").select(F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).alias("street"), F.concat((1000 + F.col("n_nationkey")).cast("string"), F.lit(" AB")).alias("found"))
    return records.postcodes(rows, "code", ["street"], known, "found").select("c_custkey", "code", "change")


@query("SELECT o_orderkey, o_orderdate, o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderdate DESC, o_orderpriority, o_custkey, o_orderkey) AS INTEGER) AS place FROM orders QUALIFY place <= 100")
def newest_rows(t: Tables) -> DataFrame:
    """Several columns, mixed directions."""
    order = (F.desc("o_orderdate"), F.asc("o_orderpriority"), F.asc("o_custkey"), F.asc("o_orderkey"))
    return records.ranked(t.orders, 100, *order).select("o_orderkey", "o_orderdate", "o_orderpriority", "place")


@query("""WITH s AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
  SELECT event_type, n, CAST(row_number() OVER (ORDER BY CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 ELSE 3 END, event_type) AS INTEGER) AS place FROM s""")
def business_ordered(t: Tables) -> DataFrame:
    """L05."""
    sums = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    return records.placed(sums, records.business_order("event_type", ["purchase", "view"]), F.col("event_type"))


@query("SELECT o_orderpriority, max_by(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey, max(o_totalprice) AS price FROM orders GROUP BY 1")
def top_one_per_value(t: Tables) -> DataFrame:
    """L06 and L07."""
    return t.orders.groupBy("o_orderpriority").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("o_orderkey"), F.max("o_totalprice").alias("price"))


@query("SELECT coalesce(p_brand, '') AS brand, count(*) AS n FROM (SELECT CASE WHEN p_size > 5 THEN p_brand END AS p_brand FROM part) GROUP BY 1")
def counts_with_nulls(t: Tables) -> DataFrame:
    """G20."""
    return t.part.select(F.when(F.col("p_size") > 5, F.col("p_brand")).alias("b")).groupBy(F.coalesce("b", F.lit("")).alias("brand")).agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
  SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS customers, coalesce(b.n, 0) AS suppliers FROM a FULL JOIN b ON a.k = b.k""")
def aligned_totals(t: Tables) -> DataFrame:
    """Two sides aligned by key."""
    a = t.customer.where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    b = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "k", "full").na.fill(0, ["customers", "suppliers"])


@query("""SELECT o_custkey, count(*) FILTER (o_orderstatus IN ('F', 'O')) AS decided, count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS open_kinds,
    bool_and(o_orderstatus = 'P') AS receipt_only, coalesce(count(*) FILTER (o_orderstatus = 'F') * 100.0 / nullif(count(*), 0), 0) AS share FROM orders GROUP BY 1""")
def decided_or_open(t: Tables) -> DataFrame:
    """C13, C16 and G27."""
    status = F.col("o_orderstatus")
    return t.orders.groupBy("o_custkey").agg(F.count(F.when(status.isin("F", "O"), 1)).alias("decided"), F.count_distinct(F.when(status == "P", F.col("o_orderpriority"))).alias("open_kinds"), F.bool_and(status == "P").alias("receipt_only"), (F.count(F.when(status == "F", 1)) * 100.0 / F.count("*")).alias("share"))
