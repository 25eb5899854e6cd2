"""Address keys, the master table, state between runs, and predicates over years and stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeweave.functions import address, dates, text
from noticeweave.operators import identity, master, matching, merge, metrics, records
from noticeweave.plans.metrics import registry
from noticeweave.plans.registry import Tables, query

_REGISTRY_SQL = "registry AS (SELECT o_custkey AS entity, p_type AS category, l_quantity AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"


def _text(name: str) -> Column:
    return F.col(name).cast("string")


@query("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE CAST(c_nationkey + 1 AS VARCHAR) END AS nr, CASE WHEN c_custkey % 2 = 0 THEN 'b' ELSE '' END AS addition FROM customer)
  SELECT c_custkey, CASE WHEN nr = '' THEN '' ELSE 'dorpsstraat|' || nr || '|' || addition || '|1234 ab|sint anna gld' END AS address_key, 'dorpsstraat|' || nr || '|' || addition || '|1234AB|sint anna gld' AS match_key FROM r""")
def address_keys(t: Tables) -> DataFrame:
    """F04, F05, F07, F08, F09 and F48."""
    number = text.house_number(F.when(F.col("c_custkey") % 5 != 0, F.concat((F.col("c_nationkey") + 1).cast("string"), F.lit(".0"))))
    parts = (F.lit(" Dórpsstraat"), number, F.when(F.col("c_custkey") % 2 == 0, " B "), F.lit("1234 ab"), F.lit("Sint Anna (Gld)"))
    return t.customer.select("c_custkey", address.address_key(*parts).alias("address_key"), address.match_key(*parts).alias("match_key"))


#: Streets and places as two registers write them; numbers are shared by twenty addresses of one and two of the other.
WRITTEN = [("Oude Weg", "Sint Anna"), ("Dorpsstraat", "Baak gld"), ("dr. Kuyperlaan", "Den Ham"), ("Yssel weg", "Zutphen"), ("Kerkdijk", "Anna")]
REGISTERED = [("oude wg.", "St. Anna"), ("Dorpsstr", "Baak"), ("Kuyperlaan", "Ham"), ("IJssel wg", "Zutphen"), ("Kerkdk", "Anna"), ("Oude Weg", "Anna"), ("Kerk-dijk", "Anna"), ("Dorpsstraat", "Baak (Gld)"), ("Kerkdijk", "Anna")]
#: Which of them are one address by all spellings of both sides, and by one key of the left against all of the right, with the street and place of their first shared key.
SAME = [(0, 0, "oude weg", "sint anna"), (1, 7, "dorpsstraat", "baak"), (2, 2, "kuyperlaan", "ham"), (3, 3, "ijssel weg", "zutphen"), (4, 8, "kerkdijk", "anna")]
SAME_KEY = [(0, 0, "oude weg", "sint anna"), (4, 8, "kerkdijk", "anna")]


def _addresses(t: Tables) -> tuple[DataFrame, DataFrame, list, list]:
    """Customers and suppliers with their addresses' parts."""
    written = lambda key, forms, i: F.element_at(F.array(*[F.lit(f[i]) for f in forms]), (F.col(key) % len(forms) + 1).cast("int"))
    left = t.customer.select("c_custkey", F.floor(F.col("c_custkey") / 20).cast("string").alias("nr"), written("c_custkey", WRITTEN, 0).alias("street"), written("c_custkey", WRITTEN, 1).alias("place"))
    right = t.supplier.select("s_suppkey", F.floor(F.col("s_suppkey") / 2).cast("string").alias("nr"), written("s_suppkey", REGISTERED, 0).alias("street"), written("s_suppkey", REGISTERED, 1).alias("place"))
    return left, right, [F.col("street"), F.col("nr"), F.lit(""), F.lit("1234 AB"), F.col("place")], [F.col("street"), F.col("nr"), F.lit(""), F.lit("1234ab"), F.col("place")]


def _candidates_sql(same: list[tuple]) -> str:
    pairs = ", ".join(f"({i}, {j}, '{street}', '{place}')" for i, j, street, place in same)
    return f"""SELECT c_custkey, s_suppkey, street || '|' || (s_suppkey // 2) || '||1234AB|' || place AS key FROM customer JOIN supplier ON c_custkey // 20 = s_suppkey // 2
  JOIN (VALUES {pairs}) same(l, r, street, place) ON l = c_custkey % {len(WRITTEN)} AND r = s_suppkey % {len(REGISTERED)}"""


@query(_candidates_sql(SAME))
def address_candidates(t: Tables) -> DataFrame:
    """J02 and X02 by F10, F11 and F12: both sides by all spellings; most pairs at a number are different addresses."""
    left, right, a, b = _addresses(t)
    return matching.variant_join(left, right, "c_custkey", "s_suppkey", address.variant_keys(*a), address.variant_keys(*b))


@query(_candidates_sql(SAME_KEY))
def canonical_candidates(t: Tables) -> DataFrame:
    """One key of the left side against all spellings of the right side's address keys."""
    left, right, a, b = _addresses(t)
    return matching.variant_join(left, right, "c_custkey", "s_suppkey", F.array(address.match_key(*a)), address.all_variant_keys(address.address_key(*b)))


@query("""SELECT s_suppkey, 'oude weg|' || s_suppkey || '||1234AB|anna' AS register_key, CAST(s_suppkey AS VARCHAR) AS number, CASE WHEN s_suppkey % 2 = 0 THEN 'a' ELSE 'x' END AS addition,
    '1234AB ' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN 'a' ELSE 'x' END AS place_query, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey AS VARCHAR) ELSE s_name END AS register_query,
    CASE WHEN s_suppkey % 4 = 0 THEN '' WHEN s_suppkey % 4 = 1 THEN s_name WHEN s_suppkey % 4 = 2 THEN repeat('De Hof ', 40) || s_suppkey ELSE 'Hof ' || s_suppkey END AS company FROM supplier""")
def register_forms(t: Tables) -> DataFrame:
    """F18, F24, F33, F55 and F57."""
    own = _text("s_suppkey")
    even = F.col("s_suppkey") % 2 == 0
    number, addition = address.split_suffix(F.concat(own, F.when(even, "a").otherwise("")), F.when(even, " ").otherwise("x"))
    place = F.when(F.col("s_suppkey") % 4 == 0, "Provincie Gelderland").otherwise("Provincie Noord-Brabant")
    company = text.kept_company(F.when(F.col("s_suppkey") % 4 == 1, F.col("s_name")), F.when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit("Het Bedrijf - "), F.repeat(F.lit("De Hof "), F.lit(40)), own, F.lit(" - LOCATIE - Anna"))).otherwise(F.concat(F.lit("Betreft bedrijf: Hof  "), own, F.lit(", locatie: Anna"))), place)
    return t.supplier.select("s_suppkey", address.register_key(F.lit("Oude weg"), own, F.lit("1234 ab"), F.lit("Anna, NB")).alias("register_key"), number.alias("number"), addition.alias("addition"), address.lookup_query(number, addition, F.lit("1234 ab")).alias("place_query"), address.lookup_query(None, None, None, "s_name", F.when(F.col("s_suppkey") % 3 == 0, own).otherwise("nan")).alias("register_query"), company.alias("company"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'noord-brabant' ELSE replace(lower(p_name), ' ', '_') || '_x' END AS slug, 'https://a.example/x/' || p_partkey AS url, CASE p_partkey % 4 WHEN 0 THEN 'nr_' || p_partkey || '.pdf' WHEN 1 THEN 'nr_zz' || p_partkey || '.PDF' WHEN 2 THEN 'download.pdf' ELSE 'b_' || p_partkey || '.x.pdf' END AS file, replace(format('{:,}', p_partkey * 1000), ',', '.') AS shown,
    CASE p_partkey % 3 WHEN 0 THEN 'bezoeklocatie' WHEN 1 THEN 'postlocatie' ELSE '' END AS kind, 'a' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || p_partkey AS texts, true AS same FROM part""")
def text_forms(t: Tables) -> DataFrame:
    """F01, F21, F32, F35, F50, F54 and F58."""
    own, kind = _text("p_partkey"), F.col("p_partkey") % 3
    place = text.location_kind(F.when(kind == 0, "x").otherwise("Ontbreekt"), F.when(kind == 1, "y"))
    same = text.compared(F.concat(F.lit(" A\n"), F.upper("p_name"))) == text.compared(F.concat(F.lit("a  "), "p_name"))
    return t.part.select("p_partkey", text.slug(F.when(F.col("p_partkey") % 2 == 0, "Provincie Noord.Brabant").otherwise(F.concat("p_name", F.lit("/x")))).alias("slug"), text.absolute_url(F.concat(F.lit("/x/"), own), "https://a.example/").alias("url"), text.file_name(F.get(F.array(F.concat(F.lit("https://a.example/map/nr%20"), own), F.concat(F.lit("https://a.example/nr%zz"), own, F.lit(".PDF?x=1/2#y")), F.lit("https://a.example?x.pdf"), F.concat(F.lit("b+"), own, F.lit(".x._/"))), (F.col("p_partkey") % 4).cast("int"))).alias("file"), text.thousands(F.col("p_partkey") * 1000).alias("shown"), place.alias("kind"), text.joined_texts(F.lit(" a "), F.lit(" "), own).alias("texts"), same.alias("same"))


@query("""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN year(o_orderdate) END AS a, CASE WHEN o_orderkey % 5 > 1 THEN year(o_orderdate) + o_orderkey % 2 END AS b FROM orders)
  SELECT o_orderkey, coalesce(a = 1997, false) AS strict FROM r WHERE a = 1997 OR b = 1997 OR (a IS NULL AND b IS NULL)""")
def year_rows(t: Tables) -> DataFrame:
    """Either year or none; and the year itself, undated rows left out."""
    year = F.year("o_orderdate")
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, year).cast("string").alias("gem_jaar"), F.when(F.col("o_orderkey") % 5 > 1, year + F.col("o_orderkey") % 2).cast("string").alias("jaar"))
    return rows.where(dates.within_year(["gem_jaar", "jaar"], 1997)).select("o_orderkey", dates.within_year(["gem_jaar"], 1997, undated=False).alias("strict"))


@query("""WITH s AS (SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS a, sum(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice ELSE 0 END) AS b FROM orders GROUP BY 1)
  SELECT o_custkey, a <= 0 OR b <= 0 OR a / b BETWEEN 0.5 AND 2 AS plausible FROM s""")
def plausible_totals(t: Tables) -> DataFrame:
    """P18."""
    total = lambda c: F.sum(F.when(c, F.col("o_totalprice")).otherwise(0))
    sums = t.orders.groupBy("o_custkey").agg(total(F.col("o_orderstatus") == "F").alias("a"), total(F.col("o_orderstatus") != "F").alias("b"))
    return sums.select("o_custkey", matching.plausible("a", "b").alias("plausible"))


@query("""SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS definitive, count(*) FILTER (o_orderstatus = 'F' AND o_orderdate <= DATE '1997-06-30' - 42) AS irrevocable, '1997-06-30' AS ref_date FROM orders GROUP BY 1""")
def irrevocable_decisions(t: Tables) -> DataFrame:
    """The term of 42 days is over at the reference date."""
    stage = F.when(F.col("o_orderstatus") == "F", "definitive_decision").otherwise("draft_decision")
    over = dates.irrevocable(stage, F.col("o_orderdate").cast("date"), "1997-06-30")
    return t.orders.groupBy("o_custkey").agg(F.count(F.when(stage == "definitive_decision", 1)).alias("definitive"), F.count(F.when(over, 1)).alias("irrevocable")).withColumn("ref_date", F.lit("1997-06-30"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN 'naam ' || c_custkey ELSE c_name END AS name, '' AS url FROM customer")
def standard_columns(t: Tables) -> DataFrame:
    """Standard names for what is filled of several columns."""
    rows = t.customer.withColumn("naam", F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("naam "), _text("c_custkey"))).otherwise(" "))
    return merge.first_columns(merge.require(rows, ["c_custkey"]), {"id": ["doc_id", "c_custkey"], "name": ["naam", "c_name"], "url": ["URL", "link"]})


@query("""SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'definitive_decision' ELSE lower(o_orderstatus) END AS stage, count(*) AS n FROM orders GROUP BY 1""")
def effective_stage(t: Tables) -> DataFrame:
    """The label given by hand, else the model's."""
    manual = F.when(F.col("o_orderkey") % 3 == 0, "definitive_decision").when(F.col("o_orderkey") % 3 == 1, "")
    return t.orders.groupBy(records.or_else(manual, F.lower("o_orderstatus")).alias("stage")).agg(F.count("*").alias("n"))


@query("""WITH rels AS (SELECT DISTINCT o_custkey AS farm, o_orderkey AS rel FROM orders WHERE o_orderpriority <> '5-LOW')
  SELECT DISTINCT farm FROM rels WHERE rel IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45 AND l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01')""")
def farms_with_animals(t: Tables) -> DataFrame:
    """E09, E10 and U04."""
    method = F.when(F.col("o_orderpriority") == "5-LOW", master.UNLINKED).otherwise("permit_adres")
    rows = t.orders.select(_text("o_custkey").alias("farm"), _text("o_orderkey").alias("rel"), method.alias("link_method"))
    counts = t.lineitem.where("l_shipdate >= '1997-01-01' AND l_shipdate < '1998-01-01'").select(_text("l_orderkey").alias("rel"), (F.col("l_quantity") - 45).alias("amount"))
    return master.with_any_count(master.farm_relations(rows, "farm", "rel"), counts, "farm", "rel", "amount").select(F.col("farm").cast("bigint").alias("farm"))


@query("""WITH l AS (SELECT o_custkey, o_orderkey, o_orderpriority FROM orders WHERE o_orderdate < DATE '1998-01-01')
  SELECT c_custkey, count(o_orderkey) AS n, coalesce(string_agg(o_orderpriority, ' | ' ORDER BY o_orderkey), '') AS labels FROM customer LEFT JOIN l ON o_custkey = c_custkey GROUP BY 1""")
def folded_notices(t: Tables) -> DataFrame:
    """An entity's list of documents, some of which the notices lack."""
    lists = t.orders.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: k.cast("string")), ", ").alias("docs"))
    entities = t.customer.join(lists, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "docs")
    return master.folded_notices(entities, "c_custkey", "docs", t.orders.where("o_orderdate < '1998-01-01'"), "o_orderkey", "o_orderpriority")


@query("""WITH g AS (SELECT o_orderkey AS member, o_custkey AS root, o_orderdate < DATE '1996-01-01' AS old FROM orders), ids AS (SELECT root, CASE WHEN bool_or(old) THEN 'ID' || root ELSE 'FARM' || upper(substr(sha1(CAST(min(member) AS VARCHAR)), 1, 12)) END AS stable_id FROM g GROUP BY 1)
  SELECT member, stable_id, CASE WHEN old THEN '2024-01-01' ELSE '2024-02-01' END AS created_at FROM g JOIN ids USING (root)""")
def identifier_state(t: Tables) -> DataFrame:
    """The state of one run carried into the next."""
    groups = t.orders.select(F.col("o_orderkey").alias("member"), F.col("o_custkey").alias("root"))
    known = t.orders.where("o_orderdate < '1996-01-01'").select(F.col("o_orderkey").alias("member"), F.concat(F.lit("ID"), _text("o_custkey")).alias("stable_id"), F.lit("2024-01-01").alias("created_at"))
    return identity.identifier_map(groups, identity.stable_ids(groups, known, "member", "root"), known, "member", "root", "2024-02-01")


@query("""WITH p AS (SELECT c_custkey, 'P' || c_custkey AS key, 'FARM' || (90000000 - c_custkey) AS farm FROM customer WHERE c_nationkey < 13), m AS (SELECT c_custkey, 'M' || c_custkey AS key, 'FARM' || c_custkey AS farm FROM customer WHERE c_nationkey >= 13),
  pl AS (SELECT p.*, 'R' || coalesce(a.s_suppkey, b.s_suppkey) AS rel,
      CASE WHEN c_custkey % 4 = 0 AND a.s_suppkey IS NOT NULL THEN 'permit_adres' WHEN b.s_suppkey IS NOT NULL THEN 'fosfaat_naam' ELSE 'niet_gelinkt' END AS link_method
    FROM p LEFT JOIN supplier a ON a.s_suppkey = c_custkey AND c_custkey % 4 = 0 LEFT JOIN supplier b ON b.s_suppkey * 3 = c_custkey AND a.s_suppkey IS NULL),
  f AS (SELECT rel, arg_min(farm, c_custkey) AS taken FROM pl WHERE rel IS NOT NULL GROUP BY 1),
  ml AS (SELECT m.*, 'R' || s_suppkey AS rel FROM m LEFT JOIN supplier ON s_suppkey = c_custkey - 1)
  SELECT key, farm, rel, 'permit' AS source, link_method, link_method <> 'niet_gelinkt' AS linked, true AS has_permit FROM pl
  UNION ALL SELECT key, coalesce(taken, farm), rel, 'recipient', CASE WHEN taken IS NOT NULL THEN 'linked_via_rel' WHEN rel IS NOT NULL THEN 'minfin_kvk_adres' ELSE 'niet_gelinkt' END, rel IS NOT NULL, false FROM ml LEFT JOIN f USING (rel)""")
def master_table(t: Tables) -> DataFrame:
    """Permits by address, else by name; recipients by register; shared relations; one schema."""
    entity = lambda sign, farm: t.customer.select(F.concat(F.lit(sign), _text("c_custkey")).alias("key"), F.concat(F.lit("FARM"), farm.cast("string")).alias("farm"), "c_custkey", "c_nationkey")
    permits, recipients = entity("P", 90_000_000 - F.col("c_custkey")).where("c_nationkey < 13"), entity("M", F.col("c_custkey")).where("c_nationkey >= 13")
    relations = t.supplier.select("s_suppkey", F.concat(F.lit("R"), _text("s_suppkey")).alias("rel"))
    by = lambda rows, c: rows.join(relations, c).select("key", "rel")
    address_pairs = by(permits.where("c_custkey % 4 = 0"), F.col("s_suppkey") == F.col("c_custkey"))
    name_pairs = by(permits, F.col("s_suppkey") * 3 == F.col("c_custkey"))
    register_pairs = by(recipients, F.col("s_suppkey") == F.col("c_custkey") - 1)
    rows = master.master_rows(permits.select("key", "farm", "c_custkey"), [("permit_adres", address_pairs), ("fosfaat_naam", name_pairs)], recipients.select("key", "farm"), [("minfin_kvk_adres", register_pairs)], "key", "farm", "rel", "c_custkey")
    return master.with_derived(rows, ["key", "farm", "rel", "source", "link_method", "linked", "has_permit"], linked=F.col("link_method") != master.UNLINKED, has_permit=F.col("source") == "permit")


@query(f"""WITH {_REGISTRY_SQL}, linked AS (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2),
  sums AS (SELECT category, sum(amount) AS total, sum(CASE WHEN entity IN (SELECT c_custkey FROM linked) THEN amount END) AS linked FROM registry GROUP BY 1)
  SELECT c.category, coalesce(total, 0) AS total, coalesce(linked, 0) AS linked, round(coalesce(linked / nullif(total, 0) * 100, 0), 4) AS share,
    round(greatest(0, 100 - coalesce(linked / nullif(total, 0) * 100, 0)), 4) AS rest FROM (SELECT DISTINCT p_type AS category FROM part) c LEFT JOIN sums USING (category)""")
def regional_shares(t: Tables) -> DataFrame:
    """CR: the shares of one region's farms in the national totals."""
    inside = t.customer.join(t.nation.where("n_regionkey = 2"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select(F.col("c_custkey").alias("entity"))
    return metrics.category_share(registry(t), inside, "entity", "category", "amount", t.part.select(F.col("p_type").alias("category")).distinct())


@query("""SELECT count(*) AS n, count(*) FILTER (quality IS DISTINCT FROM toxic) AS mismatches, round(avg(CASE WHEN quality IS NOT DISTINCT FROM toxic THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM labels""")
def confusion_scores(t: Tables) -> DataFrame:
    """How often two labels differ."""
    return metrics.scores(t.labels, "quality", "toxic")


#: Codes and housings of the older report's rows, and its order of categories.
HOUSINGS = [("A4.1", "Huisvesting rundve"), (" A1", ""), ("a1", "Huisvesting Rundve "), ("", "huisvesting kalkoe"), ("D1", "Kippen"), ("", " Varken HUISVESTING"), ("", "geiten"), ("", "konijn"), ("", ""), ("", "Eenden")]
# The order of the older report's categories.
OLDER_ORDER = ["kalkoenen", "kippen", "rundvee (excl. kalveren)", "vleeskalveren", "varken", "geiten", "eenden", "overig", ""]
_HOUSED = "trim(replace(trim(lower(housing)), 'huisvesting', ''))"


@query(f"""WITH k(kind, code, housing) AS (VALUES {", ".join(f"({i}, '{c}', '{h}')" for i, (c, h) in enumerate(HOUSINGS))}),
  s AS (SELECT CASE WHEN starts_with(trim(code), 'A4') THEN 'vleeskalveren' WHEN starts_with(trim(code), 'A') THEN 'rundvee (excl. kalveren)' ELSE replace(replace({_HOUSED}, 'kalkoe', 'kalkoenen'), 'rundve', 'rundvee') END AS category, sum(l_quantity) AS total,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS definitive, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS draft
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN k ON kind = p_size % {len(HOUSINGS)} WHERE year(l_shipdate) = 1997 GROUP BY 1)
  SELECT category, total, definitive, draft, CAST(row_number() OVER (ORDER BY coalesce(list_position(list_value({", ".join(f"'{c}'" for c in OLDER_ORDER)}), category), 99), category) AS INTEGER) AS place FROM s""")
def older_report(t: Tables) -> DataFrame:
    """L1-7, F46 and G23: totals of the older report by code or the housing's own words, in its order."""
    kind = (F.col("p_size") % len(HOUSINGS) + 1).cast("int")
    code, housing = (F.element_at(F.array(*[F.lit(h[i]) for h in HOUSINGS]), kind) for i in (0, 1))
    rows = t.lineitem.where("l_shipdate >= '1997-01-01' AND l_shipdate < '1998-01-01'").join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    total = lambda c: F.sum(F.when(c, F.col("l_quantity")).otherwise(0.0))
    sums = rows.groupBy(text.housing_text_category(code, housing).alias("category")).agg(F.sum("l_quantity").alias("total"), total(F.col("l_returnflag") == "R").alias("definitive"), total(F.col("l_returnflag") == "A").alias("draft"))
    return records.placed(sums, records.business_order("category", OLDER_ORDER), F.col("category"))


@query(f"""WITH {_REGISTRY_SQL}, own AS (SELECT CASE WHEN category IN ('SMALL', 'MEDIUM') THEN 'SMALL+MEDIUM' ELSE category END AS category, sum(amount) AS total FROM registry GROUP BY 1),
  known AS (SELECT CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'SMALL+MEDIUM' ELSE p_type END AS category, sum(p_size) * 100 AS outside FROM part GROUP BY 1)
  SELECT category, CAST(outside AS BIGINT) AS outside, coalesce(total, 0) AS total, round(coalesce(total * 100.0 / nullif(outside, 0), 0), 4) AS percent FROM known LEFT JOIN own USING (category)""")
def totals_against_statistics(t: Tables) -> DataFrame:
    """Regrouped categories against outside totals."""
    merged = lambda c: F.when(F.col(c).isin("SMALL", "MEDIUM"), "SMALL+MEDIUM").otherwise(F.col(c)).alias("category")
    known = t.part.groupBy(merged("p_type")).agg((F.sum("p_size") * 100).alias("outside"))
    return metrics.against_totals(known, registry(t).groupBy(merged("category")).agg(F.sum("amount").alias("total")), "category", "outside", "total")
