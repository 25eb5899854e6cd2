"""Joins, identity, merges and picks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeweave.functions import address, text
from noticeweave.operators import identity, matching, merge, picks, records
from noticeweave.plans.registry import Tables, query


@query("SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 20")
def registry_join_inner(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part.where("p_size < 20"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_brand")


@query("SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_name, '') AS p_name FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 20) ON l_partkey = p_partkey")
def registry_join_left(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part.where("p_size < 20"), F.col("l_partkey") == F.col("p_partkey"), "left").select("l_orderkey", "l_linenumber", "l_partkey", F.coalesce("p_name", F.lit("")).alias("p_name"))


@query("""WITH a AS (SELECT p_partkey AS rel, CASE WHEN p_partkey % 2 = 0 THEN 'new ' ELSE 'only ' END || p_name AS street, CASE WHEN p_partkey % 7 <> 0 THEN p_brand ELSE '' END AS place FROM part WHERE p_size < 20)
  SELECT l_orderkey, l_linenumber, l_partkey AS rel, coalesce(street, '') AS street, coalesce(place, '') AS place FROM lineitem LEFT JOIN a ON rel = l_partkey""")
def registry_combined(t: Tables) -> DataFrame:
    """J01 with rows that lack an address: of several addresses of a relation the last counts."""
    one = t.part.where("p_size < 20").select(F.col("p_partkey").alias("rel"), F.concat(F.lit("only "), "p_name").alias("street"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).alias("place"), F.lit(1).alias("line"))
    later = one.where("rel % 2 = 0").select("rel", F.replace("street", F.lit("only "), F.lit("new ")).alias("street"), "place", F.lit(2).alias("line"))
    animals = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("rel"))
    return records.combined(animals, later.unionByName(one), "rel", "line", missing=True)


@query("""WITH a AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS notices, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
  SELECT a.*, coalesce(c_name, '') AS name, coalesce(c_mktsegment, '') AS segment FROM a LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0) ON c_custkey = o_custkey""")
def aggregate_with_address(t: Tables) -> DataFrame:
    """Sums by relation with the columns of a dimension, blank where it lacks the relation."""
    sums = t.orders.groupBy("o_custkey").agg(F.count("*").alias("notices"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    known = t.customer.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit(1).alias("line"))
    return records.combined(sums, known, "o_custkey", "line", missing=True)


@query("SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_custkey // 20 = s_suppkey // 2")
def crosswalk_exact(t: Tables) -> DataFrame:
    """All pairs at one address, written in two ways; as many at an address at every size."""
    at = lambda street, number: address.match_key(F.lit(street), F.floor(number).cast("string"), F.lit(""), F.lit("1234 ab"), F.lit("Anna")).alias("k")
    a = t.customer.select("c_custkey", at("Kerk-straat", F.col("c_custkey") / 20))
    return a.join(t.supplier.select("s_suppkey", at("kerk straat", F.col("s_suppkey") / 2)), "k").select("c_custkey", "s_suppkey")


def _key_sql(name: str) -> str:
    stop = ", ".join(f"'{w}'" for w in text.MATCH_STOPWORDS)
    words = f"string_split(regexp_replace(strip_accents(lower({name})), '[^a-z0-9_ ]', ' ', 'g'), ' ')"
    return f"array_to_string(list_sort(list_filter({words}, lambda w: w <> '' AND w NOT IN ({stop}))), ' ')"


_PERMIT = "CASE c_custkey % 5 WHEN 0 THEN 'Maatschap ' || c_name || ' en Zn.' WHEN 1 THEN c_name || ' V.O.F' WHEN 2 THEN 'Melkveehouderij de ' || c_name WHEN 3 THEN 'Vennootschap onder Firma ' || c_name ELSE c_name || ' B.V. Holding' END"
_REGISTERED = "CASE c_custkey % 5 WHEN 0 THEN 'ZN EN ' || c_name || ' mts' WHEN 1 THEN 'f o v ' || c_name WHEN 2 THEN c_name || ', dé bedrijf' WHEN 3 THEN c_name || ' en' ELSE 'bv b v ' || c_name END"


@query(f"""WITH a AS (SELECT c_custkey, {_key_sql(_PERMIT)} AS name, 'kerk straat ' || c_nationkey AS street, '1234AB' AS code FROM customer),
  b AS (SELECT c_custkey + c_custkey % 2 AS register_key, {_key_sql(_REGISTERED)} AS name, 'kerk straat ' || c_nationkey AS street, CASE WHEN c_custkey % 7 = 0 THEN '9999ZZ' ELSE '1234AB' END AS code FROM customer)
  SELECT c_custkey, register_key, name FROM a JOIN b USING (name, street, code)""")
def name_key_match(t: Tables) -> DataFrame:
    """Names without legal forms, streets and postcodes of two tables, joined on all three; some names or postcodes differ."""
    permit, registered = F.expr(_PERMIT), F.expr(_REGISTERED)
    street = lambda sign: text.clean_text(F.concat(F.lit(f"Kerk{sign}straat "), F.col("c_nationkey").cast("string")))
    a = t.customer.select("c_custkey", text.name_key(permit).alias("name"), street("-").alias("street"), text.clean_postcode(F.lit("1234 ab")).alias("code"))
    code = F.when(F.col("c_custkey") % 7 == 0, "9999 zz").otherwise("1234AB")
    b = t.customer.select((F.col("c_custkey") + F.col("c_custkey") % 2).alias("register_key"), text.name_key(registered).alias("name"), street(". ").alias("street"), text.clean_postcode(code).alias("code"))
    return a.join(b, ["name", "street", "code"]).select("c_custkey", "register_key", "name")


@query("""WITH n AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Stichting "De Hoeve"/(' || c_name || ') B.V.' WHEN 1 THEN 'V.O.F. Jansen & ' || c_name WHEN 2 THEN 'VOF; Ménage ' || c_name || ' bv' ELSE ' Firma' END AS name FROM customer)
  SELECT c_custkey, array_to_string(list_filter(string_split(translate(lower(name), ',.;:-/\\|()[]{}''"', repeat(' ', 17)), ' '), lambda w: w <> '' AND w NOT IN ('bv', 'b.v.', 'vof', 'v.o.f.', 'stichting', 'maatschap', 'mts', 'vennootschap', 'onder', 'firma')), ' ') AS name FROM n""")
def plain_names(t: Tables) -> DataFrame:
    """F16: names as they are compared in the order of their words."""
    kinds = [F.concat(F.lit('Stichting "De Hoeve"/('), "c_name", F.lit(") B.V.")), F.concat(F.lit("V.O.F. Jansen & "), "c_name"), F.concat(F.lit("VOF; Ménage "), "c_name", F.lit(" bv")), F.lit(" Firma")]
    name = F.get(F.array(*kinds), (F.col("c_custkey") % 4).cast("int"))
    return t.customer.select("c_custkey", text.plain_name(name).alias("name"))


def _keyed(i: int, columns: str, suffix: str = "") -> str:
    return f"SELECT {columns}, unnest(list_filter(list_distinct([p_name, split_part(p_name, ' ', {i}), p_name[1:6]]), lambda x: x <> '')){suffix} AS k FROM part"


def _name_keys(i: int) -> Column:
    return F.array_distinct(F.array("p_name", F.split_part("p_name", F.lit(" "), F.lit(i)), F.substring("p_name", 1, 6)))


def _other_brands(t: Tables, keys: Callable[[int], Column]) -> DataFrame:
    """All parts with all parts of another brand that share a key. Frequent keys are left to AQE."""
    left = t.part.select(F.struct("p_partkey", "p_brand").alias("a"), "p_name", "p_size")
    right = t.part.select(F.struct(F.col("p_partkey").alias("other"), "p_brand").alias("b"), "p_name", "p_size")
    pairs = matching.variant_join(left, right, "a", "b", keys(1), keys(2))
    return pairs.where("a.p_brand <> b.p_brand").select("a.p_partkey", "b.other", "key")


@query(f"""WITH l AS ({_keyed(1, "p_partkey, p_brand AS brand", " || '|' || p_size")}), r AS ({_keyed(2, "p_partkey AS other, p_brand AS other_brand", " || '|' || p_size")})
  SELECT p_partkey, other, min(k) AS key FROM l JOIN r USING (k) WHERE brand <> other_brand GROUP BY 1, 2""")
def variant_key_match(t: Tables) -> DataFrame:
    """Keys of a name variant and the size, as an address key has a street variant and a number."""
    return _other_brands(t, lambda i: F.transform(F.filter(_name_keys(i), lambda k: k != ""), lambda k: F.concat(k, F.lit("|"), F.col("p_size").cast("string"))))


@query(f"""WITH l AS ({_keyed(1, "p_partkey, p_brand AS brand")}), r AS ({_keyed(2, "p_partkey AS other, p_brand AS other_brand")})
  SELECT p_partkey, other, min(k) AS key FROM l JOIN r USING (k) WHERE brand <> other_brand GROUP BY 1, 2""")
def variant_key_match_all(t: Tables) -> DataFrame:
    """Keys of a name variant alone; the result grows with the square of the frequent ones."""
    return _other_brands(t, _name_keys)


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def left_anti_unmatched(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS has_urgent FROM customer")
def semi_flag(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return merge.with_flag(t.customer.select("c_custkey"), urgent, ["c_custkey"], "has_urgent")


@query("""SELECT f.o_orderkey, f.o_custkey, f.o_totalprice, CASE WHEN e.o_orderkey IS NOT NULL THEN e.o_orderpriority ELSE f.o_orderpriority END AS o_orderpriority
  FROM (SELECT o_orderkey, o_custkey, o_totalprice, '0-NEW' AS o_orderpriority FROM orders WHERE o_orderdate >= DATE '1997-01-01') f
  LEFT JOIN (SELECT * FROM orders WHERE o_orderdate < DATE '1999-01-01') e USING (o_orderkey)""")
def upsert_merge(t: Tables) -> DataFrame:
    fresh = t.orders.where("o_orderdate >= '1997-01-01'").select("o_orderkey", "o_custkey", "o_totalprice", F.lit("0-NEW").alias("o_orderpriority"))
    return merge.upsert(fresh, t.orders.where("o_orderdate < '1999-01-01'"), ["o_orderkey"], ["o_orderpriority"])


@query("""WITH u AS (SELECT 0 AS part, c_nationkey AS k, c_name AS name FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT 1, s_nationkey, s_name FROM supplier)
  SELECT k, name FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY part, name) AS place FROM u) WHERE place = 1""")
def union_dedupe_priority(t: Tables) -> DataFrame:
    return merge.union_first([t.customer.where("c_acctbal > 5000").select(F.col("c_nationkey").alias("k"), F.col("c_name").alias("name")), t.supplier.select(F.col("s_nationkey").alias("k"), F.col("s_name").alias("name"))], ["k"])


@query("SELECT c_nationkey AS k FROM customer WHERE c_mktsegment = 'BUILDING' INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0")
def key_intersection(t: Tables) -> DataFrame:
    return t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_nationkey").alias("k")).intersect(t.supplier.where("s_acctbal > 0").select("s_nationkey"))


def _grouped(edges: str) -> str:
    """Components of edges (doc, k) by spreading smaller roots, one row a doc."""
    return f"""WITH RECURSIVE e AS ({edges}), hub AS (SELECT k, min(doc) AS h FROM e WHERE k IS NOT NULL GROUP BY 1), s AS (SELECT DISTINCT doc AS a, h AS b FROM e JOIN hub USING (k) WHERE doc <> h),
  both_ways AS MATERIALIZED (SELECT a, b FROM s UNION SELECT b, a FROM s), spread(doc, root) USING KEY (doc) AS (SELECT DISTINCT doc, doc FROM e
    UNION SELECT near.doc, min(w.root) FROM spread w JOIN both_ways x ON x.a = w.doc JOIN recurring.spread near ON near.doc = x.b WHERE w.root < near.root GROUP BY near.doc)
  SELECT doc, root FROM spread"""


@query(_grouped("SELECT l_partkey AS doc, l_orderkey || '/' || l_suppkey AS k FROM lineitem"))
def components(t: Tables) -> DataFrame:
    """All parts, grouped by deliveries: what one supplier sends for one order."""
    return identity.group_by_shared(t.lineitem.select(F.col("l_partkey").alias("doc"), F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_suppkey").cast("string")).alias("k")), "doc", "k").select("doc", "root")


@query(_grouped("SELECT l_partkey AS doc, l_orderkey AS k FROM lineitem"))
def components_by_order(t: Tables) -> DataFrame:
    """All parts, grouped by the orders that they share."""
    return identity.group_by_shared(t.lineitem.select(F.col("l_partkey").alias("doc"), F.col("l_orderkey").alias("k")), "doc", "k").select("doc", "root")


@query(_grouped(r"SELECT DISTINCT doc_id AS doc, nullif(trim(regexp_replace(lower(line), '\s+', ' ', 'g')), '') AS k FROM documents LEFT JOIN LATERAL (SELECT unnest(string_split(text, chr(10))) AS line) ON TRUE"))
def components_by_line(t: Tables) -> DataFrame:
    """All documents, grouped by the lines that they share but for case and spaces; those without any line stand alone."""
    line = F.trim(F.regexp_replace(F.lower(F.col("line")), r"\s+", " "))
    lines = t.documents.select(F.col("doc_id").alias("doc"), F.explode_outer(F.split("text", r"\n")).alias("line")).select("doc", F.when(line != "", line).alias("k")).distinct()
    return identity.group_by_shared(lines, "doc", "k").select("doc", "root")


@query("SELECT o_orderkey, 'FARM' || upper(substr(sha1(CAST(o_custkey AS VARCHAR)), 1, 12)) AS farm_id_new FROM orders")
def stable_id_hash(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", identity.hashed_id(F.col("o_custkey").cast("string")).alias("farm_id_new"))


@query("""WITH g AS (SELECT o_orderkey AS member, o_custkey AS root FROM orders), known AS (SELECT o_orderkey AS member, 'ID' || CAST(o_custkey % 400 AS VARCHAR) AS stable_id FROM orders WHERE o_orderdate < DATE '1997-01-01'),
  held AS (SELECT stable_id, root, count(*) AS n FROM g JOIN known USING (member) GROUP BY 1, 2), won AS (SELECT stable_id, root FROM (SELECT *, row_number() OVER (PARTITION BY stable_id ORDER BY n DESC, root) k FROM held) WHERE k = 1),
  taken AS (SELECT root, min(stable_id) AS id FROM won GROUP BY 1)
  SELECT g.root, coalesce(any_value(id), 'FARM' || upper(substr(sha1(CAST(min(member) AS VARCHAR)), 1, 12))) AS stable_id FROM g LEFT JOIN taken USING (root) GROUP BY 1""")
def stable_id_reconcile(t: Tables) -> DataFrame:
    groups = t.orders.select(F.col("o_orderkey").alias("member"), F.col("o_custkey").alias("root"))
    known = t.orders.where("o_orderdate < '1997-01-01'").select(F.col("o_orderkey").alias("member"), F.concat(F.lit("ID"), (F.col("o_custkey") % 400).cast("string")).alias("stable_id"))
    return identity.stable_ids(groups, known, "member", "root")


@query("SELECT c_custkey, 'doc_' || lpad(CAST(row_number() OVER (ORDER BY c_custkey) + 10 AS VARCHAR), 5, '0') AS doc_id FROM customer")
def sequence_ids(t: Tables) -> DataFrame:
    return identity.numbered(t.customer.select("c_custkey"), "c_custkey", "doc_id", "doc_", 5, 10)


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) k FROM events) WHERE k = 1")
def first_row_per_key(t: Tables) -> DataFrame:
    return picks.first_fields(t.events, ["user_id"], F.struct("ts", "event_id"), ["event_id", "event_type"])


@query("SELECT o_custkey, o_orderpriority AS priority FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) k FROM orders GROUP BY 1, 2) WHERE k = 1")
def mode_per_group(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(picks.most_frequent("o_orderpriority").alias("priority"))


@query("SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses, count(*) AS n FROM orders GROUP BY 1")
def set_concat(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(picks.joined_set("o_orderstatus").alias("statuses"), F.count("*").alias("n"))


@query("""SELECT c_custkey, min(c_name) AS c_name, coalesce(string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority), '') AS priorities, min_by(o_orderkey, o_orderkey) AS first_order
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def one_row_export(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(F.min("c_name").alias("c_name"), picks.joined_set("o_orderpriority", " | ").alias("priorities"), F.min("o_orderkey").alias("first_order"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS farm, 'permit_adres' AS m FROM orders WHERE o_totalprice > 400000), b AS (SELECT DISTINCT o_custkey AS farm, 'minfin_kvk_adres' AS m FROM orders WHERE o_orderstatus = 'F'),
  links AS (SELECT * FROM a UNION ALL SELECT * FROM b), best AS (SELECT farm, CASE min(CASE m WHEN 'permit_adres' THEN 1 ELSE 3 END) WHEN 1 THEN 'permit_adres' ELSE 'minfin_kvk_adres' END AS m FROM links GROUP BY 1)
  SELECT coalesce(CASE WHEN m IS NOT NULL AND c_acctbal < 0 THEN 'gelinkt_zonder_dieren' ELSE m END, 'niet_gelinkt') AS link_method, count(*) AS farms FROM customer LEFT JOIN best ON farm = c_custkey GROUP BY 1""")
def link_method_precedence(t: Tables) -> DataFrame:
    a = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("farm"), F.lit("permit_adres").alias("m"))
    b = t.orders.where("o_orderstatus = 'F'").select("o_custkey", F.lit("minfin_kvk_adres"))
    best = picks.by_precedence(a.union(b), ["farm"], "m", ["permit_adres", "permit_kvk_adres", "minfin_kvk_adres", "fosfaat_adres"])
    method = F.when(F.col("m").isNotNull() & (F.col("c_acctbal") < 0), "gelinkt_zonder_dieren").otherwise(F.col("m"))
    return t.customer.join(best, F.col("farm") == F.col("c_custkey"), "left").groupBy(F.coalesce(method, F.lit("niet_gelinkt")).alias("link_method")).agg(F.count("*").alias("farms"))


@query("""WITH s1 AS (SELECT DISTINCT c_custkey, s_suppkey FROM customer JOIN supplier ON c_custkey // 15 = s_suppkey AND s_acctbal > 3000), s2 AS (SELECT DISTINCT c_custkey, s_suppkey FROM customer JOIN supplier ON c_custkey // 30 = s_suppkey AND s_acctbal < 6000)
  SELECT c_custkey, s_suppkey, 'permit_adres' AS link_method FROM s1 UNION ALL SELECT c_custkey, s_suppkey, 'fosfaat_adres' FROM s2 WHERE c_custkey NOT IN (SELECT c_custkey FROM s1)
  UNION ALL SELECT c_custkey, -1, 'niet_gelinkt' FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM s1) AND c_custkey NOT IN (SELECT c_custkey FROM s2)""")
def staged_fallback_links(t: Tables) -> DataFrame:
    by = lambda suppliers, n: t.customer.join(suppliers, F.floor(F.col("c_custkey") / n) == F.col("s_suppkey")).select("c_custkey", "s_suppkey")
    first, second = by(t.supplier.where("s_acctbal > 3000"), 15), by(t.supplier.where("s_acctbal < 6000"), 30)
    return matching.staged_links(t.customer, [("permit_adres", first), ("fosfaat_adres", second)], "c_custkey", "s_suppkey").na.fill(-1, ["s_suppkey"])


@query("""SELECT o_orderkey, o_custkey, o_orderdate, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS INTEGER) AS place FROM orders QUALIFY place <= 2""")
def top_two_per_group(t: Tables) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey"))
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", place.alias("place")).where("place <= 2")
