"""Joins by cut-off names, sums over shared relations, house numbers that stand for several, and identifiers kept by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.functions import numbers
from noticeweave.operators import closure, prefixes
from noticeweave.operators.durable import new_folder
from noticeweave.plans.registry import Tables, query
from noticeweave.streaming import identifiers


@query("""WITH l AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '1' ELSE CAST(p_size AS VARCHAR) END AS nr, CASE WHEN p_partkey % 97 = 0 THEN '' ELSE lower(p_name) END AS street, p_type AS place FROM part),
  r AS (SELECT p_partkey AS register_key, CASE WHEN p_partkey % 3 = 1 THEN '1' ELSE CAST(p_size AS VARCHAR) END AS nr, CASE WHEN p_partkey % 89 = 0 THEN '' ELSE left(lower(p_name), CAST(4 + p_partkey % 20 AS INTEGER)) || CASE WHEN p_partkey % 5 = 0 THEN ' oost' ELSE '' END END AS street, p_type AS place FROM part)
  SELECT p_partkey, register_key, l.street AS left_value, r.street AS right_value FROM l JOIN r ON l.nr = r.nr AND l.place = r.place AND (l.street = r.street OR (l.street <> '' AND r.street <> '' AND (starts_with(l.street, r.street) OR starts_with(r.street, l.street))))""")
def truncated_streets(t: Tables) -> DataFrame:
    """09's address match: the same house number, postcode and place, and one street begins the other. A third of each side has one number."""
    key, name = F.col("p_partkey"), F.lower("p_name")
    number = lambda rest: F.when(key % 3 == rest, "1").otherwise(F.col("p_size").cast("string"))
    left = t.part.select("p_partkey", number(0).alias("nr"), F.when(key % 97 != 0, name).alias("street"), F.col("p_type").alias("place"))
    cut = F.concat(F.substring(name, F.lit(1), (4 + key % 20).cast("int")), F.when(key % 5 == 0, " oost").otherwise(""))
    right = t.part.select(key.alias("register_key"), number(1).alias("nr"), F.when(key % 89 != 0, cut).otherwise("").alias("street"), F.col("p_type").alias("place"))
    return prefixes.prefix_join(left, right, "p_partkey", "register_key", ["nr", "place"], "street")


@query("""WITH n AS (SELECT conv_id, turn, turn + 1 AS a, turn + 4 AS b, (conv_id + turn) % 9 AS form FROM conversations),
  w AS (SELECT conv_id, turn, CASE form WHEN 0 THEN [[a, 0], [b, 0]] WHEN 1 THEN [[x, 0] FOR x IN generate_series(a, b)] WHEN 2 THEN [[a, 0], [a, 0], [b, 0]] WHEN 3 THEN [[a, 0], [b, 1]] WHEN 4 THEN [[x, 0] FOR x IN generate_series(a, b)]
    WHEN 5 THEN [[a, 0], [b, 2], [a, 0]] WHEN 6 THEN CASE WHEN conv_id % 50 = 0 THEN [[x, 0] FOR x IN generate_series(a, a + 1499)] ELSE [[a, 0], [b, 0]] END WHEN 7 THEN [[-1, 3]] ELSE [[a, 3]] END AS numbers, a || ' bis' AS odd FROM n)
  SELECT conv_id, turn, CASE WHEN x[1] < 0 THEN odd ELSE CAST(x[1] AS VARCHAR) END AS number, CASE x[2] WHEN 1 THEN 'X' WHEN 2 THEN 'BIS' WHEN 3 THEN 'own' ELSE '' END AS suffix FROM (SELECT conv_id, turn, odd, unnest(numbers) AS x FROM w)""")
def number_expand(t: Tables) -> DataFrame:
    """Every notation of several house numbers, ranges of any length, repeats; other rows stay as they are."""
    a, b, form = (F.col("turn") + 1).cast("string"), (F.col("turn") + 4).cast("string"), (F.col("conv_id") + F.col("turn")) % 9
    last = F.when(F.col("conv_id") % 50 == 0, F.concat(a, F.lit(" t/m "), (F.col("turn") + 1500).cast("string"))).otherwise(F.concat(a, F.lit("-"), b))
    forms = [F.concat(a, F.lit(" en "), b), F.concat(a, F.lit(" t/m "), b), F.concat_ws("-", a, a, b), F.concat(a, F.lit(" - "), b, F.lit("x")), F.concat(b, F.lit(" T/M "), a), F.concat(a, F.lit(", "), b, F.lit("bis en "), a), last, F.concat(a, F.lit(" bis"))]
    written = a
    for i, text in enumerate(forms):
        written = F.when(form == i, text).otherwise(written)
    return numbers.expanded(t.conversations.select("conv_id", "turn", written.alias("number"), F.lit("own").alias("suffix")), "number", "number", "suffix")


_CLOSURE = """WITH links AS (SELECT DISTINCT o_custkey AS farm, l_suppkey AS rel FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'),
  raw AS (SELECT l_suppkey AS rel, CASE WHEN l_returnflag = 'R' THEN '' ELSE l_returnflag || l_linestatus END AS category, CAST(l_quantity AS BIGINT) - 5 AS amount FROM lineitem WHERE year(l_shipdate) = 1997),
  counted AS (SELECT rel, category, sum(amount) AS amount FROM raw WHERE amount > 0 AND category <> '' GROUP BY 1, 2)"""


def _relations(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers linked to the suppliers of their orders, each of whom many share, and a year's counts by supplier."""
    links = t.orders.where("o_orderstatus <> 'P'").join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("farm"), F.col("l_suppkey").alias("rel"))
    category = F.when(F.col("l_returnflag") != "R", F.concat("l_returnflag", "l_linestatus")).otherwise("")
    counts = t.lineitem.where("l_shipdate >= '1997-01-01' AND l_shipdate < '1998-01-01'").select(F.col("l_suppkey").alias("rel"), category.alias("category"), (F.col("l_quantity").cast("bigint") - 5).alias("amount"))
    return links, counts


@query(f"""{_CLOSURE} SELECT category, CAST(sum(amount) AS BIGINT) AS amount, (SELECT count(DISTINCT farm) FROM links WHERE rel IN (SELECT rel FROM counted)) AS farms FROM links JOIN counted USING (rel) GROUP BY 1""")
def closure_by_category(t: Tables) -> DataFrame:
    """Totals over all farms of all their relations; a relation of several farms counts for each."""
    links, counts = _relations(t)
    farms = closure.closure_entities(links, counts, "farm", "rel", "category", "amount").agg(F.count("*").alias("farms"))
    return closure.closure_totals(links, counts, "farm", "rel", "category", "amount").join(F.broadcast(farms))  # one row


@query(f"{_CLOSURE} SELECT farm, category, CAST(sum(amount) AS BIGINT) AS amount FROM links JOIN counted USING (rel) GROUP BY 1, 2")
def closure_by_farm(t: Tables) -> DataFrame:
    """Each farm's sums over its relations."""
    links, counts = _relations(t)
    return closure.closure_sums(links, counts, "farm", "rel", "category", "amount")


@query("""WITH g AS (SELECT 'm' || c_custkey AS member, 'r' || c_nationkey || c_mktsegment AS root FROM customer), k AS (SELECT 'm' || c_custkey AS member, 'ID' || (c_custkey % 40) AS stable_id FROM customer WHERE c_custkey % 2 = 0),
  held AS (SELECT stable_id, root, count(*) AS n FROM g JOIN k USING (member) GROUP BY 1, 2), won AS (SELECT stable_id, root FROM held QUALIFY row_number() OVER (PARTITION BY stable_id ORDER BY n DESC, root) = 1)
  SELECT root, coalesce(min(stable_id), 'FARM' || upper(substr(sha1(min(member)), 1, 12))) AS stable_id FROM g LEFT JOIN won USING (root) GROUP BY 1""")
def stream_identifiers(t: Tables) -> DataFrame:
    """Identifiers as state of a stream whose files come in two runs, the second after a restart."""
    folder, source = new_folder(t._spark, "identifiers"), new_folder(t._spark, "groups")
    member = F.concat(F.lit("m"), F.col("c_custkey").cast("string"))
    groups = t.customer.select("c_custkey", member.alias("member"), F.concat(F.lit("r"), F.col("c_nationkey").cast("string"), "c_mktsegment").alias("root"))
    known = t.customer.where("c_custkey % 2 = 0").select(member.alias("member"), F.concat(F.lit("ID"), (F.col("c_custkey") % 40).cast("string")).alias("stable_id"))
    for part in ("c_custkey % 3 = 0", "c_custkey % 3 <> 0"):
        groups.where(part).drop("c_custkey").write.mode("append").parquet(source)
        out = identifiers.stream_ids(t._spark.readStream.schema("member string, root string").parquet(source), known, folder)
    return out
