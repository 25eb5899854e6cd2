"""Report metrics: customers stand for entities, line items for the registry, part types for categories, events for notices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.functions.dates import elapsed_days, irrevocable
from noticeweave.operators import merge, metrics, picks, records
from noticeweave.plans.registry import Tables, query

REFERENCE = "2024-02-01"
# Which event stands for which stage, and the stages' ranks.
STAGE_OF = {"signup": "receipt_of_application", "view": "draft_decision", "purchase": "definitive_decision", "click": "intent_notice", "error": "other"}
RANKS = {"receipt_of_application": 0, "draft_decision": 1, "definitive_decision": 2}

_STAGE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STAGE_OF.items()) + " END"
_LATEST_SQL = f"""latest AS (SELECT user_id, ts, stage, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC,
  CASE stage WHEN 'receipt_of_application' THEN 0 WHEN 'draft_decision' THEN 1 WHEN 'definitive_decision' THEN 2 ELSE -1 END DESC, event_id DESC) k
  FROM (SELECT *, {_STAGE_SQL} AS stage FROM events)) WHERE k = 1)"""


def stages(t: Tables) -> DataFrame:
    stage = F.lit(None).cast("string")
    for event, name in STAGE_OF.items():
        stage = F.when(F.col("event_type") == event, name).otherwise(stage)
    return t.events.select("event_id", "user_id", "ts", stage.alias("stage"))


def latest(t: Tables) -> DataFrame:
    return picks.latest_status(stages(t), "user_id", "ts", "stage", RANKS, "event_id")


def registry(t: Tables) -> DataFrame:
    """(entity, category, amount)"""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("o_custkey").alias("entity"), F.col("p_type").alias("category"), F.col("l_quantity").alias("amount"))


_REGISTRY_SQL = "registry AS (SELECT o_custkey AS entity, p_type AS category, l_quantity AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"


@query(f"""WITH {_REGISTRY_SQL}, linked AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'),
  sums AS (SELECT category, sum(amount) AS total, sum(CASE WHEN entity IN (SELECT c_custkey FROM linked) THEN amount END) AS linked FROM registry GROUP BY 1)
  SELECT c.category, coalesce(total, 0) AS total, coalesce(linked, 0) AS linked, round(coalesce(linked / nullif(total, 0) * 100, 0), 4) AS share,
    round(greatest(0, 100 - coalesce(linked / nullif(total, 0) * 100, 0)), 4) AS rest
  FROM (SELECT DISTINCT p_type AS category FROM part) c LEFT JOIN sums USING (category)""")
def share_by_category(t: Tables) -> DataFrame:
    linked = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("entity"))
    return metrics.category_share(registry(t), linked, "entity", "category", "amount", t.part.select(F.col("p_type").alias("category")).distinct())


@query("""WITH farms AS (SELECT 'permit' AS source, c_nationkey AS farm FROM customer WHERE c_nationkey < 20 UNION ALL SELECT 'minfin', s_nationkey FROM supplier WHERE s_nationkey >= 5),
  per AS (SELECT farm, count(DISTINCT source) AS n, bool_or(source = 'permit') AS p, bool_or(source = 'minfin') AS m FROM farms GROUP BY 1)
  SELECT count(CASE WHEN p THEN 1 END) AS permit, count(CASE WHEN m THEN 1 END) AS minfin, count(CASE WHEN n > 1 THEN 1 END) AS overlap, count(*) AS unique_total FROM per""")
def source_overlap(t: Tables) -> DataFrame:
    permit = t.customer.where("c_nationkey < 20").select(F.lit("permit").alias("source"), F.col("c_nationkey").alias("farm"))
    both = permit.union(t.supplier.where("s_nationkey >= 5").select(F.lit("minfin"), "s_nationkey"))
    per = both.groupBy("farm").agg(F.countDistinct("source").alias("n"), F.bool_or(F.col("source") == "permit").alias("p"), F.bool_or(F.col("source") == "minfin").alias("m"))
    return per.agg(F.count(F.when(F.col("p"), 1)).alias("permit"), F.count(F.when(F.col("m"), 1)).alias("minfin"), F.count(F.when(F.col("n") > 1, 1)).alias("overlap"), F.count("*").alias("unique_total"))


@query(f"""WITH {_REGISTRY_SQL}, sums AS (SELECT entity, category, sum(amount) AS s FROM registry GROUP BY 1, 2),
  per AS (SELECT entity, count(CASE WHEN s > 50 THEN 1 END) AS n, max(CASE WHEN s > 50 THEN category END) AS single, max(s) AS top FROM sums GROUP BY 1),
  cls AS (SELECT entity, CASE WHEN n > 1 THEN 'Gemengde bedrijven' WHEN n = 1 THEN single ELSE (SELECT min(category) FROM sums x WHERE x.entity = per.entity AND x.s = per.top) END AS dominant FROM per)
  SELECT dominant, count(*) AS entities FROM cls GROUP BY 1""")
def dominant_category(t: Tables) -> DataFrame:
    return metrics.dominant_category(registry(t), "entity", "category", "amount").groupBy("dominant").agg(F.count("*").alias("entities"))


@query(f"""WITH {_REGISTRY_SQL}, per AS (SELECT category, sum(amount) AS total, count(DISTINCT entity) AS entities,
    sum(CASE WHEN entity % 7 = 3 THEN amount END) AS linked_total, count(DISTINCT CASE WHEN entity % 7 = 3 THEN entity END) AS linked_entities FROM registry WHERE amount > 0 GROUP BY 1)
  SELECT category, round_even(total / entities, 1) AS mean_all, round_even(coalesce(linked_total, 0) / nullif(linked_entities, 0), 1) AS mean_linked FROM per""")
def avg_per_entity(t: Tables) -> DataFrame:
    linked = F.col("entity") % 7 == 3
    per = registry(t).where("amount > 0").groupBy("category").agg(
        F.sum("amount").alias("total"), F.countDistinct("entity").alias("entities"), F.sum(F.when(linked, F.col("amount"))).alias("linked_total"), F.countDistinct(F.when(linked, F.col("entity"))).alias("linked_entities")
    )
    return per.select("category", F.bround(F.col("total") / F.col("entities"), 1).alias("mean_all"), F.bround(F.try_divide(F.coalesce("linked_total", F.lit(0.0)), F.col("linked_entities")), 1).alias("mean_linked"))


@query(f"WITH {_LATEST_SQL} SELECT user_id, ts, stage, event_id FROM latest")
def latest_stage_per_user(t: Tables) -> DataFrame:
    return latest(t)


@query(f"WITH {_LATEST_SQL} SELECT s.stage, count(l.user_id) AS farms FROM (SELECT unnest(['receipt_of_application', 'draft_decision', 'definitive_decision', 'intent_notice', 'other']) AS stage) s LEFT JOIN latest l USING (stage) GROUP BY 1")
def stage_counts(t: Tables) -> DataFrame:
    counts = latest(t).groupBy("stage").agg(F.count("*").alias("n"))
    dimension = t.events.sparkSession.createDataFrame([(s,) for s in STAGE_OF.values()], "stage string")
    return dimension.join(counts, "stage", "left").select("stage", F.coalesce("n", F.lit(0)).alias("farms"))


@query(f"""WITH {_LATEST_SQL} SELECT stage, count(*) AS farms, count(c_custkey) AS linked, count(*) - count(c_custkey) AS unlinked
  FROM latest LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 3000) ON user_id = c_custkey GROUP BY 1""")
def stage_linked(t: Tables) -> DataFrame:
    linked = t.customer.where("c_acctbal > 3000").select(F.col("c_custkey").alias("user_id"), F.lit(1).alias("hit"))
    return latest(t).join(linked, "user_id", "left").groupBy("stage").agg(F.count("*").alias("farms"), F.count("hit").alias("linked"), (F.count("*") - F.count("hit")).alias("unlinked"))


@query(f"""WITH d AS (SELECT date_diff('day', CAST(min(ts) AS DATE), DATE '{REFERENCE}') AS days FROM events WHERE event_type = 'signup' GROUP BY user_id)
  SELECT count(*) AS n, round(avg(days), 4) AS mean_days, CAST(min(days) AS BIGINT) AS min_days, CAST(max(days) AS BIGINT) AS max_days FROM d""")
def elapsed_days_stats(t: Tables) -> DataFrame:
    first = t.events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").cast("date").alias("day"))
    days = elapsed_days("day", REFERENCE)
    return first.agg(F.count("*").alias("n"), F.round(F.avg(days), 4).alias("mean_days"), F.min(days).cast("long").alias("min_days"), F.max(days).cast("long").alias("max_days"))


@query("SELECT CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') / 60) * 60 AS BIGINT) AS bin, count(*) AS n FROM orders GROUP BY 1")
def elapsed_histogram(t: Tables) -> DataFrame:
    return metrics.histogram(t.orders.select(F.col("o_orderdate").cast("date").alias("day")), elapsed_days("day", "2001-12-31"), 60)


@query(f"""WITH {_LATEST_SQL}, p AS (SELECT n_name AS province, stage, user_id, ts FROM latest JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)
  SELECT province, count(DISTINCT CASE WHEN stage = 'receipt_of_application' THEN user_id END) AS receipt_of_application, count(DISTINCT CASE WHEN stage = 'draft_decision' THEN user_id END) AS draft_decision,
    count(DISTINCT CASE WHEN stage = 'definitive_decision' THEN user_id END) AS definitive_decision FROM p GROUP BY 1""")
def province_stage_pivot(t: Tables) -> DataFrame:
    return province_stage_pivot_rows(t)


def province_stage_pivot_rows(t: Tables) -> DataFrame:
    placed = latest(t).join(t.customer, F.col("user_id") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return placed.groupBy(F.col("n_name").alias("province")).pivot("stage", list(RANKS)).agg(F.countDistinct("user_id")).na.fill(0, list(RANKS))


@query(f"""WITH {_LATEST_SQL}, p AS (SELECT n_name AS province, stage, user_id, ts FROM latest JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)
  SELECT province, count(DISTINCT user_id) AS total_farms, count(DISTINCT CASE WHEN stage = 'definitive_decision' THEN user_id END) AS definitive,
    count(DISTINCT CASE WHEN stage = 'definitive_decision' AND CAST(ts AS DATE) <= DATE '{REFERENCE}' - 3 THEN user_id END) AS irrevocable, '{REFERENCE}' AS ref_date FROM p GROUP BY 1""")
def province_overview(t: Tables) -> DataFrame:
    placed = latest(t).join(t.customer, F.col("user_id") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    final = F.col("stage") == "definitive_decision"
    counts = metrics.conditional_distinct("user_id", total_farms=F.lit(True), definitive=final, irrevocable=irrevocable("stage", F.col("ts").cast("date"), REFERENCE, 3))
    return placed.groupBy(F.col("n_name").alias("province")).agg(*counts).withColumn("ref_date", F.lit(REFERENCE))


@query("""SELECT n_name AS province, count(DISTINCT c_custkey) AS known, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN c_custkey END) AS definitive, 100 + n_nationkey AS participants,
    round(count(DISTINCT c_custkey) * 100.0 / (100 + n_nationkey), 4) AS known_percent
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_name, n_nationkey""")
def known_vs_total(t: Tables) -> DataFrame:
    final = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    counts = merge.with_flag(t.customer.select("c_custkey", "c_nationkey"), final, ["c_custkey"], "final").groupBy("c_nationkey").agg(F.count("c_custkey").alias("known"), F.count(F.when(F.col("final"), 1)).alias("definitive"))
    totals = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("province"), (100 + F.col("n_nationkey")).alias("participants"))
    known = F.coalesce("known", F.lit(0))
    return totals.join(counts, "c_nationkey", "left").select("province", known.alias("known"), F.coalesce("definitive", F.lit(0)).alias("definitive"), "participants", F.round(known * 100.0 / F.col("participants"), 4).alias("known_percent"))


@query(f"""WITH {_REGISTRY_SQL}, e AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')
  SELECT category, sum(amount) AS total, count(DISTINCT entity) AS farms FROM registry WHERE entity IN (SELECT user_id FROM e) GROUP BY 1""")
def definitive_by_category(t: Tables) -> DataFrame:
    final = t.events.where("event_type = 'purchase'").select(F.col("user_id").alias("entity")).distinct()
    return registry(t).join(final, "entity", "left_semi").groupBy("category").agg(F.sum("amount").alias("total"), F.countDistinct("entity").alias("farms"))


@query(f"""WITH {_REGISTRY_SQL}, stages AS (SELECT DISTINCT user_id AS entity, CASE event_type WHEN 'purchase' THEN 'definitive_decision' WHEN 'click' THEN 'draft_decision' ELSE 'other' END AS stage FROM events),
  s AS (SELECT category, stage, sum(amount) AS n FROM registry JOIN stages USING (entity) GROUP BY 1, 2)
  SELECT category, CAST(coalesce(sum(CASE WHEN stage = 'definitive_decision' THEN n END), 0) AS BIGINT) AS definitive_decision, CAST(coalesce(sum(CASE WHEN stage = 'draft_decision' THEN n END), 0) AS BIGINT) AS draft_decision
  FROM (VALUES ('ECONOMY'), ('PROMO'), ('STANDARD'), ('none')) c(category) LEFT JOIN s USING (category) GROUP BY 1""")
def animals_by_stage(t: Tables) -> DataFrame:
    """Sums by category and the stage of each row, not the latest one; zero where nothing is."""
    stage = F.when(F.col("event_type") == "purchase", "definitive_decision").when(F.col("event_type") == "click", "draft_decision").otherwise("other")
    stages = t.events.select(F.col("user_id").alias("entity"), stage.alias("stage")).distinct()
    return metrics.by_stage(registry(t).join(stages, "entity"), "category", "stage", "amount", ["ECONOMY", "PROMO", "STANDARD", "none"], ["definitive_decision", "draft_decision"])


@query(f"""WITH {_LATEST_SQL}, p AS (SELECT n_name AS province, count(DISTINCT CASE WHEN stage = 'draft_decision' THEN user_id END) AS draft_decision, count(DISTINCT CASE WHEN stage = 'definitive_decision' THEN user_id END) AS definitive_decision
    FROM latest JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
  SELECT *, CAST(row_number() OVER (ORDER BY definitive_decision DESC, draft_decision DESC, province) AS INTEGER) AS place FROM p""")
def provinces_by_stage(t: Tables) -> DataFrame:
    """The pivot of provinces in the report's order, by two counts descending."""
    pivot = province_stage_pivot_rows(t).select("province", "draft_decision", "definitive_decision")
    return records.placed(pivot, -F.col("definitive_decision"), -F.col("draft_decision"), F.col("province"))


@query("""SELECT l_returnflag, CAST(sum(CASE WHEN p_size <= 10 THEN l_quantity ELSE 0 END) AS BIGINT) AS small, CAST(sum(CASE WHEN p_size > 10 AND p_size <= 30 THEN l_quantity ELSE 0 END) AS BIGINT) AS middle,
    CAST(sum(CASE WHEN p_size > 30 THEN l_quantity ELSE 0 END) AS BIGINT) AS large FROM lineitem JOIN part ON l_partkey = p_partkey WHERE year(l_shipdate) = 1998 GROUP BY 1""")
def bucket_sums(t: Tables) -> DataFrame:
    rows = t.lineitem.where("l_shipdate >= '1998-01-01' AND l_shipdate < '1999-01-01'").join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    total = lambda c: F.sum(F.when(c, F.col("l_quantity")).otherwise(0)).cast("long")
    return rows.groupBy("l_returnflag").agg(total(F.col("p_size") <= 10).alias("small"), total(F.col("p_size").between(11, 30)).alias("middle"), total(F.col("p_size") > 30).alias("large"))


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2")
def confusion_matrix(t: Tables) -> DataFrame:
    return metrics.confusion(t.labels, "quality", "toxic")


@query("""WITH a AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS farms FROM orders WHERE o_orderdate < DATE '1998-01-01'), b AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS farms FROM orders)
  SELECT 'notices' AS what, a.n AS before_run, b.n AS after_run, b.n - a.n AS change FROM a, b UNION ALL SELECT 'farms', a.farms, b.farms, b.farms - a.farms FROM a, b""")
def run_delta(t: Tables) -> DataFrame:
    old = F.col("o_orderdate") < "1998-01-01"
    sums = t.orders.agg(F.count(F.when(old, 1)).alias("n0"), F.count("*").alias("n1"), F.countDistinct(F.when(old, F.col("o_custkey"))).alias("f0"), F.countDistinct("o_custkey").alias("f1"))
    return sums.select(F.inline(F.array(*[F.struct(F.lit(w).alias("what"), F.col(a).alias("before_run"), F.col(b).alias("after_run"), (F.col(b) - F.col(a)).alias("change")) for w, a, b in (("notices", "n0", "n1"), ("farms", "f0", "f1"))])))


@query(f"""WITH {_REGISTRY_SQL} SELECT CASE WHEN category IN ('SMALL', 'MEDIUM') THEN 'SMALL+MEDIUM' ELSE category END AS category, sum(amount) AS total, round(sum(amount) * 100.0 / (SELECT sum(amount) FROM registry), 4) AS percent FROM registry GROUP BY 1""")
def regrouped_totals(t: Tables) -> DataFrame:
    merged = F.when(F.col("category").isin("SMALL", "MEDIUM"), "SMALL+MEDIUM").otherwise(F.col("category"))
    sums = registry(t).groupBy(merged.alias("category")).agg(F.sum("amount").alias("total"))
    whole = sums.agg(F.sum("total").alias("whole"))  # one row
    return sums.join(F.broadcast(whole)).select("category", "total", F.round(F.col("total") * 100.0 / F.col("whole"), 4).alias("percent"))


@query(f"""WITH {_REGISTRY_SQL}, x AS (SELECT sum(amount) AS total, sum(CASE WHEN entity IN (SELECT user_id FROM events WHERE event_type = 'purchase') THEN amount ELSE 0 END) AS definitive FROM registry)
  SELECT total, definitive, round(coalesce(definitive / nullif(total, 0) * 100, 0), 4) AS percent FROM x""")
def definitive_progress(t: Tables) -> DataFrame:
    final = t.events.where("event_type = 'purchase'").select(F.col("user_id").alias("entity")).distinct().withColumn("final", F.lit(True))
    sums = registry(t).groupBy("entity").agg(F.sum("amount").alias("amount")).join(final, "entity", "left").agg(F.sum("amount").alias("total"), F.sum(F.when(F.col("final"), F.col("amount")).otherwise(0.0)).alias("definitive"))
    return sums.withColumn("percent", F.round(F.coalesce(F.try_divide("definitive", "total") * 100, F.lit(0.0)), 4))
