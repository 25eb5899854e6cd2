"""URL filters with redirect equivalence, in DataFrame operations only.

Rules (host, path, verdict) fit a host and its subdomains and paths that begin with theirs; the longest rule decides. A url that no
rule fits follows its aliases: urls joined by canonical links and redirects form one class, found by distributed connected
components, and the class is allowed if a rule allows any of its urls, else blocked if a rule blocks any, else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeweave.operators.components import connected_components
from noticeweave.operators.durable import durable

# The rules of the URL filter.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]

_UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|noscript|textarea)\b.*?(?:</\1\b|\z)"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["'][^"'>]*?\burl\s*=\s*([^"'\s>]+)"""


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """What follows the first :// up to /, ? or #, A-Z lower-cased; empty for null or without ://."""
    return _lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def node(url: Column) -> Column:
    """A url without scheme, fragment and trailing slashes of its path: what is the same page without looking."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host(url) != "", F.concat(host(url), F.regexp_replace(path(url), "/+$", ""), query))


def resolved(url: Column, link: Column) -> Column:
    """An absolute form of a link found on url; null for an empty link."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    base = F.concat(F.lit("http://"), host(url))
    return (
        F.when(link == "", None)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.lit("http:"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(base, link))
        .otherwise(F.concat(base, F.regexp_replace(path(url), r"[^/]*$", ""), F.when(path(url) == "", F.lit("/")).otherwise(F.lit("")), link))
    )


def aliases(pages: DataFrame) -> DataFrame:
    """Distinct rows (url, other): all canonical links and redirects of pages (url, html), but for those in comments and scripts."""
    some = pages.where("url IS NOT NULL AND html IS NOT NULL").where(F.col("html").rlike("(?i)canonical|refresh")).select("url", F.regexp_replace("html", _UNREAD, " ").alias("html"))
    links = F.concat(F.regexp_extract_all("html", F.lit(_CANONICAL), 1), F.regexp_extract_all("html", F.lit(_REFRESH), 1))
    return some.select("url", F.explode(links).alias("link")).where("link <> ''").select("url", resolved(F.col("url"), F.col("link")).alias("other")).distinct()


def ruled(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) of places with rule (host and path of the longest that fits) and ruling; those that none fits are left out.
    Of equally long rules the allowing one goes first, then the larger text."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    by_suffix = places.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("rule_host"))
    rules = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("ruling"))
    fits = by_suffix.join(rules, "rule_host").where(F.startswith("path", "rule_path"))
    fits = fits.select("host", "path", F.concat("rule_host", "rule_path").alias("rule"), "ruling")
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("ruling") == "allow").alias("allow"), "rule", "ruling")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.ruling")


def judge(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """A row for each of pages (page_id, url, html): page_id, host, path, rule (null if none fits), verdict, by_alias.

    links (url, other) are further redirects, such as a crawl's. Null urls and those without :// have empty host and path and are
    allowed. Rows that repeat a url are judged alike. An empty rule list allows everything. Other columns are ignored, also
    those named like the result's. Long pages are searched whole for links. An empty table gives an empty result.
    """
    spread = aliases(pages).where("other IS NOT NULL")
    if links is not None:
        spread = spread.unionByName(links.select("url", "other")).where("url IS NOT NULL AND other IS NOT NULL").distinct()
    spread = durable(spread, "aliases")
    ends = spread.select("url").union(spread.select("other")).distinct().select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), node(F.col("url")).alias("node"))
    told = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    found = durable(ruled(told.select("host", "path").union(ends.select("host", "path")), rules), "ruled")

    label = connected_components(spread.select(node(F.col("url")).alias("src"), node(F.col("other")).alias("dst")))
    # Every page whose url is in a class speaks for it, not only those with links.
    members = told.select("host", "path", node(F.col("url")).alias("node")).union(ends).where("node IS NOT NULL").distinct().join(label, "node")
    classes = members.join(found, ["host", "path"], "left").groupBy("component").agg(F.bool_or(F.col("ruling") == "allow").alias("allowed"), F.bool_or(F.col("ruling") == "block").alias("blocked"))
    verdicts = label.join(classes, "component").select("node", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").otherwise("allow").alias("alias_verdict")).distinct()
    judged = told.withColumn("node", node(F.col("url"))).join(found, ["host", "path"], "left").join(verdicts, "node", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruling", "alias_verdict", F.lit("allow")).alias("verdict"), (F.col("ruling").isNull() & F.col("alias_verdict").isNotNull()).alias("by_alias"))
