"""URL filters whose decisions reach every alias of a page, by components of redirect and canonical-link edges."""

from pyspark.sql import functions as F

from .common import saved
from .components import components

ABC, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
TO = r"""(?is)\burl\s*=\s*['"]?([^"'\s>]+)"""


def parts(url):
    """(host, path) of a URL column: both empty without ``://``."""
    rest = _rest(url)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), ABC, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url):
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rules_frame(spark, rules):
    """(rule, rule_host, rule_path, verdict) of (verdict, "host/path") pairs."""
    rows = [(rule, rule.split("/", 1)[0].lower(), "/" + rule.split("/", 1)[1] if "/" in rule else "", verdict) for verdict, rule in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, verdict string")


def judge(urls, rules):
    """(url, rule, verdict) of distinct urls that a rule fits: the longest, of equally long ones an allow."""
    host, path = parts(F.col("url"))
    rows = urls.select("url", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    # The host and all its parents.
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = rows.where("host <> ''").select("url", "path", F.explode(suffixes).alias("rule_host")).join(rules, "rule_host")
    fits = fits.where(F.startswith("path", "rule_path"))
    best = F.max(F.struct(F.length("rule").alias("length"), (F.col("verdict") == "allow").alias("allow"), "rule", "verdict")).alias("best")
    return fits.groupBy("url").agg(best).select("url", "best.rule", "best.verdict")


def resolve(link, url):
    """A link of a page as an absolute URL: absolute, from ``//``, from the host, or from the page's folder."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*/(?:[^?#]*/)?)", 1)
    return F.when(F.contains(link, F.lit("://")), link).when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link)).when(
        F.startswith(link, F.lit("/")), F.concat(site, link),
    ).otherwise(F.concat(F.when(folder != "", folder).otherwise(F.concat(site, F.lit("/"))), link))


def page_edges(pages):
    """(source, target) urls of canonical links and refreshes in (url, html)."""
    canonical = F.regexp_extract(F.regexp_extract("html", CANONICAL, 0), HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract("html", REFRESH, 0), TO, 1)
    links = pages.where("url is not null").select("url", F.explode(F.array(canonical, refresh)).alias("link")).where("link <> ''")
    links = links.select(F.col("url").alias("source"), F.replace("link", F.lit("&amp;"), F.lit("&")).alias("link"))
    return links.select("source", resolve(F.col("link"), F.col("source")).alias("target"))


def same_page(url):
    """What a URL names, however it is written: A-Z of the host in lower case, no fragment, http and https alike."""
    host, _ = parts(url)
    tail = F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(host, F.when(tail == "", "/").otherwise(tail)))


def filter_urls(pages, rules, redirects=None, id_col="page_id", url_col="url", html_col="html"):
    """page_id, host, path, rule, verdict of every page.

    rules: (verdict, "host/path") pairs. A rule fits its host and all subdomains if the path starts with the rule's; the
    longest fits best and decides. Pages without a rule take the verdict of their aliases: all URLs that redirects (a table
    of source and target), canonical links and refreshes connect. An allow among the aliases' rules goes before a block;
    without either a page is allowed. URLs are written alike for that (``same_page``): equal ones are aliases of course.

    Components are found by rounds of joins on the linked URLs alone, so a hub with a third of all links is aggregated before
    it moves. A null url, or one without ``://``, has empty host and path, no rule, and is allowed. A null page text has no
    links. Repeated rows stay; other columns are not looked at; an empty table gives no row.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    known = rules_frame(spark, rules)
    edges = page_edges(rows.select("url", "html"))
    if redirects is not None:
        edges = edges.union(redirects.select(F.col("source").cast("string"), F.col("target").cast("string")))
    edges = edges.select(same_page(F.col("source")).alias("source"), same_page(F.col("target")).alias("target"))
    edges = saved(edges.where("source is not null and target is not null").distinct(), "links")
    ends = F.xxhash64("source").alias("a"), F.xxhash64("target").alias("b")
    parts_of = components(edges.select(*ends)).withColumnRenamed("node", "id")
    names = edges.select(F.explode(F.array("source", "target")).alias("name")).distinct().withColumn("id", F.xxhash64("name"))
    members = names.join(parts_of, "id").select("name", "component")
    decided = judge(members.select(F.concat(F.lit("http://"), "name").alias("url")), known)
    # "allow" sorts before "block": the least verdict of a component is its decision.
    found = members.join(decided, F.concat(F.lit("http://"), "name") == decided["url"]).groupBy("component").agg(F.min("verdict").alias("passed_on"))
    passed = members.join(found, "component").select("name", "passed_on")

    host, path = parts(F.col("url"))
    urls = rows.select("page_id", "url", host.alias("host"), path.alias("path"), same_page(F.col("url")).alias("name"))
    own = judge(rows.select("url").where("url is not null").distinct(), known)
    out = urls.join(own, "url", "left").join(passed, "name", "left")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "passed_on", F.lit("allow")).alias("verdict"),
    )
