"""URL filters with redirect equivalence.

A URL is judged by the longest rule (host, path prefix, allow or block)
that fits it.  A URL without a rule of its own takes the verdict of the
URLs it is equivalent to: addresses that differ only in what servers
redirect (scheme, ``www.``, fragment, trailing slash, ``index.html``,
tracking parameters) are one address, and addresses joined by a redirect
(``<meta http-equiv="refresh">``) or a canonical link (``rel="canonical"``,
``og:url``) of a page are one class, found as connected components.

Precedence: a URL's own rule; else allow, if a member of its class has an
explicit allow rule; else block, if a member has a block rule; else allow.
Members that are only link targets count too.

All steps are DataFrame operations; classes are aggregates with map-side
combine, so an address or class that holds a third of all pages is no hot
spot.  Rules are a table joined on the suffixes of the host.

Cases: a null URL or one without ``://`` has empty host and path, fits no
rule, is equivalent to nothing and is allowed; null html has no links; rows
that repeat a page_id each give a row; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import prepare, stage
from reviewlake.llm.components import components

TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)="       # query parameters that do not change the page


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first ``://``, null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """The address that redirect variants of a URL share; null without one."""
    host = F.regexp_replace(host_of(url), r"\Awww\.(?=.*\.)", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?\z", "/"), r"/+\z", "")
    query = F.split(F.regexp_extract(_rest(url), r"\A[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host_of(url) != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def absolute(href: Column, base: Column) -> Column:
    """``href`` as a link of the page at ``base``."""
    scheme = F.regexp_extract(base, r"\A([^:/?#]*)://", 1)
    host = F.regexp_extract(_rest(base), r"\A[^/?#]*", 0)
    folder = F.regexp_extract(path_of(base), r"\A(.*/)", 1)
    return (F.when(F.instr(href, "://") > 0, href)
             .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
             .when(href.startswith("/"), F.concat(scheme, F.lit("://"), host, href))
             .when(href != "", F.concat(scheme, F.lit("://"), host, F.when(folder == "", "/").otherwise(folder), href)))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target): URLs joined by a page's redirect or canonical link."""
    tags = F.regexp_extract_all(F.col("html"), F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0))
    named = F.filter(tags, lambda t: t.rlike(r"""(?i)\brel\s*=\s*["']?canonical\b|\bproperty\s*=\s*["']?og:url\b|\bhttp-equiv\s*=\s*["']?refresh\b"""))
    tagged = pages.select(F.col(url_col).alias("source"), F.col(html_col).alias("html")) \
                  .where(F.col("source").isNotNull() & F.col("html").rlike(r"(?i)canonical|og:url|refresh")) \
                  .select("source", F.explode(named).alias("tag"))
    value = F.regexp_extract("tag", r"""(?i)\b(?:href|content)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", 0)
    value = F.regexp_replace(F.regexp_replace(value, r"""(?i)\A(?:href|content)\s*=\s*["']?""", ""), r"""["']\z""", "")
    refresh = F.col("tag").rlike(r"(?i)http-equiv")
    target = F.when(refresh, F.regexp_extract(value, r"""(?i)url\s*=\s*["']?([^"']+)""", 1)).otherwise(value)
    href = F.regexp_replace(F.trim(target), "&amp;", "&")
    return tagged.select("source", absolute(href, F.col("source")).alias("target")).where("target is not null")


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a table."""
    return spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, host string, path string")


def fitting_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, host, path, rule, own): the longest rule that fits each distinct
    URL; of rules of one length, the allowing one, then the smaller text."""
    u = urls.select("url").distinct().withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    r = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict")
    hit = u.where("host <> ''").select("url", "path", F.explode(suffixes).alias("r_host")).join(r, "r_host") \
           .where(F.startswith("path", "r_path"))
    text = F.concat("r_host", "r_path")
    best = hit.groupBy("url").agg(F.min(F.struct((-F.length(text)).alias("n"), "verdict", text.alias("rule"))).alias("b"))
    return u.join(best, "url", "left").select("url", "host", "path", F.col("b.rule").alias("rule"), F.col("b.verdict").alias("own"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict), one row per row of ``pages``."""
    prepare(pages.sparkSession)
    edges = stage(link_edges(pages, url_col, html_col).distinct(), "url-links")
    rows = stage(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), "urls")
    every = rows.select("url").union(edges.select("source")).union(edges.select("target")).where("url is not null")
    judged = stage(fitting_rule(every, rules).withColumn("address", address_of(F.col("url"))), "url-rules")
    joined = edges.select(address_of(F.col("source")).alias("a"), address_of(F.col("target")).alias("b"))
    comp = components(joined, "a", "b").withColumnRenamed("node", "address")
    classed = judged.join(comp, "address", "left").withColumn("class", F.coalesce("component", "address"))
    # 'allow' sorts before 'block': the smallest explicit verdict of a class wins
    verdict = classed.where("class is not null").groupBy("class").agg(F.min("own").alias("inherited"))
    final = classed.join(verdict, "class", "left") \
                   .select("url", "host", "path", "rule", F.coalesce("own", "inherited", F.lit("allow")).alias("verdict"))
    out = rows.join(final, "url", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                      "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
