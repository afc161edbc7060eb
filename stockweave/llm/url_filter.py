"""URL filters which follow redirects and canonical links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.components import connected_components
from stockweave.llm.frames import LOWER, UPPER, read, stage


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.col("host").endswith("." + self.host)
        return host & F.col("path").startswith(self.path)


#: The rules of the registered query (fixed values).
RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)


def _rest(url: Column) -> Column:
    """What follows ``://``, null without it."""
    return F.when(url.contains("://"), url.substr(F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """What tells pages apart: host, path and query; neither the scheme nor the fragment."""
    query = F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^?#]*(\?[^#]*)", 1), F.lit(""))
    return F.concat(host_of(url), path_of(url), query)


def with_parts(urls: DataFrame) -> DataFrame:
    """Adds host (A-Z lower-cased) and path of ``url``, both empty if it is null or has no ``://``."""
    url = F.col("url")
    return urls.withColumns({"host": host_of(url), "path": path_of(url), "address": address_of(url)})


def judged(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Adds rule and own_verdict of the longest rule that fits host and path, null if none does."""
    found = F.when(F.lit(False), F.lit(-1))
    for number, rule in sorted(enumerate(rules), key=lambda x: (-len(x[1].text), x[0])):
        found = found.when(rule.fits(), F.lit(number))
    texts = F.array(*[F.lit(r.text) for r in rules]) if rules else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]) if rules else F.array().cast("array<string>")
    return urls.withColumn("_rule", found).withColumns({
        "rule": F.get(texts, F.col("_rule")), "own_verdict": F.get(verdicts, F.col("_rule")),
    }).drop("_rule")


TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL = r"""(?is)\brel\s*=\s*(?:"[^">]*\bcanonical\b|'[^'>]*\bcanonical\b|canonical\b)"""
REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b"""
HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TARGET = r"""(?is)\bcontent\s*=\s*["'][^"'>]*?\burl\s*=\s*([^"'>]+)"""

#: How the tags of pages are read here; ``TARGET`` is left to the SQL.
CONTENT = r"""(?is)(?<![\w-])content\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""
REDIRECT = r"""(?is)\burl\s*=\s*(?:"([^"]*)|'([^']*)|([^\s"'].*))"""
QUOTES = (("(?i)&quot;|&#0*34;|&#x0*22;", '"'), ("(?i)&apos;|&#0*39;|&#x0*27;", "'"))


def _page_links(pages: DataFrame) -> DataFrame:
    """(url, target) of the canonical links and immediate redirects in the html of ``pages``."""
    tagged = pages.filter("url is not null").filter(F.col("html").rlike("(?i)canonical|http-equiv")).select(
        "url", F.explode(F.regexp_extract_all("html", F.lit(TAGS), 0)).alias("tag")
    )
    href = F.concat(*[F.regexp_extract("tag", HREF, group) for group in (1, 2, 3)])
    content = F.concat(*[F.regexp_extract("tag", CONTENT, group) for group in (1, 2, 3)])
    for written, quote in QUOTES:
        content = F.regexp_replace(content, written, quote)
    redirect = F.concat(*[F.regexp_extract(content, REDIRECT, group) for group in (1, 2, 3)])
    target = F.when(F.col("tag").rlike(CANONICAL), href).when(F.col("tag").rlike(REFRESH), redirect)
    return tagged.select("url", F.replace(F.trim(target), F.lit("&amp;"), F.lit("&")).alias("target")).filter("target <> ''")


def _absolute(links: DataFrame) -> DataFrame:
    """Targets in full: those without a scheme are relative to the url's scheme, host or folder."""
    base = F.regexp_extract("url", "(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract("url", "(?s)^(.*?:)//", 1)
    folder = F.concat(base, F.lit("/"), F.regexp_extract("url", "(?s)^.*?://[^/?#]*/([^?#]*/)?", 1))
    target = F.col("target")
    full = (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(base, target))
        .when(target.startswith("?") | target.startswith("#"), F.concat(F.regexp_extract("url", "(?s)^[^?#]*", 0), target))
        .otherwise(F.concat(folder, target))
    )
    return links.select("url", full.alias("target"))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html).

    The longest rule that fits an url decides. Addresses that redirects (url, target), canonical links
    or refreshes in the html lead to or from are aliases, however long the chain and whether
    or not they were crawled: if a rule blocks one of them, the block holds for all of them but those
    that a rule allows explicitly. What neither a rule nor an alias blocks is allowed.

    A null url, and one without ``://``, has an empty host and path, no rule and no alias; a null
    html has no links. Rows with one page_id or url are judged each for itself. An empty table gives
    an empty one; other columns are not read.
    """
    own = stage(judged(stage(with_parts(pages.select("page_id", "url")), "urls"), rules), "judged")
    links = _page_links(pages.select("url", "html"))
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target").filter("url is not null and target is not null"))
    links = stage(_absolute(links), "page-links")
    ends = links.select("url").unionByName(links.select(F.col("target").alias("url"))).distinct()
    ends = judged(stage(with_parts(ends), "ends"), rules)
    ends = stage(ends.filter("own_verdict = 'block'").select("address").distinct(), "blocked")
    edges = links.select(address_of(F.col("url")).alias("a"), address_of(F.col("target")).alias("b"))
    edges = edges.filter("a <> '' and b <> ''")
    aliases = connected_components(edges).withColumnRenamed("node", "address")
    blocked = aliases.join(ends, "address").select("component").distinct()
    caught = stage(aliases.join(blocked, "component").select("address").withColumn("caught", F.lit(True)), "caught")
    rows = own.join(caught, "address", "left")
    verdict = F.coalesce("own_verdict", F.when(F.col("caught") & (F.col("host") != ""), F.lit("block")), F.lit("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"))
