"""Url rules, carried over to aliases by redirects and canonical links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.llm.components import components
from finecast.llm.shared import ascii_lower, present


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, for paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)

_LINK = r"""(?i)<(?:link|meta)\b[^>]*>"""
_ATTR = r"""(?i)\b{}\s*=\s*["']?{}"""


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(present(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(present(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def _pick(rules: tuple[Rule, ...], host: Column, path: Column, what: str) -> Column:
    """Of the rules that fit, the longest (then the first by name)."""
    order = sorted(rules, key=lambda r: (-len(r.name), r.name))
    return F.coalesce(*[F.when(_fits(r, host, path), F.lit(getattr(r, what))) for r in order], F.lit(None).cast("string"))


def settled_url(url: Column) -> Column:
    """The address that a site's usual redirects lead to.

    Scheme https, host in lower case without a leading ``www.`` or ``m.``, no
    fragment, no ``utm_`` or ``ref`` parameters, no ``.html`` or slash at the end.
    """
    query = F.regexp_replace(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), r"(?:^|&)(?:utm_[^=&]*|ref)(?:=[^&]*)?(?=&|$)", "")
    query = F.regexp_replace(query, "^&", "")
    return F.concat(
        F.lit("https://"), F.regexp_replace(host_of(url), r"^(?:www|m)\.", ""), F.regexp_replace(path_of(url), r"(?:\.html|/)$", ""),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
    )


def resolved_url(base: Column, to: Column) -> Column:
    """The address that ``to`` means on the page ``base``; null for other schemes, fragments and empty links."""
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"(?s)^(.*?://[^?#]*)", 1)
    folder = F.concat(site, F.coalesce(F.nullif(F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1), F.lit("")), F.lit("/")))
    full = (
        F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), to))
        .when(to.startswith("/"), F.concat(site, to))
        .when(to.startswith("?"), F.concat(page, to))
        .when((to != "") & ~to.startswith("#") & ~to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(folder, to))
    )
    # Steps "." and ".." of the path; the first part is the empty one before the leading slash.
    parts = F.split(path_of(full), "/", -1)
    steps = F.aggregate(
        parts, F.slice(parts, 1, 0),
        lambda a, x: F.when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.least(F.size(a), F.lit(1))))).when(x == ".", a).otherwise(F.concat(a, F.array(x))),
    )
    ends = F.when(path_of(full).rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    path = F.concat(F.array_join(steps, "/"), ends)
    plain = F.concat(F.regexp_extract(full, r"(?s)^(.*?://[^/?#]*)", 1), path, F.regexp_extract(full, r"(?s)^[^?#]*(.*)$", 1))
    return F.when(path_of(full).rlike(r"/\.\.?(?:/|$)"), plain).otherwise(full)


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): url and where it leads, from ``rel=canonical``, ``http-equiv=refresh`` and ``settled_url`` (of link targets, too)."""
    base = pages.where(F.col(url).contains("://")).select(F.col(url).alias("a"), present(F.col(html)).alias("h"))
    tags = F.when(F.lower("h").rlike(r"canonical|http-equiv"), F.regexp_extract_all("h", F.lit(_LINK), F.lit(0)))
    tag = base.select("a", F.explode(tags).alias("t"))
    canonical = F.when(F.col("t").rlike(_ATTR.format("rel", "canonical")), F.regexp_extract("t", r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", 1))
    refresh = F.when(F.col("t").rlike(_ATTR.format("http-equiv", "refresh")), F.regexp_extract("t", r"""(?i)\burl\s*=\s*["']?([^"'\s>;]+)""", 1))
    to = F.replace(F.coalesce(canonical, refresh), F.lit("&amp;"), F.lit("&"))
    stated = tag.select("a", to.alias("to")).where("to IS NOT NULL").select("a", resolved_url(F.col("a"), F.col("to")).alias("b")).where("b IS NOT NULL")
    ends = stated.select(F.col("b").alias("a"), settled_url(F.col("b")).alias("b"))
    return stated.union(ends).union(base.select("a", settled_url(F.col("a")).alias("b")))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", html: str = "html", links: DataFrame | None = None) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (replacing columns of these names).

    A url under a rule follows it.  Others follow their aliases, the connected
    component over ``links`` (by default ``alias_links``): allowed if any alias
    is under an allow rule, else blocked if any is under a block rule, else
    allowed.  ``rules`` is a policy list of at most a few hundred entries.
    Verdicts travel as one row per address; a hub's links are only ever joined
    or reduced, never gathered.  Null urls and urls without ``://`` have empty
    host and path, no rule, no alias, and are allowed.  Repeated rows are judged
    alike; an empty table gives no rows.
    """
    if len(rules) > 500:
        raise ValueError("more than 500 rules do not fit into one expression")
    links = alias_links(pages, url, html) if links is None else links.toDF("a", "b")
    comps = components(links, "a", "b")
    known = comps.select("component", _pick(rules, host_of(F.col("node")), path_of(F.col("node")), "verdict").alias("own"))
    groups = known.groupBy("component").agg(F.max(F.col("own") == "allow").alias("allow"), F.max(F.col("own") == "block").alias("block"))
    blocked = groups.where("block AND NOT coalesce(allow, false)").select("component")
    aliases = comps.join(blocked, "component", "left_semi").select(F.col("node").alias("_unode"))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"host": host, "path": path, "rule": _pick(rules, host, path, "name"), "_uown": _pick(rules, host, path, "verdict")}
    )
    return (
        rows.join(aliases, F.col(url) == F.col("_unode"), "left")
        .withColumn("verdict", F.coalesce("_uown", F.when(F.col("_unode").isNotNull(), "block"), F.lit("allow")))
        .drop("_uown", "_unode")
    )
