"""URL filters that see through redirects.

Explicit rules (host, path, verdict) fit a host with its subdomains and a path
prefix; the longest fitting rule wins. URLs that redirect to each other or name a
canonical address are aliases: the connected components over these edges pass a
block on to every alias that no rule of its own covers. An explicit allow always
stands, whatever its aliases are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components

ALLOW, BLOCK = "allow", "block"

# The rules of the task: (host, path, verdict).
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Pages name their address in <link rel=canonical href=...> or forward in <meta http-equiv=refresh content="0; url=...">.
LINK, REFRESH = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
BASE = r"""(?is)<base\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
FORWARD = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def with_rule(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``pages`` (with host and path) plus ``rule`` and ``ruled``, the rule's verdict; NULL where none fits.

    Longest means longest host, then longest path.
    """
    fitting = F.array_max(
        F.array(
            *(
                F.when(
                    ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p),
                    F.struct(
                        F.lit(len(h) + len(p)).alias("size"), F.lit(len(h)).alias("of_host"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")
                    ),
                )
                for h, p, v in rules
            )
        )
    )
    return pages.withColumn("_fits", fitting).withColumns({"rule": F.col("_fits.rule"), "ruled": F.col("_fits.verdict")}).drop("_fits")


def address(url: Column) -> Column:
    """A URL without its fragment: what a server is asked for. Scheme and host are lower-cased."""
    asked = F.regexp_replace(url, r"(?s)#.*$", "")
    user = F.regexp_extract(asked, r"(?s)^[^:/?#]*://([^/?#]*@)", 1)
    scheme = F.regexp_extract(asked, r"(?s)^([^:/?#]*://)", 1)
    named = F.regexp_extract(asked, r"(?s)^[^:/?#]*://(?:[^/?#]*@)?([^/?#]*)", 1)
    rest = F.substr(asked, F.length(scheme) + F.length(user) + F.length(named) + 1)
    return F.concat(F.translate(scheme, _UPPER, _LOWER), user, F.translate(named, _UPPER, _LOWER), rest)


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, its segments ``.`` and ``..`` followed."""
    segments = F.split(path, "/")

    def step(done: Column, segment: Column) -> Column:
        above = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(segment == ".", done).when(segment == "..", above).otherwise(F.concat(done, F.array(segment)))

    followed = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.array().cast("array<string>"), step)
    ends_above = F.element_at(segments, -1).isin(".", "..")
    return F.concat(F.lit("/"), F.array_join(F.when(ends_above, F.concat(followed, F.array(F.lit("")))).otherwise(followed), "/"))


def resolved(target: Column, base: Column) -> Column:
    """``target`` as seen from the URL ``base`` (RFC 3986); NULL where it is relative and ``base`` names no host."""
    scheme, named, path = (F.regexp_extract(base, r"(?s)^([^:/?#]*:)//([^/?#]*)([^?#]*)", i) for i in (1, 2, 3))
    root = F.concat(scheme, F.lit("//"), named)
    own = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.substr(target, F.length(own) + 1)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    beside = F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), own)
    return (
        F.when(target.rlike(r"^([A-Za-z][A-Za-z0-9+.\-]*:|://)"), target)
        .when((scheme == "") | base.isNull(), F.lit(None))
        .when((target == "") | target.startswith("#"), base)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("?"), F.concat(root, path, target))
        .when(target.startswith("/"), F.concat(root, _without_dots(own), rest))
        .otherwise(F.concat(root, _without_dots(beside), rest))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): a page's address and the addresses its HTML forwards to or names as canonical.

    ``&amp;`` in targets is decoded; relative ones are resolved against the page's
    <base>, if any, and its URL. Targets without a host (``mailto:``) name no page.
    """
    html = F.col("html").cast("string")
    canonical = F.transform(
        F.filter(
            F.regexp_extract_all(html, F.lit(LINK), F.lit(0)), lambda tag: tag.rlike(r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b""")
        ),
        lambda tag: F.regexp_extract(tag, HREF, 1),
    )
    forward = F.transform(
        F.filter(
            F.regexp_extract_all(html, F.lit(REFRESH), F.lit(0)), lambda tag: tag.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b""")
        ),
        lambda tag: F.regexp_extract(tag, FORWARD, 1),
    )
    written_base = F.replace(F.regexp_extract(html, BASE, 1), F.lit("&amp;"), F.lit("&"))
    return (
        pages.where("url is not null and html is not null")
        .where(html.rlike("(?i)canonical|refresh"))  # a page that has neither word is not searched for tags
        .select(F.col("url").cast("string").alias("url"), written_base.alias("base"), F.explode(F.concat(canonical, forward)).alias("target"))
        .withColumn("base", F.coalesce(resolved(F.col("base"), F.col("url")), F.col("url")))
        .withColumn("target", resolved(F.replace("target", F.lit("&amp;"), F.lit("&")), F.col("base")))
        .select(address(F.col("url")).alias("a"), address(F.col("target")).alias("b"))
        .where(F.col("b").rlike("^[^:/?#]*://") & (F.col("a") != F.col("b")))
    )


def judged(pages: DataFrame, redirects: DataFrame | None = None, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, url, host, path, rule, verdict.

    ``redirects`` (url, target) adds edges known from a crawl to those in the
    HTML; relative targets are resolved there too. A NULL url or one without ``://`` has empty host and path, fits no
    rule, has no alias and is allowed. Aliases that are no page themselves still
    pass a block on, by the rule that fits them. Repeated rows are judged alike.
    """
    edges = alias_edges(pages)
    if redirects is not None:
        target = F.coalesce(resolved(F.col("target"), F.col("url")), F.col("target"))
        edges = edges.unionByName(redirects.select(address(F.col("url")).alias("a"), address(target).alias("b")).where("a <> b"))
    aliases = connected_components(edges)
    named = aliases.select("component", host(F.col("node")).alias("host"), path(F.col("node")).alias("path"))
    blocked = with_rule(named, rules).where(F.col("ruled") == BLOCK).select("component").distinct()
    tainted = aliases.join(blocked, "component", "left_semi").select(F.col("node").alias("_address"), F.lit(True).alias("_tainted"))
    urls = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
    )
    return (
        with_rule(urls, rules)
        .withColumn("_address", address(F.col("url")))
        .join(tainted, "_address", "left")
        .select(
            "page_id",
            "url",
            "host",
            "path",
            "rule",
            F.coalesce("ruled", F.when(F.col("_tainted"), F.lit(BLOCK)), F.lit(ALLOW)).alias("verdict"),
        )
    )
