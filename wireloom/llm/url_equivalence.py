"""URL filters over redirect equivalence: aliases of a blocked address are blocked.

An address is judged by rules on host and path first; the longest rule that fits wins.  Addresses without a rule take
part in the decision of their aliases: pages that redirect (``<meta http-equiv=refresh>``), that name a canonical address
(``<link rel=canonical>``), or stand in a table of redirects, form a graph with their targets, and its connected
components are the classes of aliases.  An address without a rule is blocked if a rule blocks an alias, unless a rule
allows an alias: an explicit allow goes before what spreads.  Everything else is allowed.

All of it is built-in functions.  Components are joins and aggregates by address; an address that stands for very many
pages is split like any skewed join.

Nulls: a null url, or one without ``://``, has an empty host and path, no rule and no alias, and is allowed.  Repeated
rows are judged alike.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireloom.llm.components import connected_components
from wireloom.llm.storage import stored

# Fixed values: (verdict, host, path) of the rules that the registered query applies.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

ADDRESS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)"
CANONICAL = r"""(?i)<link\s[^>]*rel\s*=\s*["']?canonical["'\s/>][^>]*"""
HREF = r"""(?i)\shref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?i)<meta\s[^>]*http-equiv\s*=\s*["']?refresh["'\s/>][^>]*"""
TARGET = r"""(?i)url\s*=\s*["']?([^"'\s>]+)"""
FULL = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, ADDRESS, 2)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 3), F.lit(""))


def fits(host_col: Column, path_col: Column, rule_host: str, rule_path: str) -> Column:
    on_host = (host_col == rule_host) | host_col.endswith("." + rule_host)
    return on_host & path_col.startswith(rule_path)


def best_rule(host_col: Column, path_col: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own_host, own_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        told = F.struct(F.lit(own_host + own_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits(host_col, path_col, own_host, own_path), told).otherwise(found)
    return found


def address(url: Column) -> Column:
    """What aliases are told by: the url without its fragment, scheme and host in lower case; null if it has no host."""
    scheme = F.lower(F.regexp_extract(url, ADDRESS, 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host(url) != "", F.concat(scheme, F.lit("://"), host(url), F.when(rest == "", F.lit("/")).otherwise(rest)))


def resolved(target: Column, url: Column) -> Column:
    """A target as written in a page, made absolute."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme, base = F.regexp_extract(url, ADDRESS, 1), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*", 0)
    folder = F.regexp_replace(F.concat(base, F.when(path(url) == "", F.lit("/")).otherwise(path(url))), "[^/]*$", "")
    return (
        F.when(target.rlike(FULL), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(base, target))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:|^#|^$"), F.lit(None))
        .otherwise(F.concat(folder, target))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """(source, target): addresses of pages and of what they redirect to or name as canonical."""
    canonical = F.regexp_extract(F.regexp_extract("html", CANONICAL, 0), HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract("html", REFRESH, 0), TARGET, 1)
    told = pages.select("url", F.explode(F.array(canonical, refresh)).alias("target")).filter("target <> ''")
    return told.select(address(F.col("url")).alias("source"), address(resolved(F.col("target"), F.col("url"))).alias("target"))


def alias_verdicts(edges: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(node, spread): every address with an alias, and what its class decides for members without a rule."""
    members = connected_components(edges, "source", "target")
    own = best_rule(host(F.col("node")), path(F.col("node")), rules)["verdict"]
    judged = members.select("node", "component", own.alias("own"))
    classes = judged.groupBy("component").agg(F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
    spread = F.when(F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False)), F.lit("block")).otherwise("allow")
    classes = classes.select(F.col("component").alias("of"), spread.alias("spread"))
    return stored(judged.join(classes, F.col("component") == F.col("of")).select("node", "spread"), "alias-verdicts")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of pages (page_id, url, html); ``redirects`` has (source, target) urls."""
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(address(F.col("source")).alias("source"), address(F.col("target")).alias("target")))
    spread = alias_verdicts(edges, rules)
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), address(F.col("url")).alias("address"))
    rows = rows.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    rows = rows.join(spread, F.col("address") == F.col("node"), "left")
    verdict = F.coalesce("best.verdict", "spread", F.lit("allow"))
    return rows.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))
