"""URL filters with redirect equivalence (operator 10).

A rule blocks or allows a host with its subdomains below a path. A URL's longest rule decides. Pages that
name another URL as the place to go (a ``refresh`` redirect or a ``canonical`` link) are aliases of it,
and a URL without a rule gets the decision of its aliases: allowed if one of them is explicitly allowed,
else blocked if one is blocked, else allowed. Aliases are the connected components over these edges,
fragments (``#...``) aside; a target takes part whether or not it is a page itself.

A URL that is null or has no ``://`` has an empty host and path, fits no rule and has no aliases. Null html
has no links. Pages are judged row by row, so repeated rows, ties and null ids change nothing; an empty
table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import column, fresh_name, let
from tradewind.llm.components import components
from tradewind.operators.lineage import written


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host, a slash and the start of the path behind it."""
    verdict: str
    pattern: str


# Rules are written by hand and become part of the query; they are no table.
RULES = (
    Rule("block", "net/"), Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"), Rule("allow", "org/fr/"),
)
_LINK = r"(?i)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"""(?i)\brel\s*=\s*(?:"(?:[^"]*\s)?|'(?:[^']*\s)?)?canonical\b"""
_HREF = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""
_TARGET = r"""(?i)\bcontent\s*=\s*(?:"[^"]*?url\s*=\s*'?([^"']*)|'[^']*?url\s*=\s*"?([^"']*)|[^\s"'>]*?url=["']?([^\s"'>]+))"""


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host_: Column, path_: Column, rules: Sequence[Rule]) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits, or null."""
    fitting = []
    for rule in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern, r.verdict)):
        domain, _, below = rule.pattern.partition("/")
        fits = ((host_ == domain) | host_.endswith("." + domain)) & path_.startswith("/" + below)
        fitting.append(F.when(fits, F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.verdict).alias("verdict"))))
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fitting, nothing)


def _group(text: Column, pattern: str, groups: int) -> Column:
    return F.concat(*[F.coalesce(F.regexp_extract(text, pattern, k + 1), F.lit("")) for k in range(groups)])


def targets(html: Column) -> Column:
    """Where canonical links and refresh redirects of a page lead, as written."""
    links = F.transform(F.filter(_tags(html), lambda t: t.rlike(_CANONICAL)), lambda t: _group(t, _HREF, 3))
    refresh = F.transform(F.filter(_tags(html), lambda t: t.rlike(_REFRESH)), lambda t: _group(t, _TARGET, 3))
    return F.concat(links, refresh)


def _tags(html: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(html.cast("string"), F.lit("")), F.lit(_LINK), F.lit(0))


def resolved(target: Column, url: Column) -> Column:
    """``target`` as a whole URL, seen from ``url``; null if it leads nowhere else."""
    target = F.trim(F.replace(target, F.lit("&amp;"), F.lit("&")))
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    site = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    folder = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (
        F.when((target == "") | target.startswith("#"), F.lit(None).cast("string"))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(F.regexp_extract(url, r"^[^?#]*", 0), target))
        .when(folder.endswith("/") & (F.length(folder) > F.length(site)), F.concat(folder, target))
        .otherwise(F.concat(site, F.lit("/"), target)))


def node(url: Column) -> Column:
    """The URL as a node: host in lower case, without fragment; null if it has no host."""
    scheme = F.lower(F.substring_index(url, "://", 1))
    after = F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)
    slash = F.when(after == "", F.lit("/")).otherwise(after)
    return F.when(F.length(host(url)) > 0, F.concat(scheme, F.lit("://"), host(url), slash))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(a, b)``: nodes of pages and of the URLs they name instead."""
    at = column(url).cast("string")
    return (
        pages.select(at.alias("url"), F.explode(targets(column(html))).alias("target"))
        .select(let(F.col("url"), node).alias("a"), let(resolved(F.col("target"), F.col("url")), node).alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a != b"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", html: str = "html",
               more_edges: DataFrame | None = None) -> tuple[DataFrame, str]:
    """Every row of ``pages`` with a struct ``(host, path, rule, verdict)``, and its name. ``more_edges``
    are further redirects ``(a, b)`` as URLs, for example from a crawler's log."""
    name, aliases = fresh_name(pages, "judged"), fresh_name(pages, "aliases")
    at = F.coalesce(column(url).cast("string"), F.lit(""))
    edges = alias_edges(pages, url, html)
    if more_edges is not None:
        edges = edges.union(more_edges.select(node(F.col("a")), node(F.col("b"))).dropna())
    found = written(components(edges), "aliases")
    ruled = found.withColumn("verdict", let(
        F.struct(host(F.col("node")).alias("host"), path(F.col("node")).alias("path")),
        lambda u: longest_rule(u["host"], u["path"], rules))["verdict"])
    verdicts = written(
        ruled.groupBy("component").agg(
            F.bool_or(F.col("verdict") == "allow").alias("allowed"),
            F.bool_or(F.col("verdict") == "block").alias("blocked"))
        .select("component", (F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False))).alias("blocked")),
        "verdicts")
    by_node = written(found.join(verdicts, "component").select("node", "blocked"), "by-node").select(
        F.struct("node", "blocked").alias(aliases))
    of = column(aliases)
    judged = pages.join(by_node, let(at, node) == of["node"], "left")
    own = let(let(at, lambda u: F.struct(host(u).alias("host"), path(u).alias("path"))), lambda u: F.struct(
        u["host"].alias("host"), u["path"].alias("path"), longest_rule(u["host"], u["path"], rules).alias("own")))
    judged = judged.withColumn(name, own)
    mine = column(name)
    verdict = F.coalesce(mine["own"]["verdict"], F.when(of["blocked"], F.lit("block")), F.lit("allow"))
    return judged.withColumn(name, F.struct(
        mine["host"].alias("host"), mine["path"].alias("path"), mine["own"]["rule"].alias("rule"),
        verdict.alias("verdict"))).drop(aliases), name
