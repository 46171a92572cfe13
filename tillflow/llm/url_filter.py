"""URL filters that follow redirects: rules by host and path, passed on to aliases.

A page that names another address as its canonical one, or sends its readers
there, is the same thing under two names. These links are edges between
addresses; connected components over them are classes of aliases, and a
decision of the rules about one address holds for its class. Only columns of
addresses are shuffled, never pages.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import LOWER, UPPER, stored
from tillflow.llm.components import components

#: Rules that are given as a list become part of the expression; more are given as a table.
MOST_LISTED = 256

ALLOW, BLOCK = "allow", "block"

# Patterns that both Java's and RE2's syntax have.
HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
)
TAG = r"(?i)<(?:link|meta)\b[^>]*>"
CANONICAL = (
    r"""(?is)^<link\b.*[\s"']rel\s*=\s*"""
    r"""(?:"(?:[^"]*\s)?canonical[\s"]|'(?:[^']*\s)?canonical[\s']|canonical[\s/>])"""
)
REFRESH = r"""(?is)^<meta\b.*[\s"']http-equiv\s*=\s*["']?refresh["'\s/>]"""
HREF = r"""(?is)[\s"']href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
SENT_TO = r"""(?is)[\s"']content\s*=\s*["']?[^"'>=]*?url\s*=\s*["']?([^"'>\s]+)"""


class Rule(NamedTuple):
    """``action`` for the host and its subdomains, where the path starts with ``path``."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _behind(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    return F.when(
        F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))
    )


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?`` or ``#``, A-Z lower-cased; empty without a ``://``."""
    host = F.regexp_extract(_behind(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?`` or ``#``; empty without a ``://``."""
    return F.coalesce(F.regexp_extract(_behind(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The address without scheme and fragment: what a redirect's ends are compared by."""
    rest = F.regexp_extract(_behind(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(_behind(url).isNotNull(), F.concat(host_of(url), rest))


def _listed(rules: Sequence[Rule]) -> Column:
    """The longest rule that fits the columns ``host`` and ``path``, as a struct or null."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.action != ALLOW, r.name))
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for rule in reversed(ranked):
        fits = ((F.col("host") == rule.host) | F.endswith("host", F.lit(f".{rule.host}"))) & (
            F.startswith("path", F.lit(rule.path))
        )
        named = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"))
        found = F.when(fits, named).otherwise(found)
    return found


def _looked_up(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``addresses`` (distinct ``host``, ``path``) with ``found``, for a table of rules.

    The suffixes of a host meet rules of that host; then only prefixes of the
    path that are as long as one of its rules are looked up, so that a host
    with many rules and many pages is not compared pair by pair.
    """
    named = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action"
    ).distinct()
    labels = F.split("host", r"\.")
    most = named.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 0
    hosts = addresses.select("host").distinct().withColumn("labels", labels)
    lengths = F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(most)))
    suffixes = hosts.filter(F.lit(most) > 0).select(
        "host",
        F.explode(
            F.transform(
                lengths,
                lambda n: F.array_join(F.slice("labels", F.size("labels") - n + 1, n), "."),
            )
        ).alias("rule_host"),
    )
    near = suffixes.join(named, "rule_host")
    # As many lengths as rules of different lengths: bounded by the longest path of a rule.
    cuts = near.groupBy("host").agg(F.collect_set(F.length("rule_path")).alias("cuts"))
    probes = addresses.join(cuts, "host").select(
        "host", "path", F.explode(F.filter("cuts", lambda n: n <= F.length("path"))).alias("n")
    )
    probes = probes.withColumn("rule_path", F.expr("substring(path, 1, n)"))
    best = F.max(
        F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("longest"),
            (F.col("action") == ALLOW).alias("allows"),
            F.concat("rule_host", "rule_path").alias("rule"),
            "action",
        )
    ).alias("best")
    hits = probes.join(near, ["host", "rule_path"]).groupBy("host", "path").agg(best)
    found = F.when(F.col("best").isNotNull(), F.struct("best.rule", "best.action"))
    return addresses.join(hits, ["host", "path"], "left").select(
        "host", "path", found.alias("found")
    )


def with_rules(rows: DataFrame, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """``rows`` (with ``host``, ``path``) and ``found``: the longest fitting rule, or null.

    Of rules equally long, one that allows goes first.
    """
    if isinstance(rules, DataFrame):
        known = _looked_up(rows.select("host", "path").distinct(), rules)
        return rows.join(known, ["host", "path"], "left")
    if len(rules) > MOST_LISTED:
        raise ValueError(f"over {MOST_LISTED} rules: give them as a table")
    return rows.withColumn("found", _listed(rules))


def _resolved(target: Column, url: Column) -> Column:
    """The address that ``target`` means on the page ``url``; null for none."""
    scheme = F.regexp_extract(url, r"^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(_behind(url), r"^[^/?#]*", 0))
    path = path_of(url)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"^.*/", 0))
    return (
        F.when(F.rlike(target, F.lit("^[A-Za-z][A-Za-z0-9+.-]*://")), target)
        .when(F.rlike(target, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(None))
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, target))
        .when((target == "") | F.startswith(target, F.lit("#")), F.lit(None))
        .when(F.startswith(target, F.lit("?")), F.concat(site, path, target))
        .otherwise(F.concat(site, folder, target))
    )


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``source`` and ``target``: addresses that a page links as the same thing.

    Read from canonical links and refreshing meta tags; comments, scripts and
    style sheets are skipped. Pages without an address or without such a tag
    give none; relative targets are taken from the page's address, without
    resolving ``..``.
    """
    url, tags = F.col("url"), F.regexp_extract_all("shown", F.lit(TAG), F.lit(0))
    shown = pages.select(
        F.col(url_col).alias("url"), F.regexp_replace(F.col(html_col), HIDDEN, "").alias("shown")
    ).filter(F.instr(url, "://") > 0)
    tagged = shown.select("url", F.explode(tags).alias("tag"))
    href = F.concat(*[F.regexp_extract("tag", HREF, n) for n in (1, 2, 3)])
    target = F.when(F.rlike("tag", F.lit(CANONICAL)), href).when(
        F.rlike("tag", F.lit(REFRESH)), F.regexp_extract("tag", SENT_TO, 1)
    )
    plain = F.trim(F.replace(target, F.lit("&amp;"), F.lit("&")))
    links = tagged.select(url.alias("source"), _resolved(plain, url).alias("target"))
    return links.filter(F.instr("target", "://") > 0)


def _classes(links: DataFrame, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """``node`` and ``passed``: what the rules say of its class, where they say anything."""
    ends = stored(
        links.select(
            node_of(F.col("source")).alias("a"),
            node_of(F.col("target")).alias("b"),
            *[f(F.col(c)).alias(f"{n}_{c}") for c in ("source", "target")
              for n, f in (("host", host_of), ("path", path_of))],
        ),
        "url-links",
    )
    roots = stored(components(ends), "url-classes")
    both = [
        ends.select(
            F.col(node).alias("node"), F.col(f"host_{c}").alias("host"), F.col(f"path_{c}").alias("path")
        )
        for node, c in (("a", "source"), ("b", "target"))
    ]
    named = with_rules(both[0].unionByName(both[1]).distinct(), rules)
    known = named.filter("found is not null").select("node", F.col("found.action").alias("action"))
    # "allow" is the lesser word: one address that is allowed by name speaks for its class.
    passed = known.join(roots, "node").groupBy("root").agg(F.min("action").alias("passed"))
    return roots.join(passed, "root").select("node", "passed")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] | DataFrame,
    links: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """A row per page: id, ``url``, ``host``, ``path``, ``rule``, ``verdict``, ``passed``.

    A page with a rule has that rule's verdict. Another one takes over what
    the rules say of its aliases (``passed``): "allow" if they allow any of
    them, else "block" if they block one; without either it is allowed.
    ``links`` (``source``, ``target``) gives further redirects, for instance
    of a crawl; ``rules`` is a short list or a table ``action``, ``host``,
    ``path``.

    * A null address, or one without ``://``, has empty host and path, fits no
      rule, has no aliases and is allowed. Null html has no links.
    * Null and repeated ids and repeated rows are passed on; each is judged.
    * Very long addresses and pages are read whole; an address with a third of
      all rows is one row until the last join, which adaptive execution splits.
    * Empty tables give no rows. Other columns are not looked at.
    """
    found = None
    if html_col is not None:
        found = alias_links(pages, url_col, html_col)
    if links is not None:
        given = links.select("source", "target").filter(
            (F.instr("source", "://") > 0) & (F.instr("target", "://") > 0)
        )
        found = given if found is None else found.unionByName(given)
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.select(
        "id", "url", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node")
    )
    judged = with_rules(rows, rules)
    if found is None:
        judged = judged.withColumn("passed", F.lit(None).cast("string"))
    else:
        judged = judged.join(_classes(found, rules), "node", "left")
    return judged.select(
        F.col("id").alias(id_col),
        "url",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.action", "passed", F.lit(ALLOW)).alias("verdict"),
        "passed",
    )
