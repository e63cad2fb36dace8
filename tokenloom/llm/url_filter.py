"""URL block and allow rules, carried over to aliases of a page.

A rule (host, path, verdict) fits a url whose host is the rule's or below it and whose path starts with the rule's;
of the rules that fit, the longest wins. Pages that no rule decides take the decision of their aliases: urls joined by
redirects and canonical links form components, found in a distributed way. A component with an explicitly
allowed url is allowed; else one with a blocked url is blocked; else the page is allowed.

Defined cases: a null url or one without "://" has an empty host and path, no rule and no aliases, and is allowed;
repeated pages are judged one by one; equal rules with different verdicts: allow wins; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import Scratch
from tokenloom.llm.components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Links to an alias in a page's head: canonical links and refresh redirects, each in either order of attributes.
LINKS = (
    r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""",
    r"""(?i)<link\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)["']?[^>]*\brel\s*=\s*["']?canonical\b""",
    r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*\burl\s*=\s*["']?([^"'\s>]+)""",
    r"""(?i)<meta\b[^>]*\burl\s*=\s*["']?([^"'\s>]+)["']?[^>]*\bhttp-equiv\s*=\s*["']?refresh\b""",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The lower-cased host (A-Z only) and the path of an absolute url; both empty for anything else."""
    absolute = F.instr(url, "://") > 0
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(absolute, host).otherwise(""), F.when(absolute, path).otherwise("")


def _without_dots(path: Column) -> Column:
    """A path without its segments . and .., of which the second takes back the one before."""
    parts = F.split(path, "/")
    step = lambda kept, p: F.when(p == ".", kept).when(p == "..", F.slice(kept, F.lit(1), F.greatest(F.lit(1), F.size(kept) - 1))).otherwise(F.concat(kept, F.array(p)))
    kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.slice(parts, F.lit(1), F.lit(1)), step)
    # a path that ends in a dotted segment names a folder
    return F.concat(F.array_join(kept, "/"), F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise(""))


def resolved(target: Column, url: Column) -> Column:
    """The absolute url of a link target, as read from the page at ``url``; null if there is none."""
    target = F.replace(F.replace(target, F.lit("&#38;"), F.lit("&")), F.lit("&amp;"), F.lit("&"))
    scheme, site = F.regexp_extract(url, "^([^/?#]*:)//", 1), F.regexp_extract(url, "^[^/?#]*://[^/?#]*", 0)
    page = F.regexp_extract(url, "(?s)^[^?#]*", 0)
    folder = F.regexp_extract(F.substring(page, F.char_length(site) + 1, F.char_length(page)), "(?s)^.*/", 0)
    path, rest = F.regexp_extract(target, "(?s)^[^?#]*", 0), F.regexp_extract(target, "(?s)[?#].*$", 0)
    below = F.concat(F.when(folder == "", "/").otherwise(folder), path)
    return (
        F.when(target.contains("://") & target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when((site == "") | (target == "") | target.rlike("^(#|[A-Za-z][A-Za-z0-9+.-]*:)"), F.lit(None))
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("?"), F.concat(page, target))
        .when(target.startswith("/"), F.concat(site, _without_dots(path), rest))
        .otherwise(F.concat(site, _without_dots(below), rest))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(url, other) for the canonical links and refresh redirects in ``pages`` (url, html), made absolute by the page's url."""
    targets = F.array_distinct(F.flatten(F.array(*(F.regexp_extract_all("html", F.lit(p), 1) for p in LINKS))))
    found = pages.where(F.col("html").rlike(r"(?i)canonical|http-equiv")).select("url", F.explode(targets).alias("target"))
    found = found.where("url is not null").select("url", resolved(F.col("target"), F.col("url")).alias("other"))
    return found.where("other is not null and other <> url")


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` (key, host, path) with the rule and verdict of the longest rule that fits; pages without one are left out.

    Two equal joins: host suffixes with the lengths of the paths that rules on that host have, then (host, prefix).
    """
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))  # allow < block
    lengths = rules.groupBy("host").agg(F.collect_set(F.char_length("path")).alias("lengths"))
    labels = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    fits = (
        pages.where("host <> ''").select("key", "path", suffix.alias("rule_host"))
        .join(lengths.withColumnRenamed("host", "rule_host"), "rule_host")
        .select("key", "rule_host", "path", F.explode("lengths").alias("length"))
        .where("length <= char_length(path)")
        .select("key", "rule_host", F.substring("path", F.lit(1), F.col("length")).alias("rule_path"))
        .join(rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict"), ["rule_host", "rule_path"])
    )
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(F.struct(rule.alias("rule"), "verdict"), F.struct(F.char_length(rule), F.char_length("rule_host"), rule))
    return fits.groupBy("key").agg(best.alias("best")).select("key", "best.rule", "best.verdict")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], scratch: Scratch, edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and decided_by ('rule', 'alias', 'default') for ``pages`` (page_id, url, html).

    ``edges`` (url, other) default to the links in the pages themselves.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    table = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    edges = alias_edges(pages) if edges is None else edges
    # urls that only appear as link targets are judged as well: they may be what a rule names
    ends = edges.select(F.xxhash64("url").alias("a"), F.xxhash64("other").alias("b"), "url", "other")
    ends = scratch.keep(ends, "edges")
    components = scratch.keep(connected_components(ends.select("a", "b"), scratch), "components")

    places = judged.where("host <> ''").select("host", "path").distinct()
    linked = ends.select(F.col("url").alias("u")).union(ends.select("other"))
    linked_host, linked_path = host_and_path(F.col("u"))
    linked = linked.distinct().select(F.xxhash64("u").alias("node"), linked_host.alias("host"), linked_path.alias("path"))
    places = places.union(linked.select("host", "path")).distinct().withColumn("key", F.struct("host", "path"))
    matched = match_rules(places, table).select("key.host", "key.path", "rule", "verdict")
    matched = scratch.keep(matched, "matched")

    decided = (
        linked.join(components, "node").join(matched, ["host", "path"])
        .groupBy("component").agg(F.min("verdict").alias("alias_verdict"))  # allow wins
    )
    inherited = components.join(decided, "component").select("node", "alias_verdict")
    verdict = F.coalesce("verdict", "alias_verdict", F.lit("allow"))
    by = F.when(F.col("verdict").isNotNull(), "rule").when(F.col("alias_verdict").isNotNull(), "alias").otherwise("default")
    return (
        judged.join(matched, ["host", "path"], "left")
        .withColumn("node", F.xxhash64("url"))
        .join(inherited, "node", "left")
        .select("page_id", "host", "path", "rule", verdict.alias("verdict"), by.alias("decided_by"))
    )
