"""Block and allow rules for URLs, carried over redirect and canonical links.

A rule fits its host and all subdomains if the path starts with the rule's path; of several that fit, the one with
the longest spelling decides. A page that no rule fits takes the decision of the pages it is the same as: pages
linked by a redirect or a canonical link, or reached by the same address without fragment and tracking
parameters, form a component. A component with an allowed page is allowed, or else one with a blocked page is
blocked, or else the page is allowed: an explicit allow goes before every block that links carry.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.once import compute_once
from ..functions.text import html_unescape, strip
from ..session import cut_lineage
from .common import keeps_columns, text_of, without
from .components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
REFRESH = r"""(?i)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>;]*;\s*url\s*=\s*["']?([^"'>\s]+)"""
CANONICAL = r"""(?i)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'>\s]+)"""
TRACKING = r"(?<=[?&])(?:utm_[a-z]+|gclid|fbclid|ref)=[^&#]*(?:&|(?=#)|$)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def spelled(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Number of the longest rule that fits, or null; at equal length the later one."""
    found = F.lit(None).cast("int")
    for i in sorted(range(len(rules)), key=lambda i: len(rules[i].spelled)):
        r = rules[i]
        found = F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), i).otherwise(found)
    return found


def _without_dots(path: Column) -> Column:
    """A rooted path without its ``.`` and ``..`` segments."""
    parts = F.split(F.substring(path, 2, 1 << 30), "/", -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, s: F.when(s == ".", a).when(
        s == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(s))))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(path.rlike("/[.][.]?$") & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def address(url: Column) -> Column:
    """The address of a resource: host in lower case, no dot segments, no fragment, no tracking parameters, no empty query."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), TRACKING, "")
    bare = F.regexp_replace(bare, "[?&]$", "")
    scheme = F.lower(F.regexp_extract(bare, "(?s)^(.*?)://", 1))
    rest = F.regexp_extract(bare, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    path = F.regexp_extract(rest, r"(?s)^[^?]*", 0)
    rest = F.when(path.rlike("/[.][.]?(/|$)"), F.concat(_without_dots(path), F.substr(rest, F.length(path) + 1))).otherwise(rest)
    return F.when(F.instr(bare, "://") > 0, F.concat(scheme, F.lit("://"), url_host(bare), rest)).otherwise(bare)


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src`` and ``dst`` addresses of redirects and canonical links.

    Entities of a target are decoded, and a relative one is resolved against the page's url; a base element is not
    read. Targets of a scheme without ``/`` (mailto) are no addresses, relative ones of a page without host neither.
    """
    links = F.concat(F.regexp_extract_all(text_of(html), F.lit(REFRESH), F.lit(1)), F.regexp_extract_all(text_of(html), F.lit(CANONICAL), F.lit(1)))
    each = pages.filter(F.col(html).rlike("(?i)http-equiv|canonical")).select(F.col(url).alias("_url"), F.explode(links).alias("_to"))
    each = compute_once(each, _to=strip(html_unescape("_to")))
    root = F.regexp_extract("_url", r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract("_url", r"(?s)^(.*?:)//", 1)
    path = url_path(F.col("_url"))
    folder = F.coalesce(F.nullif(F.regexp_extract(path, "(?s)^.*/", 0), F.lit("")), F.lit("/"))
    to = F.col("_to")
    full = (F.when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:/"), to))
            .when(to.startswith("//"), F.concat(scheme, to)).when(to.startswith("/"), F.concat(root, to))
            .when((root != "") & to.startswith("?"), F.concat(root, path, to))
            .when((root != "") & (to != "") & ~to.startswith("#"), F.concat(root, folder, to)))
    return each.select(address(F.col("_url")).alias("src"), address(full).alias("dst")).filter("src <> dst")


@keeps_columns("url", "html")
def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", html: str = "html") -> DataFrame:
    """Adds host, path, rule (spelled, or null) and verdict (``allow`` or ``block``).

    A null url, or one without ``://``, has empty host and path, no rule, and links of its own only if it is not
    null. Columns of these names are replaced; repeated rows stay repeated. An empty table gives an empty table.
    """
    judged = without(pages, "host", "path", "rule", "verdict").withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    judged = judged.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("_node", F.md5(address(F.col(url))))
    nth = F.array(*[F.struct(F.lit(r.spelled).alias("rule"), F.lit(r.verdict).alias("verdict")) for r in rules])
    own = F.get(nth, F.col("_rule"))
    judged = judged.withColumns({"rule": own["rule"], "_own": own["verdict"]})
    links = cut_lineage(link_edges(pages, url, html).distinct())
    member = connected_components(links.select(F.md5("src").alias("src"), F.md5("dst").alias("dst")), "src", "dst")
    # Targets that are no page of the table decide for the pages that lead to them.
    ends = links.select("dst").distinct()
    ends = ends.select(F.md5("dst").alias("_node"), F.get(nth, matching_rule(url_host(F.col("dst")), url_path(F.col("dst")), rules))["verdict"].alias("_own"))
    # One row per address before any join: a popular address is no hot key.
    decided = judged.select("_node", "_own").unionByName(ends).filter("_node IS NOT NULL").groupBy("_node").agg(
        F.max(F.col("_own") == "allow").alias("_allow"), F.max(F.col("_own") == "block").alias("_block"), F.max(F.col("_own").isNull()).alias("_open"))
    decided = cut_lineage(decided.join(member, decided["_node"] == member["node"], "left").withColumn("_comp", F.coalesce("component", "_node")))
    linked = decided.groupBy("_comp").agg(F.max("_allow").alias("_a"), F.max("_block").alias("_b"), F.max("_open").alias("_o")).filter("_b AND _o AND NOT coalesce(_a, false)")
    blocked = decided.filter("_open").join(linked.select("_comp"), "_comp", "left_semi").select("_node", F.lit("block").alias("_carried"))
    out = judged.join(blocked, "_node", "left")
    return out.withColumn("verdict", F.coalesce("_own", "_carried", F.lit("allow"))).drop("_node", "_rule", "_own", "_carried")
