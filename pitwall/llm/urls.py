"""Operator 8: URL filter with redirect equivalence, in DataFrame and SQL functions only.

A url's own rule (the longest that fits its host and path) decides it.  The rest is
decided by equivalence: redirect and canonical-link edges join a url to its targets,
distributed connected components make the alias classes, and a class hands its decision
to the members without a rule of their own: allow if any member is explicitly allowed,
else block if any member is blocked, else allow.

Edges of a page: the targets of all its ``<link rel="canonical">`` and ``<meta
http-equiv="refresh">`` tags, quoted or not, resolved against the page's own url, and the address that the usual server redirects lead to (no scheme, ``www.`` or
``m.``, no fragment, no tracking parameters, no final ``/`` or ``.html``).

Defined cases: a null url has empty host and path, no rule and no aliases (allow); a url
without ``://`` has empty host and path and is its own address; repeated urls share a verdict.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import union, written
from pitwall.llm.graph import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK, META = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
IS_CANONICAL, IS_REFRESH = r"(?is)\srel\s*=\s*(?:[\"']\s*canonical\b|canonical\b)", r"(?is)\shttp-equiv\s*=\s*[\"']?\s*refresh\b"
#: A value in double quotes, in single quotes, or without quotes.
HREF, CONTENT = (rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))" for name in ("href", "content"))
#: What follows ``url=`` in the content of a refresh.
GOES_TO = r"(?is)(?:^|[;,\s])url\s*=\s*[\"']?([^\"']*)"
TRACKING = r"(?i)([?&])(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


class Rule(NamedTuple):
    """A host (with its subdomains) and a path prefix, and what to do."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule], field: str) -> Column:
    """``field`` of the longest rule that fits, else null.  The rules are a short fixed list."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, field))).otherwise(found)
    return found


def address(url: Column) -> Column:
    """Where the usual redirects of an address end; an address without ``://`` is itself."""
    host = F.regexp_replace(host_of(url), r"^(?:(?:www|m)\.)+", "")
    path = F.regexp_replace(path_of(url), r"(?:\.html)?/*$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, "$1"), r"(?<=[?&])&+|[?&]+$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, query)).otherwise(url)


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def resolved(target: Column, page: Column) -> Column:
    """A link's target as an absolute url: as it stands, or with the page's scheme, host and path
    (without ``.`` and ``..`` steps); null on a page without ``://`` or for an empty target."""
    target = F.trim(F.regexp_replace(target, "&(?:amp|AMP);", "&"))
    scheme = F.regexp_extract(page, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(page, r"(?s)^(.*?://[^/?#]*)", 1)
    path = path_of(page)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    cut = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.substring(target, F.length(cut) + 1, F.lit(2**31 - 1))
    whole = F.when(cut.startswith("/"), cut).otherwise(F.concat(folder, cut))
    steps = F.aggregate(F.split(whole, "/"), F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc).when(
        x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(x))))
    # a last step of dots leaves its folder open
    straight = F.concat(F.array_join(steps, "/"), F.when(whole.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit("")))
    return (F.when(F.coalesce(target, F.lit("")) == "", F.lit(None))
            .when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(site == "", F.lit(None))
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))  # mailto: and the like
            .when(target.startswith("#"), F.regexp_extract(page, r"(?s)^([^#]*)", 1))
            .when(target.startswith("?"), F.concat(site, path, target))
            .otherwise(F.concat(site, straight, rest)))


def _value(tag: Column, pattern: str) -> Column:
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Redirect and canonical edges (src, dst) of the pages, as absolute urls."""
    tags = lambda pattern, kind: F.filter(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), lambda t: t.rlike(kind))
    canonical = F.transform(tags(LINK, IS_CANONICAL), lambda t: _value(t, HREF))
    refresh = F.transform(tags(META, IS_REFRESH), lambda t: F.regexp_extract(_value(t, CONTENT), GOES_TO, 1))
    none = F.array().cast("array<string>")
    targets = F.concat(F.when(F.contains(F.lower(html), F.lit("canonical")), canonical).otherwise(none),
                       F.when(F.contains(F.lower(html), F.lit("refresh")), refresh).otherwise(none))
    found = pages.select(F.col(url).alias("src"), F.explode(targets).alias("target"))
    return found.select("src", resolved(F.col("target"), F.col("src")).alias("dst")).where("dst is not null")


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", html: str | None = "html",
          edges: DataFrame | None = None, id_column: str = "page_id") -> DataFrame:
    """Id, host, path, rule and verdict of every row.  ``edges``: more (src, dst) urls."""
    u = F.col("url")
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url).alias("url"))
    rows = rows.withColumns({"host": host_of(u), "path": path_of(u), "key": _key(u)})
    rows = rows.withColumns({n: rule_of(F.col("host"), F.col("path"), rules, f)
                             for n, f in (("rule", "name"), ("own", "verdict"))})
    rows = written(rows.select("page_id", "url", "host", "path", "rule", "own", "key"), "urls")
    pairs = [rows.select(F.col("key").alias("a"), _key(F.concat(F.lit("at "), address(u))).alias("b"))]
    more = ([links(pages, url, html)] if html else []) + ([edges.select("src", "dst")] if edges is not None else [])
    for found in more:
        found = written(found, "links")
        pairs += [found.select(_key(F.col("src")).alias("a"), _key(F.col("dst")).alias("b")),
                  found.select(_key(F.col("dst")).alias("a"), _key(F.concat(F.lit("at "), address(F.col("dst")))).alias("b"))]
    roots = components(union(pairs).where("a is not null and b is not null"))
    roots = written(roots.select(F.col("v").alias("key"), "root"), "classes")
    explicit = rows.where("own is not null").select("key", "own").distinct()
    classes = explicit.join(roots, "key").groupBy("root").agg(
        F.max((F.col("own") == "allow").cast("int")).alias("allows"))
    handed = roots.join(classes, "root").select("key", F.when(F.col("allows") == 1, "allow").otherwise("block").alias("class"))
    out = rows.join(handed, "key", "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("own", "class", F.lit("allow")).alias("verdict"))
