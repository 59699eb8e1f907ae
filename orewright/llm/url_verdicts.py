"""Verdicts on urls: host and path rules, carried to the other names of a page by its redirects and canonical links.

Every url has a plain form (`plain_url`): scheme, default port, leading `www.`, fragment, tracking parameters, index
page and closing slashes dropped, as a server answers all of those with one page. Plain forms are the nodes of a graph;
its edges are what pages declare of themselves (canonical link, `og:url`, refresh) and, where given, the redirects that a
crawler followed. `components` joins what the edges reach, in DataFrame steps over all edges at once.

* The longest rule that fits a url decides it, whatever its component says.
* Any other url takes the decision of its component: allow if a rule allows any url in it, a page's or an edge's
  target; else block if a rule blocks one; else allow.

The work is that of the edges and of the urls with a rule; pages without one meet a table of blocked forms, one row a
form, in one join, so a form with a third of all pages is a hot key on one side only, which adaptive execution splits.

Defined cases: a missing url, or one without `://`, has empty host and path, no form, no rule, and is allowed, and so are
edges from or to it nothing. Repeated rows and rows without an id are judged like any other. Missing html declares
nothing; declarations in comments and scripts do not count, nor do targets that name no page (fragments,
`mailto:`). Dot segments in targets are kept as written. Of two rules of equal length the one with the longer host
goes first, then block. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orewright.llm.base import LOWER, UPPER, components, stored

MOST_RULES = 1000  # rules are a list of the caller's, tested one by one in an expression; more are an error
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
DECLARES = r"(?i)canonical|refresh|og:url"
UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
TAG = r"(?is)<(?:link|meta)\b[^>]*>"
TRACKING = r"^(utm_[^=]*|gclid|fbclid)(=|$)"


def host_of(url: Column) -> Column:
    """What stands between the first `://` and the path, query or fragment, with A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def plain_url(url: Column) -> Column:
    """The form that all names of a page by mere spelling share; null without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?$", "/"), r"/+$", "")
    asked = F.split(F.substring(F.regexp_extract(url, PARTS, 3), 2, 1 << 30), "&")
    kept = F.array_join(F.filter(asked, lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest of the (host, path, verdict) rules that fits, null where none does."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _attribute(tag: Column, name: str) -> Column:
    found = [F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", k) for k in (1, 2, 3)]
    return F.replace(F.concat(*found), F.lit("&amp;"), F.lit("&"))


def _target(tag: Column) -> Column:
    """What a tag declares as the page's address, as written; empty if nothing."""
    canonical = tag.rlike("(?i)^<link") & F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"\s+"), "canonical")
    refresh = tag.rlike("(?i)^<meta") & (F.lower(_attribute(tag, "http-equiv")) == "refresh")
    social = tag.rlike("(?i)^<meta") & (F.lower(_attribute(tag, "property")) == "og:url")
    content = _attribute(tag, "content")
    later = F.regexp_extract(content, r"""(?is)^\s*[0-9.]*\s*[;,]\s*(?:url\s*=\s*)?["']?([^"']*)""", 1)
    return F.trim(F.when(canonical, _attribute(tag, "href")).when(refresh, later).when(social, content).otherwise(""))


def _resolved(target: Column, url: Column) -> Column:
    """A target as a whole url, seen from the page's own; null if it names no page."""
    scheme, host = F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.regexp_extract(url, PARTS, 1)
    root = F.concat(scheme, F.lit("://"), host)
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    return (
        F.when((target == "") | target.startswith("#") | (host == ""), None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(root, path_of(url), target))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), target))
    )


def declared_links(pages: DataFrame) -> DataFrame:
    """(url, target): the addresses that pages declare as their own in canonical links, `og:url` and refreshes."""
    told = pages.select("url", "html").filter(F.col("url").isNotNull() & F.col("html").rlike(DECLARES))
    tags = told.select("url", F.explode(F.regexp_extract_all(F.regexp_replace("html", UNSEEN, ""), F.lit(TAG), 0)).alias("tag"))
    found = tags.select("url", _resolved(_target(F.col("tag")), F.col("url")).alias("target"))
    return found.filter("target is not null").distinct()


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], links: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages; links are further edges (url, target)."""
    edges = declared_links(pages)
    if links is not None:
        edges = edges.unionByName(links.select("url", "target").filter("url is not null and target is not null")).distinct()
    edges = stored(
        edges.select(
            F.md5(plain_url(F.col("url"))).alias("a"), F.md5(plain_url(F.col("target"))).alias("b"), "target"
        ).filter("a is not null and b is not null"),
        "url-edges",
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = pages.select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("verdict"))

    aims = edges.select(F.col("b").alias("id"), host_of(F.col("target")).alias("host"), path_of(F.col("target")).alias("path"))
    said = judged.filter("verdict is not null").select(F.md5(plain_url(F.col("url"))).alias("id"), "verdict").unionByName(
        aims.select("id", verdict.alias("verdict")).filter("verdict is not null")
    )
    says = lambda v: F.max(F.col("verdict") == v)
    decided = said.filter("id is not null").groupBy("id").agg(says("allow").alias("allowed"), says("block").alias("blocked"))

    groups = stored(components(edges.select("a", "b")), "url-groups")
    own = decided.join(groups, "id", "left").select(
        F.coalesce("component", "id").alias("component"), "allowed", "blocked"
    )
    blocked = own.groupBy("component").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    blocked = stored(blocked.filter("blocked and not allowed").select("component"), "url-blocked")
    # A form without links is its own component; one with links is named by its component's rows.
    ids = (
        groups.join(blocked, "component", "left_semi").select("id")
        .unionAll(blocked.join(groups, blocked["component"] == groups["id"], "left_anti").select(F.col("component").alias("id")))
    )

    known = judged.filter("verdict is not null").select("page_id", "host", "path", "rule", "verdict")
    open_ = judged.filter("verdict is null").withColumn("id", F.md5(plain_url(F.col("url"))))
    passed = open_.join(ids.withColumn("hit", F.lit(True)), "id", "left").select(
        "page_id", "host", "path", "rule", F.when(F.col("hit"), "block").otherwise("allow").alias("verdict")
    )
    return known.unionByName(passed)
