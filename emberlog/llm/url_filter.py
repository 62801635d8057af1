"""URL filters: rules on host and path, carried to aliases over redirect and canonical-link edges."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import checkpoint
from emberlog.llm.components import connected_components

#: (host, path, verdict): a rule fits its host and all subdomains, if the path starts with its path.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "block"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: What a page says of its own address: canonical links and refreshes.
LINK, REFRESH = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
CANONICAL, IS_REFRESH = r"(?is)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b", r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"
HREF, TO = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, with A to Z in lower case; empty for null and without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does; of rules of equal length an allow first."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "allow", r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def address(url: Column) -> Column:
    """What two URLs of one page share: host, path and query, without scheme and fragment; null without a host."""
    rest = F.regexp_replace(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1), "^(?!/)", "/")
    return F.when(host_of(url) != "", F.concat(host_of(url), rest))


def resolved(target: Column, url: Column) -> Column:
    """Absolute URL of a target that a page at url names."""
    base = F.concat(F.lit("x://"), host_of(url))
    return (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(base, target))
        .otherwise(F.concat(base, F.regexp_replace(F.concat(F.lit("/"), F.regexp_replace(path_of(url), "^/", "")), "[^/]*$", ""), target))
    )


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b) addresses: from each page to its canonical link's and its refresh's target."""
    html, url = F.col("html"), F.col("url")
    rows = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).where(html.rlike("(?i)canonical|refresh"))
    found = F.concat(
        F.transform(F.filter(F.regexp_extract_all(html, F.lit(LINK), F.lit(0)), lambda t: t.rlike(CANONICAL)), lambda t: F.regexp_extract(t, HREF, 1)),
        F.transform(F.filter(F.regexp_extract_all(html, F.lit(REFRESH), F.lit(0)), lambda t: t.rlike(IS_REFRESH)), lambda t: F.regexp_extract(t, TO, 1)),
    )
    targets = rows.select("url", F.explode(found).alias("t")).where("t != ''").select("url", F.replace("t", F.lit("&amp;"), F.lit("&")).alias("t"))
    # Few rows, and long expressions that would otherwise be repeated in each other and in what follows.
    absolute = checkpoint(checkpoint(targets).select(address(url).alias("a"), resolved(F.col("t"), url).alias("u")))
    return checkpoint(absolute.select("a", address(F.col("u")).alias("b"))).where("a IS NOT NULL AND b IS NOT NULL AND a != b")


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Verdict of every page's URL, a row per input row: page_id, host, path, rule, verdict, component.

    The longest rule that fits a URL decides. A URL without one takes its aliases' part: URLs tied by redirects (a table
    with columns source and target, if given) and canonical links or refreshes form components, in which an explicit
    allow of any member goes before a block of any; else it's allowed. component is the least address of the component,
    null for a page without edges. A null URL, or one without ://, has an empty host and path and no rule, and is allowed.
    Repeated rows give a row each; an empty table gives none; other columns are left out. Only addresses are shuffled,
    never html; components are found by distributed steps and nothing of them reaches the driver.
    """
    edges = page_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(checkpoint(redirects.select(address(F.col("source")).alias("a"), address(F.col("target")).alias("b"))))
    nodes = connected_components(edges)
    url = F.concat(F.lit("x://"), F.col("node"))
    seen = nodes.withColumn("v", rule_of(host_of(url), path_of(url), rules)[1])
    shared = seen.groupBy("component").agg(F.max(F.col("v") == "allow").alias("allow"), F.max(F.col("v") == "block").alias("block"))
    carried = checkpoint(nodes.join(shared, "component").select("node", "component", F.when(F.col("allow"), "allow").when(F.col("block"), "block").otherwise("allow").alias("carried")))
    u = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).select("page_id", host_of(u).alias("host"), path_of(u).alias("path"), address(u).alias("node"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = rows.select("page_id", "host", "path", "node", rule.alias("rule"), verdict.alias("own"))
    return judged.join(carried, "node", "left").select("page_id", "host", "path", "rule", F.coalesce("own", "carried", F.lit("allow")).alias("verdict"), "component")


#: The same in DuckDB's SQL, for RULES and the pages' own edges.
SQL = r"""
WITH RECURSIVE rules(h, p, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'block'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
parts AS (
    SELECT page_id, url, html,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1), '') AS rest
    FROM pages),
addressed AS (SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN starts_with(rest, '/') THEN '' ELSE '/' END || rest END AS node FROM parts),
targets AS (
    SELECT host, path, node, replace(t, '&amp;', '&') AS t FROM (
        SELECT host, path, node, unnest(list_concat(
            [regexp_extract(x, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) FOR x IN regexp_extract_all(html, '(?is)<link\b[^>]*>') IF regexp_matches(x, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')],
            [regexp_extract(x, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) FOR x IN regexp_extract_all(html, '(?is)<meta\b[^>]*>') IF regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')])) AS t
        FROM addressed WHERE regexp_matches(html, '(?i)canonical|refresh'))
    WHERE t <> ''),
absolute AS (
    SELECT node AS a, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'x:' || t WHEN starts_with(t, '/') THEN 'x://' || host || t
                           ELSE 'x://' || host || regexp_replace('/' || regexp_replace(path, '^/', ''), '[^/]*$', '') || t END AS u
    FROM targets),
ends AS (
    SELECT a, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h, regexp_extract(u, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS r
    FROM absolute WHERE a IS NOT NULL),
edges AS (SELECT a, h || CASE WHEN starts_with(r, '/') THEN '' ELSE '/' END || r AS b FROM ends WHERE h <> ''),
both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
nodes AS (SELECT a AS node, least(a, min(b)) AS component FROM reach GROUP BY a),
node_parts AS (SELECT node, component, regexp_extract(node, '(?s)^([^/?#]*)([^?#]*)', 1) AS host, regexp_extract(node, '(?s)^([^/?#]*)([^?#]*)', 2) AS path FROM nodes),
node_rules AS (
    SELECT n.component, n.node, arg_max(v, length(h || p)) AS v FROM node_parts n LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL),
shared AS (SELECT component, bool_or(v = 'allow') AS allow, bool_or(v = 'block') AS block FROM node_rules GROUP BY component),
own AS (
    SELECT row_number() OVER () AS i, page_id, host, path, node FROM addressed),
fits AS (SELECT i, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM own JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY i)
SELECT page_id, host, path, fits.rule, coalesce(fits.v, CASE WHEN allow THEN 'allow' WHEN block THEN 'block' ELSE 'allow' END) AS verdict, nodes.component
FROM own LEFT JOIN fits USING (i) LEFT JOIN nodes USING (node) LEFT JOIN shared USING (component)
"""
