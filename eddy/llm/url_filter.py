"""URL filter: rules by host and path, and link-graph propagation for the rest.

A url takes the longest rule that fits it.  Hosts whose urls the rules mostly
allow or mostly block are seeds: trust flows along the links between hosts,
distrust flows against them, each as a personalised PageRank.  A host is
blocked, where no rule decides, if enough distrust reaches it and more of it
than trust.  Only DataFrame functions are used.

Links are folded into weighted host edges before anything else, so a host that
holds a third of all pages is a few rows.  A round moves what arrived in the
last one a step further; it ends when what is still on its way has fallen below
a share of the seeds, which the damping guarantees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.llm.common import bounded, written

# (verdict, host, path): fits the host and its subdomains where the path starts so.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
DAMPING = 0.85
SETTLED = 1e-4            # of the seeds' sum may still be on its way when propagation ends
ENOUGH = 0.05             # distrust that a block needs; a host that is a seed has 1 at least
DIGITS = 9                # decimals that count in a comparison, so that the order of a sum does not

_NOT_CONTENT = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
_LINK = r"""(?i)<a(?:rea)?(?=\s)[^>]*?\shref\s*=\s*["']?\s*((?:https?:)?//[^"'\s<>]+)"""
_AFTER = r"^[^/?#]*([^?#]*)"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty if there is no ``://`` or no url."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), _AFTER, 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does.  Of
    rules of the same length and text the first counts."""
    rule = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)) if rule is None else rule.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    none = F.lit(None).cast("string")
    return (none if rule is None else rule), (none if verdict is None else verdict)


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, url) for every link of a page to an absolute address; comments,
    scripts and styles hold none.  Relative links stay on their host and do not
    count."""
    found = F.regexp_extract_all(F.regexp_replace(F.col(html_col), _NOT_CONTENT, " "), F.lit(_LINK), F.lit(1))
    out = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(found).alias("link"))
    return out.select("src", F.regexp_replace("link", "^//", "http://").alias("url"))


def host_graph(pages: DataFrame, rules=RULES, url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """(edges, seeds): ``edges(src, dst, n)`` counts the links between different
    hosts, ``seeds(kind, host, v)`` holds the hosts of whose urls, as pages or as
    targets of links, the rules allow (trust) or block (distrust) over half."""
    linked = links(pages, url_col, html_col)
    # One scan of the html: links by host pair and verdict of the target.
    verdict = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)[1]
    linked = linked.select("src", host_of(F.col("url")).alias("dst"), verdict.alias("verdict")).where("dst <> ''")
    linked = written(linked.groupBy("src", "dst", "verdict").agg(F.count(F.lit(1)).alias("n")), "url-links")
    edges = linked.where("src <> dst and src <> ''").groupBy("src", "dst").agg(F.sum("n").alias("n"))
    url = F.col(url_col)
    own = pages.select(host_of(url).alias("host"), rule_of(host_of(url), path_of(url), rules)[1].alias("verdict"))
    own = own.where("host <> ''").groupBy("host", "verdict").agg(F.count(F.lit(1)).alias("n"))
    seen = own.unionByName(linked.select(F.col("dst").alias("host"), "verdict", "n")).groupBy("host").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in ("allow", "block")])
    kind = F.when(F.col("allow") * 2 > F.col("n"), "trust").when(F.col("block") * 2 > F.col("n"), "distrust")
    return edges, seen.select(kind.alias("kind"), "host", F.lit(1.0).alias("v")).where("kind is not null")


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """(host, trust, distrust) for every host that either reaches.

    Trust goes from a host to those it links to, distrust from a host to those
    that link to it, divided by the links of each kind.  A sum over paths of any
    length: each round adds one step, and what moves shrinks by ``damping`` at
    least, so the rounds are bounded by log(settled) / log(damping).
    """
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"))
    out = both.groupBy("kind", "host").agg(F.sum("n").alias("all"))
    ways = written(both.join(out, ["kind", "host"]).select(
        "kind", "host", "to", (F.lit(damping) * F.col("n") / F.col("all")).alias("w")), "url-ways")
    moved = [written(seeds, "url-seeds")]
    start = moved[0].agg(F.sum("v")).first()[0] or 0.0
    for _ in range(math.ceil(math.log(settled) / math.log(damping))):
        step = written(moved[-1].join(ways, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(
            F.sum(F.col("v") * F.col("w")).alias("v")), "url-step")
        left = step.agg(F.sum("v")).first()[0] or 0.0
        if left:
            moved.append(step)
        if left <= settled * start:
            break
    total = moved[0]
    for step in moved[1:]:
        total = total.unionByName(step)
    return total.groupBy("host").agg(*[
        F.round(F.sum(F.when(F.col("kind") == k, F.col("v")).otherwise(0.0)), DIGITS).alias(k) for k in ("trust", "distrust")])


def judge(pages: DataFrame, rules=RULES, page_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          enough: float = ENOUGH) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``rule`` is the longest rule that fits, null if none does; then the verdict
    is the host's: ``block`` if its distrust is at least ``enough`` and above its
    trust, else ``allow``.  A null url, or one without ``://``, has an empty host
    and path and is allowed.  Null html holds no links.  Repeated rows stay, and
    their links count each time.  An empty table gives no rows; further columns
    are not looked at.
    """
    hosts = propagate(*host_graph(pages, rules, url_col, html_col))
    bad = written(hosts.where((F.col("distrust") >= enough) & (F.col("distrust") > F.col("trust"))).select(
        F.col("host").alias("bad")), "url-hosts")
    url = F.col(url_col)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(page_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumns({"rule": rule, "verdict": verdict}).join(bounded(bad), F.col("host") == F.col("bad"), "left")
    return rows.select("page_id", "host", "path", "rule", F.coalesce(
        "verdict", F.when(F.col("bad").isNotNull(), "block").otherwise("allow")).alias("verdict"))


# DuckDB statement for the rows of ``judge`` over ``pages`` (same constants).
ORACLE = r"""
WITH RECURSIVE rules(v, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
page AS (
  SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url, html FROM pages),
link AS (
  SELECT r, regexp_replace(unnest(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(
           html, '(?is)<!--.*?-->', ' ', 'g'), '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'),
           '(?i)<a(?:rea)?\s(?:[^>]*?\s)??href\s*=\s*["'']?\s*((?:https?:)?//[^"''\s<>]+)', 1)), '^//', 'http://') AS url
  FROM page),
seen AS (
  SELECT r, true AS own, url FROM page UNION ALL SELECT r, false, url FROM link),
parts AS (
  SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM seen),
split AS (
  SELECT r, own, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
ruled AS (
  SELECT s.*, (SELECT arg_max({'rule': h || p, 'v': v}, strlen(h || p)) FROM rules
               WHERE (s.host = h OR ends_with(s.host, '.' || h)) AND starts_with(s.path, p)) AS hit
  FROM split s),
edge AS (
  SELECT a.host AS src, b.host AS dst, count(*) AS n FROM ruled a JOIN ruled b ON a.r = b.r AND a.own AND NOT b.own
  WHERE a.host <> b.host AND a.host <> '' AND b.host <> '' GROUP BY a.host, b.host),
way AS (
  SELECT 'trust' AS kind, src AS host, dst AS to_host, 0.85::DOUBLE * n / sum(n) OVER (PARTITION BY src) AS w FROM edge
  UNION ALL
  SELECT 'distrust', dst, src, 0.85::DOUBLE * n / sum(n) OVER (PARTITION BY dst) FROM edge),
seed AS (
  SELECT CASE WHEN 2 * count(*) FILTER (hit.v = 'allow') > count(*) THEN 'trust'
              WHEN 2 * count(*) FILTER (hit.v = 'block') > count(*) THEN 'distrust' END AS kind, host
  FROM ruled WHERE host <> '' GROUP BY host),
flow(k, kind, host, v) AS (
  SELECT 0, kind, host, 1.0::DOUBLE FROM seed WHERE kind IS NOT NULL
  UNION ALL
  SELECT f.k + 1, f.kind, to_host, sum(v * w) FROM flow f JOIN way ON f.kind = way.kind AND f.host = way.host
  WHERE (SELECT sum(v) FROM flow) > 1e-4 * (SELECT count(*) FROM seed WHERE kind IS NOT NULL)
  GROUP BY f.k, f.kind, to_host),
score AS (
  SELECT host, round(coalesce(sum(v) FILTER (kind = 'trust'), 0), 9) AS trust,
         round(coalesce(sum(v) FILTER (kind = 'distrust'), 0), 9) AS distrust
  FROM flow GROUP BY host)
SELECT page_id, ruled.host, path, hit.rule AS rule,
       coalesce(hit.v, CASE WHEN distrust >= 0.05 AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN page USING (r) LEFT JOIN score ON ruled.host = score.host WHERE own
"""
