"""URL verdicts by rules, and for the rest by trust over the graph of links between hosts.

Hosts of whose pages most are allowed by a rule are trusted seeds; those of whose pages
most are blocked are blocked seeds. Personalised PageRank from the trusted seeds follows
links; distrust from the blocked seeds goes against them, to hosts that link there. A
host with more distrust than trust is blocked. The mass of a host without links ends there. Edges are the links in pages' html with a
host of their own, weighted by number, links within a host aside. All in DataFrame
functions; a round is a join and an aggregate over edges, written to the shared folder.
Rounds go on until every host that links lead to has a mass and none still changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import remove, written

DAMPING = 0.85
#: Largest change of a mass in a round, as a share of that mass, at which it is settled.
CONVERGED = 1e-6

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UP, _LOW), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(size, rule, verdict) of the longest rule (verdict, host, path) that fits; null if none does.

    A rule fits its host and all subdomains where the path starts with the rule's. For
    lists of up to some hundred rules, which stand in the plan.
    """
    one = []
    for verdict, rule_host, rule_path in rules:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        one.append(F.when(fits, F.struct(F.lit(len(rule_host + rule_path)).alias("size"), F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))))
    if not one:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return one[0] if len(one) == 1 else F.greatest(*one)


def edges(pages: DataFrame) -> DataFrame:
    """(u, v, n): links from host u to another host v."""
    linked = pages.where(F.col("html").contains("//")).select(host_of(F.col("url")).alias("u"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("v"))
    return linked.select("u", F.translate("v", _UP, _LOW).alias("v")).where("u <> '' and u <> v").groupBy("u", "v").agg(F.count("*").alias("n"))


def spread(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Personalised PageRank: (host, mass) along (u, v, n) from (host, seed), whose sum is 1.

    What a host without links holds is lost rather than dealt to the seeds again, so a
    mass is comparable between the two directions. There are as many rounds as the
    farthest host is links away, and in cycles up to about 90 (DAMPING ** 85 is 1e-6).
    """
    spark = links.sparkSession
    out = links.groupBy("u").agg(F.sum("n").alias("total"))
    share = written(links.join(out, "u").select("u", "v", (F.col("n") / F.col("total")).alias("p")), "links")
    now = written(seeds.select("host", ((1 - DAMPING) * F.col("seed")).alias("mass")), "mass")
    base = now
    while True:
        moved = share.join(now.withColumnRenamed("host", "u"), "u").groupBy(F.col("v").alias("host")).agg((DAMPING * F.sum(F.col("p") * F.col("mass"))).alias("mass"))
        after = written(moved.unionByName(base).groupBy("host").agg(F.sum("mass").alias("mass")), "mass")
        # relative to each host's own mass, so it is the same for one seed and for millions; a host just reached counts as 1
        old = now.withColumnRenamed("mass", "old")
        change = after.where("mass > 0").join(old, "host", "left").agg(F.max(F.abs(F.col("mass") - F.coalesce("old", F.lit(0.0))) / F.col("mass"))).first()[0]
        if now is not base:
            remove(spark, now)
        now = after
        if change is None or change < CONVERGED:
            break
    return now


def judge(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict (allow or block).

    A null url, or one without ``://``, has an empty host and path, fits no rule and is
    allowed. A host without trust and distrust is allowed. Rows that repeat a page_id
    count and are judged each. Only page_id, url and html are read; a null html has no links.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    per_host = rows.where("host <> ''").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("hit.verdict") == "allow").alias("a"), F.count_if(F.col("hit.verdict") == "block").alias("b"))
    hosts = written(per_host, "hosts")
    links = written(edges(pages), "edges")
    mass = {}
    for name, count, way in (("trust", "a", links), ("distrust", "b", links.select(F.col("v").alias("u"), F.col("u").alias("v"), "n"))):
        own = hosts.where(F.col(count) * 2 > F.col("n"))
        n = own.count()
        mass[name] = spread(way, own.select("host", F.lit(1.0 / max(n, 1)).alias("seed"))).withColumnRenamed("mass", name)
    bad = mass["distrust"].join(mass["trust"], "host", "left").where(F.col("distrust") > F.coalesce("trust", F.lit(0.0))).select("host", F.lit("block").alias("by_host"))
    out = rows.join(bad, "host", "left")  # a host of many pages is split by the engine, as nothing above needs its rows together
    return out.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", "by_host", F.lit("allow")).alias("verdict"))


def oracle_sql(rules: list[tuple[str, str, str]]) -> str:
    """The same over ``pages``: masses as the sum over walks of each length, until what still walks is next to nothing."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({q(v)}, {q(h)}, {q(p)})" for v, h, p in rules)
    low = lambda x: f"translate({x}, '{_UP}', '{_LOW}')"
    parts = [
        f"rules AS (SELECT * FROM (VALUES {values}) AS t(verdict, rhost, rpath))",
        f"urls AS (SELECT row_number() OVER () AS k, page_id, html, coalesce({low("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)",
        "hits AS (SELECT k, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict FROM urls JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY k)",
        "ruled AS (SELECT urls.*, rule, verdict FROM urls LEFT JOIN hits USING (k))",
        "hosts AS (SELECT host, count(*) AS n, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b FROM ruled WHERE host <> '' GROUP BY host)",
        f"links AS (SELECT u, v, count(*) AS n FROM (SELECT host AS u, {low('w')} AS v FROM (SELECT host, unnest(regexp_extract_all(html, {q(LINK)}, 1)) AS w FROM urls)) WHERE u <> '' AND u <> v GROUP BY u, v)",
    ]
    for name, count, u, v in (("trust", "a", "u", "v"), ("distrust", "b", "v", "u")):
        parts.append(f"{name}_p AS (SELECT {u} AS u, {v} AS v, n / sum(n) OVER (PARTITION BY {u}) AS p FROM links)")
        parts.append(f"{name}_0 AS (SELECT host, {1 - DAMPING} / count(*) OVER () AS mass FROM hosts WHERE {count} * 2 > n)")
        # a walk of k links from the seeds; 0.85 ** 170 is 1e-12
        parts.append(f"{name}_walks(k, host, mass) AS (SELECT 0, host, mass FROM {name}_0 UNION ALL SELECT k + 1, v, {DAMPING} * sum(p * mass) FROM {name}_walks JOIN {name}_p ON u = host WHERE k < 170 GROUP BY k, v)")
        parts.append(f"{name} AS (SELECT host, sum(mass) AS mass FROM {name}_walks GROUP BY host)")
    last = "distrust d LEFT JOIN trust t ON d.host = t.host WHERE d.mass > coalesce(t.mass, 0)"
    return "WITH RECURSIVE " + ",\n ".join(parts) + f"\nSELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host IN (SELECT d.host FROM {last}) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled"
