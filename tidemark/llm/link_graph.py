"""URL filter by link-graph propagation, in DataFrame operations throughout.

Rules judge the urls they fit; for the rest the link graph judges the host.
A host is a trusted seed by the share of its pages that rules allow, and a
blocked seed by the share they block. Personalised PageRank carries trust
along the host edges and distrust against them (who links to a blocked host
is suspect):

    trust(v)    = (1 - d) seed(v) + d * sum over u -> v of trust(u) / out(u)
    distrust(u) = (1 - d) seed(u) + d * sum over u -> v of distrust(v) / in(v)

A host is blocked when its distrust, over 1 - d, reaches the threshold and
exceeds its trust. So a host without links is judged by its own pages alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import stage

DAMPING = 0.85
#: Part of the definition of a verdict: trust and distrust flow along paths of up to this many
#: links. Of all flow, paths beyond it would carry at most DAMPING ** (ITERATIONS + 1), 17 %.
ITERATIONS = 10
THRESHOLD = 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

#: An absolute or scheme-relative link in an attribute; the group is its host.
LINK_HOST = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\s"'<>]+)"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def match_rules(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; nulls when none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct links between different hosts: src, dst. Relative links stay on their host."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK_HOST), F.lit(1))
    found = pages.select(url_host(F.col("url")).alias("src"), F.explode(links).alias("dst"))
    return (
        found.select("src", F.translate("dst", _UPPER, _LOWER).alias("dst"))
        .filter("src <> '' and src <> dst")
        .distinct()
    )


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """(host, trust, distrust) of every host of ``seeds`` (host, trusted, blocked) and ``edges``.

    Hosts that only occur in links have no seed. Each round is two joins of
    the edges with the round before and one sum per host, added up before
    the shuffle; the rounds are stored, so none is computed twice.
    """
    base = [F.col("host"), (F.col("trusted") * (1 - damping)).alias("trust"), (F.col("blocked") * (1 - damping)).alias("distrust")]
    start = seeds.select(*base)
    if edges.isEmpty():
        return start
    out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n_out"))
    into = edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n_in"))
    graph = stage(edges.join(stage(out, "out"), "src").join(stage(into, "in"), "dst"), "graph")
    now = start
    for _ in range(iterations):
        trust = graph.join(now.withColumnRenamed("host", "src"), "src").select(
            F.col("dst").alias("host"), (F.col("trust") * damping / F.col("n_out")).alias("trust"), F.lit(0.0).alias("distrust")
        )
        distrust = graph.join(now.withColumnRenamed("host", "dst"), "dst").select(
            F.col("src").alias("host"), F.lit(0.0).alias("trust"), (F.col("distrust") * damping / F.col("n_in")).alias("distrust")
        )
        flows = start.unionByName(trust).unionByName(distrust)
        now = stage(flows.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "scores")
    return now


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, damping: float = DAMPING, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block).

    A rule fits its host and all subdomains when the url's path starts with
    the rule's; the longest rule wins. A null url, or one without ``://``,
    has empty host and path and is allowed, as nothing speaks against it. A
    null html has no links. Repeated rows each get a row and count as pages
    of their host. An empty table gives no rows.
    """
    named = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule, by_rule = match_rules(F.col("host"), F.col("path"), rules)
    judged = named.withColumn("rule", rule).withColumn("by_rule", by_rule)
    seeds = stage(
        judged.filter("host <> ''")
        .groupBy("host")
        .agg(
            F.avg(F.when(F.col("by_rule") == "allow", 1.0).otherwise(0.0)).alias("trusted"),
            F.avg(F.when(F.col("by_rule") == "block", 1.0).otherwise(0.0)).alias("blocked"),
        ),
        "seeds",
    )
    scores = propagate(seeds, stage(host_edges(pages), "host-edges"), damping)
    suspect = (F.col("distrust") >= threshold * (1 - damping)) & (F.col("distrust") > F.col("trust"))
    by_host = stage(scores.select("host", F.when(suspect, "block").otherwise("allow").alias("by_host")), "host-verdicts")
    return judged.join(by_host, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict")
    )


def judge_sql(damping: float = DAMPING, iterations: int = ITERATIONS, threshold: float = THRESHOLD) -> str:
    """The same in DuckDB SQL over ``pages``, the rounds written out."""
    fits = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN "
        for r in sorted(RULES, key=lambda r: -len(r.name))
    ]
    ordered = sorted(RULES, key=lambda r: -len(r.name))
    name = " ".join(f"{w}'{r.name}'" for w, r in zip(fits, ordered, strict=True))
    verdict = " ".join(f"{w}'{r.verdict}'" for w, r in zip(fits, ordered, strict=True))
    link = LINK_HOST.replace("'", "''")
    lower = f"translate({{}}, '{_UPPER}', '{_LOWER}')"
    rest = 1 - damping
    rounds = "".join(
        f""", s{k + 1} AS MATERIALIZED (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
            SELECT * FROM s0
            UNION ALL SELECT dst, trust * {damping!r} / n_out, 0.0 FROM graph JOIN s{k} ON src = host
            UNION ALL SELECT src, 0.0, distrust * {damping!r} / n_in FROM graph JOIN s{k} ON dst = host
        ) GROUP BY host)"""
        for k in range(iterations)
    )
    return f"""
        WITH named AS (
            SELECT page_id, coalesce(html, '') AS html,
                {lower.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), judged AS (
            SELECT *, CASE {name} END AS rule, CASE {verdict} END AS by_rule FROM named
        ), edges AS (
            SELECT DISTINCT src, dst FROM (
                SELECT host AS src, {lower.format("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst FROM named
            ) WHERE src <> '' AND src <> dst
        ), graph AS MATERIALIZED (
            SELECT src, dst, count(*) OVER (PARTITION BY src) AS n_out, count(*) OVER (PARTITION BY dst) AS n_in FROM edges
        ), s0 AS MATERIALIZED (
            SELECT host, avg(CASE WHEN by_rule = 'allow' THEN 1.0::DOUBLE ELSE 0.0 END) * {rest!r} AS trust,
                avg(CASE WHEN by_rule = 'block' THEN 1.0::DOUBLE ELSE 0.0 END) * {rest!r} AS distrust
            FROM judged WHERE host <> '' GROUP BY host
        ){rounds}
        SELECT page_id, judged.host, path, rule, coalesce(by_rule,
            CASE WHEN distrust >= {threshold * rest!r} AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
        FROM judged LEFT JOIN s{iterations} ON judged.host = s{iterations}.host
    """
