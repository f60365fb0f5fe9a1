"""Hosts judged by propagation over the link graph (DataFrame functions only)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblode.llm.common import number_of, numbered, without
from weblode.session import stored, work_path

ADDED = ("host", "path", "rule", "verdict")
# Scores are whole numbers, so they do not depend on the order in which shares are added.
MASS = 10**15
ROUNDS = 10  # of the SQL; the operator goes on until its scores have settled
DAMPING = 85  # hundredths of a score that are passed on
THRESHOLD = 25  # hundredths of the mean mass of a host by which distrust must exceed trust
# Scores have settled when all that may still move, over all hosts, cannot change a verdict or is this share of its margin.
SETTLED = 1000
STEP = 5
HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""

# (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, of, start = rule
    return ((host == of) | host.endswith("." + of)) & path.startswith(start)


def longest_first(rules: Sequence[tuple[str, str, str]]):
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))


def chosen(host: Column, path: Column, rules, pick) -> Column:
    out = F.lit(None).cast("string")
    for rule in reversed(longest_first(rules)):
        out = F.when(fits(host, path, rule), F.lit(pick(rule))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url: Column, html: Column) -> DataFrame:
    """Distinct (src, dst) between different hosts.

    A page's host links to the hosts that its ``href`` attributes name (a relative one names its own), and a
    host and the host one label above it vouch for each other if both have pages.
    """
    hrefs = pages.select(host_of(url).alias("src"), F.explode(F.regexp_extract_all(html, F.lit(HREF), 1)).alias("href"))
    absolute = F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), "href")).otherwise(F.col("href"))
    links = hrefs.where("instr(href, '//') > 0").select("src", host_of(absolute).alias("dst"))
    hosts = pages.select(host_of(url).alias("src")).distinct()
    above = hosts.select("src", F.regexp_replace("src", r"^[^.]*\.", "").alias("dst")).where("instr(src, '.') > 0")
    kin = above.join(hosts.select(F.col("src").alias("dst")), "dst").select("src", "dst")
    both = links.unionByName(kin).unionByName(kin.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return both.where("src <> '' and dst <> '' and src <> dst").distinct()


def rounds_for(left: int, damping: int) -> int:
    """Rounds after which no more than ``left`` can still move: each round leaves ``damping`` hundredths of twice ``MASS`` in two scores."""
    return max(1, math.ceil(math.log(4 * MASS / max(left, 1)) / -math.log(damping / 100)))


def propagated(edges: DataFrame, hosts: DataFrame, rounds: int | None, damping: int, margin: int) -> DataFrame:
    """(host, trust, distrust): personalised PageRank over (src, dst) from trusted hosts, and against the links from blocked ones.

    ``MASS`` is dealt evenly to the seeds of a score; each round passes ``damping`` hundredths of it evenly along
    the edges and adds the rest of the seed's own. The scores of every ``STEP`` rounds are written to the shared folder.
    Rounds go on until all that later ones can move is less than what would change a verdict, or less than a
    ``SETTLED``-th of the ``margin``; shares are rounded down, so after ``rounds_for`` rounds nothing but rounding is
    left. ``rounds`` fixes their number instead.
    """
    spark = edges.sparkSession
    ways = edges.select(F.lit(0).alias("kind"), "src", "dst").unionByName(edges.select(F.lit(1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    degree = ways.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("degree"))
    paths = stored(ways.join(degree, ["kind", "src"]), work_path(spark, "paths"))
    n = hosts.agg(F.count_if("trusted"), F.count_if("blocked")).first()
    seeds = [hosts.where(name).select(F.lit(kind).alias("kind"), "host", F.lit(MASS // max(n[kind], 1)).cast("long").alias("score")) for kind, name in enumerate(("trusted", "blocked"))]
    scores = stored(seeds[0].unionByName(seeds[1]), work_path(spark, "scores"))
    rest = scores.select("kind", "host", F.expr(f"score * {100 - damping} div 100").alias("part"))
    left = max(1, margin // SETTLED)
    most = rounds if rounds is not None else rounds_for(left, damping)
    done = 0
    while done < most:
        step = min(STEP, most - done)
        new = scores
        for _ in range(step):
            sent = paths.join(new.select("kind", F.col("host").alias("src"), "score"), ["kind", "src"])
            sent = sent.select("kind", F.col("dst").alias("host"), F.expr(f"score * {damping} div (100 * degree)").alias("part"))
            new = sent.unionByName(rest).groupBy("kind", "host").agg(F.sum("part").alias("score"))
        before, scores = scores, stored(new, work_path(spark, "scores"))
        done += step
        if rounds is not None:
            continue
        sign = F.when(F.col("kind") == 1, 1).otherwise(-1)
        changes = scores.unionByName(before.select("kind", "host", (-F.col("score")).alias("score")))
        moved = changes.groupBy("kind", "host").agg(F.sum("score").alias("x")).agg(F.sum(F.abs("x"))).first()[0] or 0
        nearest = scores.groupBy("host").agg(F.sum(sign * F.col("score")).alias("x")).agg(F.min(F.abs(F.col("x") - margin))).first()[0]
        kept = (damping / 100) ** step
        if moved * kept / (1 - kept) < max(left, margin if nearest is None else min(nearest, margin)):
            break
    return scores.groupBy("host").agg(*[F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0)).alias(name) for kind, name in enumerate(("trust", "distrust"))])


def judged_pages(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    url_column: str = "url",
    html_column: str = "html",
    rounds: int | None = None,
    damping: int = DAMPING,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, the longest ``rule`` that fits and a ``verdict``.

    Hosts with a page that an allow rule fits are trusted seeds, hosts with a blocked page blocked ones. Trust
    runs along the links from trusted seeds, distrust against them from blocked seeds. A page without a rule is
    blocked if its host has more distrust than trust by ``threshold`` hundredths of the mean over all
    hosts, and allowed otherwise. Scores are passed on until what may still move, over all hosts, changes no verdict or is under a
    thousandth of that margin; ``rounds`` fixes the number of rounds instead. Null addresses and those without ``://`` have no host and are
    allowed. Null markup has no links. Repeated rows are judged alike; input columns that bear the name of an added one are
    replaced; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    html, url = F.col(number_of(pages, html_column)), F.col(number_of(pages, url_column))
    page = numbered(pages).withColumns({"_host": host_of(url), "_path": path_of(url)})
    page = page.withColumns(
        {
            "_rule": chosen(F.col("_host"), F.col("_path"), rules, lambda r: r[1] + r[2]),
            "_said": chosen(F.col("_host"), F.col("_path"), rules, lambda r: r[0]),
        }
    )
    hosts = stored(
        page.where("_host <> ''").groupBy(F.col("_host").alias("host")).agg(F.max(F.expr("_said <=> 'allow'")).alias("trusted"), F.max(F.expr("_said <=> 'block'")).alias("blocked")),
        work_path(spark, "hosts"),
    )
    edges = stored(host_edges(numbered(pages), url, html), work_path(spark, "edges"))
    margin = MASS * threshold // (100 * max(hosts.count(), 1))
    scored = hosts.select("host").join(propagated(edges, hosts, rounds, damping, margin), "host", "left")
    bad = scored.where(F.coalesce("distrust", F.lit(0)) - F.coalesce("trust", F.lit(0)) > margin).select(F.col("host").alias("_host"), F.lit(True).alias("_bad"))
    # One row per host on the right; pages of a large host are split by adaptive execution.
    named = page.join(bad, "_host", "left")
    kept = [F.col(number_of(pages, c)).alias(c) for c in without(pages, ADDED).columns]
    verdict = F.coalesce("_said", F.when(F.col("_bad"), F.lit("block")).otherwise(F.lit("allow")))
    return named.select(*kept, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), verdict.alias("verdict"))


def oracle(rules=RULES, rounds: int = ROUNDS, damping: int = DAMPING, threshold: int = THRESHOLD) -> str:
    """The same in DuckDB's SQL, one common table per round."""

    def case(pick) -> str:
        whens = " ".join(
            f"WHEN (host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}') THEN '{pick(r)}'" for r in longest_first(rules)
        )
        return f"CASE {whens} ELSE NULL END"

    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = "coalesce(" + low.format("regexp_extract({}, '(?s)^.*?://([^/?#]*)', 1)") + ", '')"
    out = [
        f"p AS (SELECT page_id, html, {host.format('url')} AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)",
        f"r AS (SELECT *, {case(lambda r: r[1] + r[2])} AS rule, {case(lambda r: r[0])} AS said FROM p)",
        "h AS (SELECT host, bool_or(coalesce(said = 'allow', false)) AS trusted, bool_or(coalesce(said = 'block', false)) AS blocked FROM r WHERE host <> '' GROUP BY host)",
        "l AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)\\bhref\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1)) AS href FROM p)",
        f"a AS (SELECT src, {host.format('CASE WHEN starts_with(href, $$//$$) THEN $$http:$$ || href ELSE href END')} AS dst FROM l WHERE contains(href, '//'))",
        "k AS (SELECT x.host AS src, y.host AS dst FROM h x JOIN h y ON y.host = regexp_replace(x.host, '^[^.]*\\.', '') WHERE contains(x.host, '.'))",
        "e AS (SELECT DISTINCT src, dst FROM (FROM a UNION ALL FROM k UNION ALL SELECT dst, src FROM k) WHERE src <> '' AND dst <> '' AND src <> dst)",
    ]
    for name, (source, target), seed in (("t", ("src", "dst"), "trusted"), ("d", ("dst", "src"), "blocked")):
        out.append(f"{name}s AS (SELECT host, ({MASS} // greatest(count(*) OVER (), 1))::BIGINT AS start FROM h WHERE {seed})")
        out.append(f"{name}e AS (SELECT {source} AS s, {target} AS t, count(*) OVER (PARTITION BY {source}) AS degree FROM e)")
        out.append(f"{name}0 AS (SELECT host, start AS score FROM {name}s)")
        for i in range(rounds):
            out.append(
                f"{name}{i + 1} AS (SELECT host, sum(part)::BIGINT AS score FROM (SELECT t AS host, score * {damping} // (100 * degree) AS part "
                f"FROM {name}e JOIN {name}{i} q ON q.host = s UNION ALL SELECT host, start * {100 - damping} // 100 FROM {name}s) GROUP BY host)"
            )
    out.append(
        f"b AS (SELECT h.host FROM h LEFT JOIN t{rounds} t ON t.host = h.host LEFT JOIN d{rounds} d ON d.host = h.host "
        f"WHERE coalesce(d.score, 0) - coalesce(t.score, 0) > {MASS * threshold} // (100 * (SELECT greatest(count(*), 1) FROM h)))"
    )
    return "WITH " + ",\n".join(out) + "\nSELECT page_id, host, path, rule, coalesce(said, CASE WHEN host IN (SELECT host FROM b) THEN 'block' ELSE 'allow' END) AS verdict FROM r"
