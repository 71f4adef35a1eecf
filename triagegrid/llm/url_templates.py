"""URL filter by a tree of path templates, in DataFrame functions only.

Per host, paths form a tree of segments. Going down level by level, digits become wildcards, rarely seen children of a
wide node share one wildcard, and branches whose share of blocked labels can't be told from that of their node are merged. Each
template left at the end has labelled pages, those that a rule decides, and their smoothed share of blocked ones decides the
pages that no rule fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.llm.common import stored

#: Levels of the tree; what lies deeper shares the wildcard of its last level.
LEVELS = 4
#: A node with more children than this gives those below one part in RARE of its pages to one wildcard.
WIDE, RARE = 8, 20
#: Standard errors within which a branch is like its node; pages that a prior counts for; share above which to block.
LIKE, WEIGHT, LIMIT = 1.96, 4.0, 0.5
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    part = lambda n: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", n)
    return F.translate(part(1), UPPER, LOWER), part(2)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text, verdict = F, F
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = text.when(fits, F.lit(h + p)), verdict.when(fits, F.lit(v))
    return text, verdict


def _level(nodes: DataFrame, depth: int) -> DataFrame:
    """One level down: the prefix grows by a segment, its wildcard or the mark of merged branches."""
    size = F.size("segments")
    segment = F.when(size < depth, F.lit("$")).otherwise(F.regexp_replace(F.get("segments", F.lit(depth - 1)), "[0-9]+", "*"))
    if depth == LEVELS:
        segment = F.when(size > depth, F.lit("**")).otherwise(segment)
    at = nodes.withColumn("segment", segment)
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    child = at.groupBy("host", "prefix", "segment").agg(*sums)
    node = child.groupBy("host", "prefix").agg(
        F.count("*").alias("children"), F.sum("n").alias("all"), F.sum("labelled").alias("l"), F.sum("bad").alias("b")
    )
    rare = (F.col("segment") != "$") & (F.col("children") > WIDE) & (RARE * F.col("n") < F.col("all"))
    child = child.join(node, ["host", "prefix"]).withColumn("branch", F.when(rare, F.lit("*")).otherwise(F.col("segment")))
    branch = child.groupBy("host", "prefix", "branch").agg(F.sum("labelled").alias("bl"), F.sum("bad").alias("bb"))
    share = F.try_divide("b", "l")
    like = F.abs(F.try_divide("bb", "bl") - share) <= LIKE * F.sqrt(F.try_divide(share * (1 - share), F.col("bl")))
    named = child.join(branch, ["host", "prefix", "branch"]).select(
        "host", "prefix", "segment", F.when(F.coalesce(like, F.lit(False)), F.lit("~")).otherwise(F.col("branch")).alias("step")
    )
    grown = F.when(F.col("step") == "$", F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), "step")).alias("prefix")
    return at.join(named, ["host", "prefix", "segment"]).select("host", "path", "segments", "n", "labelled", "bad", grown)


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """A verdict for every row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, template, blocked_share.

    A null url, or one without ``://``, has an empty host and path. Repeated rows are judged each and all count. Segments
    are cut at ``/``; an empty one is a segment too. Urls are read whole, however long; what lies deeper than LEVELS segments shares one
    template. No rows give no rows. Other columns are not looked at.
    """
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    paths = judged.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("verdict", verdict)
    nodes = paths.select(
        "host", "path", F.expr("slice(split(path, '/'), 2, greatest(size(split(path, '/')) - 1, 0))").alias("segments"), "n",
        F.when(F.col("verdict").isNotNull(), F.col("n")).otherwise(0).alias("labelled"),
        F.when(F.col("verdict") == "block", F.col("n")).otherwise(0).alias("bad"), F.lit("").alias("prefix"),
    )
    nodes = stored(nodes, "paths")
    for depth in range(1, LEVELS + 1):
        nodes = stored(_level(nodes, depth), "paths")
    sums = [F.sum("labelled").alias("l"), F.sum("bad").alias("b")]
    whole = nodes.agg(*sums).first()
    prior = ((whole["b"] or 0) + 1.0) / ((whole["l"] or 0) + 2.0)
    of_host = nodes.groupBy("host").agg(*sums).select("host", ((F.col("b") + WEIGHT * prior) / (F.col("l") + WEIGHT)).alias("host_share"))
    share = (F.col("b") + WEIGHT * F.col("host_share")) / (F.col("l") + WEIGHT)
    templates = nodes.groupBy("host", "prefix").agg(*sums).join(of_host, "host").select("host", "prefix", share.alias("share"))
    decided = nodes.join(templates, ["host", "prefix"]).select("host", "path", F.col("prefix").alias("template"), "share")
    method = F.when(F.col("share") > LIMIT, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(decided, ["host", "path"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", F.round("share", 6).alias("blocked_share")
    )


def sql(rules=RULES) -> str:
    """The same for another engine."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}')" for h, p, _ in order]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{h + p}'" for c, (h, p, _) in zip(fits, order)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, (_, _, v) in zip(fits, order)) + " END"
    cut = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
    steps = [
        f"""j AS MATERIALIZED (SELECT page_id, translate(regexp_extract(coalesce(url, ''), {cut}, 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(coalesce(url, ''), {cut}, 2) AS path FROM pages)""",
        f"v AS (SELECT host, path, count(*) AS n, {verdict} AS verdict FROM j GROUP BY host, path)",
        """n0 AS MATERIALIZED (SELECT host, path, string_split(path, '/')[2:] AS segments, n, CASE WHEN verdict IS NOT NULL THEN n ELSE 0 END AS labelled,
        CASE WHEN verdict = 'block' THEN n ELSE 0 END AS bad, '' AS prefix FROM v)""",
    ]
    for d in range(1, LEVELS + 1):
        deep = f"WHEN len(segments) > {d} THEN '**'" if d == LEVELS else ""
        steps += [
            f"""a{d} AS MATERIALIZED (SELECT *, CASE WHEN len(segments) < {d} THEN '$' {deep} ELSE regexp_replace(segments[{d}], '[0-9]+', '*', 'g') END
            AS segment FROM n{d - 1})""",
            f"c{d} AS (SELECT host, prefix, segment, sum(n) AS n, sum(labelled) AS labelled, sum(bad) AS bad FROM a{d} GROUP BY ALL)",
            f'p{d} AS (SELECT host, prefix, count(*) AS children, sum(n) AS "all", sum(labelled) AS l, sum(bad) AS b FROM c{d} GROUP BY ALL)',
            f"""w{d} AS (SELECT c.*, p.l, p.b, CASE WHEN segment <> '$' AND children > {WIDE} AND {RARE} * n < p."all" THEN '*' ELSE segment END AS branch
            FROM c{d} c JOIN p{d} p USING (host, prefix))""",
            f"b{d} AS (SELECT host, prefix, branch, sum(labelled) AS bl, sum(bad) AS bb FROM w{d} GROUP BY ALL)",
            f"""s{d} AS (SELECT w.host, w.prefix, w.segment, CASE WHEN bl > 0 AND abs(bb::double / bl - b::double / l)
            <= {LIKE} * sqrt(b::double / l * (1 - b::double / l) / bl) THEN '~' ELSE w.branch END AS step
            FROM w{d} w JOIN b{d} USING (host, prefix, branch))""",
            f"""n{d} AS MATERIALIZED (SELECT a.host, a.path, a.segments, a.n, a.labelled, a.bad,
            CASE WHEN step = '$' THEN a.prefix ELSE a.prefix || '/' || step END AS prefix FROM a{d} a JOIN s{d} USING (host, prefix, segment))""",
        ]
    steps += [
        f"g AS (SELECT (coalesce(sum(bad), 0) + 1.0::double) / (coalesce(sum(labelled), 0) + 2.0::double) AS prior FROM n{LEVELS})",
        f"""h AS (SELECT host, (sum(bad) + {WEIGHT}::double * any_value(prior)) / (sum(labelled) + {WEIGHT}::double) AS host_share
        FROM n{LEVELS}, g GROUP BY host)""",
        f"""t AS (SELECT host, prefix, (sum(bad) + {WEIGHT}::double * any_value(host_share)) / (sum(labelled) + {WEIGHT}::double) AS share
        FROM n{LEVELS} JOIN h USING (host) GROUP BY host, prefix)""",
    ]
    return f"""WITH {", ".join(steps)} SELECT page_id, host, path, {rule} AS rule,
    coalesce({verdict}, CASE WHEN share > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, prefix AS template, round(share, 6) AS blocked_share
    FROM j JOIN n{LEVELS} USING (host, path) JOIN t USING (host, prefix)"""
