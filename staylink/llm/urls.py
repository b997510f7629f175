"""URL filter: explicit rules first, then link-graph propagation over hosts.

Hosts are the vertices.  An edge leads from the host of a page to the host of
each absolute hyperlink in it, and both ways between a host and its parent
domain (``blog.a.example`` and ``a.example``) as far as both occur among the
pages.  Hosts whose pages the rules allow are trusted seeds, those whose pages
they block are blocked seeds, each weighted by its judged pages.  Trust is a
personalised PageRank from the trusted seeds along the edges, distrust one from
the blocked seeds against them; a host is blocked if its distrust is above its
trust.  Both vectors are long integers out of ``UNITS``, propagated with integer
division, so the ranks do not depend on the order of summation.

The graph has one row per host and host pair: links are counted per pair before
any shuffle of the pages, rounds join two tables of host size, and no page is
shuffled.  A hot host is one row there.

Defined results: a null url or one without ``://`` has empty host and path, fits
no rule and gets the verdict of the empty host, which nothing links: allow.
Repeated urls and page ids are judged row by row.  Null html has no links; an
empty table gives no rows.  Only page_id, url and html are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import load, stored

#: (action, host and path)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
UNITS = 10 ** 12
DAMPING = 85  # per cent
ROUNDS = 12
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), *LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, action): the longest rule that fits."""
    d = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    fits = []
    for action, rule in sorted(rules, key=lambda r: -len(r[1])):  # longest first
        host, path = rule.split("/", 1)
        ok = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        fits.append(F.when(ok, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))))
    return d.withColumn("_r", F.coalesce(*fits)).select("page_id", "host", "path", "_r.rule", "_r.action")


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, and parent domains both ways."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all(
        F.col("html"), F.lit(r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), F.lit(1))).alias("href"))
    links = links.select("src", host_of(F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), F.col("href")))
                                        .otherwise(F.col("href"))).alias("dst"))
    links = links.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    # every host's proper suffixes that are hosts themselves or shared by hosts
    labels = F.split("host", r"\.")
    parents = hosts.where(F.col("host") != "").select("host", F.explode(F.expr(
        "transform(sequence(2, greatest(2, size(split(host, '[.]')))), i -> array_join(slice(split(host, '[.]'), i, 999), '.'))"
    )).alias("up"), F.size(labels).alias("k")).where(F.col("up") != "")
    step = parents.where(F.size(F.split("up", r"\.")) == F.col("k") - 1)
    up = step.select(F.col("host").alias("src"), F.col("up").alias("dst"))
    chain = parents.select(F.col("up").alias("src"), F.expr("substr(up, instr(up, '.') + 1)").alias("dst")) \
                   .where(F.instr("src", ".") > 0)
    tree = up.unionByName(chain).distinct()
    both = tree.unionByName(tree.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return links.unionByName(both).groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, out: str, damping: int = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, out): personalised PageRank in units out of ``UNITS``; ``seeds`` has
    (host, w).  Mass at hosts without out-edges leaves the walk."""
    total = seeds.agg(F.sum("w")).first()[0] or 1  # one number
    base = seeds.select("host", F.floor(F.lit(float(UNITS)) * F.col("w") / F.lit(total)).cast("long").alias("s")) \
                .where(F.col("s") > 0)
    degree = edges.groupBy("src").agg(F.sum("n").alias("deg"))
    e = edges.join(degree, "src").select("src", "dst", "n", "deg")
    rank = base.select("host", F.col("s").alias("r"))
    for k in range(rounds):
        moved = e.join(rank, e["src"] == rank["host"]) \
                 .select(F.col("dst").alias("host"), F.expr("r div deg * n").alias("m")) \
                 .groupBy("host").agg(F.sum("m").alias("m"))
        rank = base.join(moved, "host", "full").select("host", F.expr(
            f"(coalesce(s, 0L) * {100 - damping}) div 100 + (coalesce(m, 0L) * {damping}) div 100").alias("r")) \
            .where(F.col("r") > 0)
        if k % 4 == 3:
            rank = stored(rank, "rank")
    return rank.select("host", F.col("r").cast("long").alias(out))


def filter_urls(pages: DataFrame, rules=RULES, damping: int = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) per page."""
    rows = judged(pages, rules)
    per_host = stored(rows.groupBy("host").agg(F.count(F.when(F.col("action") == "allow", 1)).alias("good"),
                                               F.count(F.when(F.col("action") == "block", 1)).alias("bad")), "hosts")
    edges = stored(host_edges(pages, per_host), "host-edges")
    seeds = lambda c: per_host.where(F.col(c) > 0).select("host", F.col(c).alias("w"))
    trust = propagate(edges, seeds("good"), "trust", damping, rounds)
    reverse = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(reverse, seeds("bad"), "distrust", damping, rounds)
    hosts = per_host.select("host").join(trust, "host", "left").join(distrust, "host", "left") \
                    .na.fill(0, ["trust", "distrust"])
    verdict = F.coalesce("action", F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow"))
    return rows.join(hosts, "host").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")


def oracle_sql(rounds: int = ROUNDS, damping: int = DAMPING) -> str:
    """The same rules, graph and rounds as one DuckDB query."""
    rule_case = "CASE " + " ".join(
        f"WHEN (host = '{r.split('/', 1)[0]}' OR host LIKE '%.{r.split('/', 1)[0]}') AND starts_with(path, '/{r.split('/', 1)[1]}') THEN '{a}|{r}'"
        for a, r in sorted(RULES, key=lambda x: -len(x[1]))) + " END"
    host = lambda u: f"translate(regexp_extract(CASE WHEN strpos({u}, '://') > 0 THEN substr({u}, strpos({u}, '://') + 3) END, '^[^/?#]*'), '{LOWER[0]}', '{LOWER[1]}')"
    ctes = [f"""p0 AS (SELECT page_id, html, coalesce({host('url')}, '') AS host,
      coalesce(regexp_extract(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '^[^/?#]*([^?#]*)', 1), '') AS path FROM pages)""",
            f"p AS (SELECT *, {rule_case} AS r FROM p0)",
            "h AS (SELECT host, count(*) FILTER (r LIKE 'allow|%') AS good, count(*) FILTER (r LIKE 'block|%') AS bad FROM p GROUP BY host)",
            r"""l0 AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?\s*((?:https?:)?//[^"''\s>]+)', 1)) AS u FROM p)""",
            f"l AS (SELECT src, coalesce({host('v')}, '') AS dst FROM (SELECT src, CASE WHEN starts_with(u, '//') THEN 'http:' || u ELSE u END AS v FROM l0))",
            "sfx AS (SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), i, 999), '.') AS s FROM h, range(1, 200) t(i) WHERE i <= len(string_split(host, '.')) AND host <> '')",
            "tr AS (SELECT s AS src, substr(s, strpos(s, '.') + 1) AS dst FROM sfx WHERE strpos(s, '.') > 0 AND substr(s, strpos(s, '.') + 1) <> '')",
            "e AS (SELECT src, dst, count(*) AS n FROM (SELECT src, dst FROM l WHERE src <> '' AND dst <> '' AND src <> dst UNION ALL SELECT src, dst FROM tr UNION ALL SELECT dst, src FROM tr) GROUP BY src, dst)"]
    for name, col, a, b in (("t", "good", "src", "dst"), ("d", "bad", "dst", "src")):
        ctes.append(f"{name}e AS (SELECT {a} AS src, {b} AS dst, n, sum(n) OVER (PARTITION BY {a}) AS deg FROM e)")
        ctes.append(f"{name}s AS (SELECT * FROM (SELECT host, floor({UNITS}::DOUBLE * {col} / sum({col}) OVER ())::BIGINT AS s FROM h WHERE {col} > 0) WHERE s > 0)")
        ctes.append(f"{name}0 AS (SELECT host, s AS r FROM {name}s)")
        for k in range(rounds):
            ctes.append(f"""{name}{k + 1} AS (SELECT * FROM (SELECT host, (coalesce(s, 0) * {100 - damping}) // 100 + (coalesce(m, 0) * {damping}) // 100 AS r
              FROM {name}s FULL JOIN (SELECT dst AS host, sum(r // deg * n) AS m FROM {name}e JOIN {name}{k} ON src = host GROUP BY dst) USING (host)) WHERE r > 0)""")
    return "WITH " + ",\n".join(ctes) + f"""
    SELECT page_id, p.host, path, CASE WHEN r IS NOT NULL THEN substr(r, 7) END AS rule,
      CASE WHEN p.r IS NOT NULL THEN substr(p.r, 1, 5) WHEN coalesce(d{rounds}.r, 0) > coalesce(t{rounds}.r, 0) THEN 'block' ELSE 'allow' END AS verdict
    FROM p LEFT JOIN t{rounds} ON t{rounds}.host = p.host LEFT JOIN d{rounds} ON d{rounds}.host = p.host""".replace("CASE WHEN r IS NOT NULL THEN substr(r, 7)", "CASE WHEN p.r IS NOT NULL THEN substr(p.r, 7)")


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(load(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
