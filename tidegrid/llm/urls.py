"""URL filter: rules by host and path, and link-graph propagation of trust and distrust between hosts.

A rule decides the urls that it fits. For the others the host decides: hosts are seeded with the share of their pages that
rules allow (trust) and block (distrust); personalised PageRank carries trust along links between
hosts and distrust against them. Scores are shares: what links bring a host of what they would bring if every
host were seeded with 1. So they do not shrink with the number of links. A host keeps its own seed at least; one whose
distrust exceeds its trust by more than ``threshold`` is blocked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import discard, prepare, shared_dir, table, written

#: (verdict, host, path); the longest that fits decides.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
DAMPING, THRESHOLD, TOLERANCE = 0.85, 0.5, 1e-4


def host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """df with host (between the first :// and the next /, ?, # or end, A-Z lower-cased) and path (from there to ?, # or end); both empty without :// or url."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substr({url}, instr({url}, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return df.withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn("path", path)


def with_rule(df: DataFrame, rules: tuple = RULES) -> DataFrame:
    """df(host, path) with rule (host + path of the longest that fits, else null) and rule_verdict. Rules are few (a literal list)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w): links between different hosts in the html of pages(host, html), with their number; relative links stay on the host and are none."""
    links = F.array_distinct(F.regexp_extract_all(F.col("html"), F.lit(r"""(?i)\bhref\s*=\s*["']?((?:https?:)?//[^\s"'>]+)"""), F.lit(1)))
    out = pages.select(F.col("host").alias("src"), F.explode(links).alias("link"))
    out = host_and_path(out.withColumn("link", F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))), "link")
    return out.where("host <> '' AND src <> '' AND host <> src").groupBy("src", F.col("host").alias("dst")).agg(F.count("*").cast("double").alias("w"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(node, score of each seed column): seeds(node, ...) carried over edges(src, dst, w): score = (1 - damping) seed + damping sum of what comes in.

    A node without edges out keeps what it has, so mass is kept. Rounds go on until no score moves by ``tolerance``: all moves
    together shrink by ``damping`` at least in each round, so they end, about 57 rounds for each 1e-4. All columns go in the same rounds.
    Nodes appear if they have a seed or an edge. A round aggregates before its shuffle, and its table replaces the last one.
    """
    spark, names = seeds.sparkSession, [c for c in seeds.columns if c != "node"]
    nodes = seeds.select("node").union(edges.select("src")).union(edges.select("dst")).distinct()
    out = edges.groupBy("src").agg(F.sum("w").alias("out"))
    base = nodes.join(seeds, "node", "left").join(out.withColumnRenamed("src", "node"), "node", "left")
    base = written(base.select("node", "out", *[F.coalesce(c, F.lit(0.0)).alias(f"seed_{c}") for c in names]))
    step = written(edges.join(base.select(F.col("node").alias("src"), "out"), "src").select("src", "dst", (F.col("w") / F.col("out")).alias("p")))
    score, last = base.select("node", *[F.col(f"seed_{c}").alias(c) for c in names]), None
    while True:
        come = score.join(step, score.node == step.src).groupBy("dst").agg(*[F.sum(F.col(c) * F.col("p")).alias(f"come_{c}") for c in names])
        both = base.join(score, "node").join(come, F.col("node") == F.col("dst"), "left")
        kept = lambda c: F.when(F.col("out").isNull(), F.col(c)).otherwise(F.lit(0.0))
        new = [((1 - damping) * F.col(f"seed_{c}") + damping * (F.coalesce(f"come_{c}", F.lit(0.0)) + kept(c))).alias(c) for c in names]
        path = shared_dir(spark)
        table = written(both.select("node", *new, *[F.col(c).alias(f"old_{c}") for c in names]), path)
        moved = table.agg(F.max(F.greatest(*[F.abs(F.col(c) - F.col(f"old_{c}")) for c in names], F.lit(0.0)))).first()[0]
        if last:
            discard(spark, last)
        score, last = table.select("node", *names), path
        if not moved or moved < tolerance:
            return score


def shares(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust), 0 to 1: ``damping`` times what links bring a host, as a share of what they would bring if every host were seeded with 1.

    seeds(host, trust, distrust). Trust goes along edges(src, dst, w), distrust against them: two copies of the graph, in one run of rounds.
    """
    way = lambda host, back: F.struct(F.col(host).alias("host"), F.lit(back).alias("back"))
    both = edges.select(way("src", False).alias("src"), way("dst", False).alias("dst"), "w").union(edges.select(way("dst", True).alias("src"), way("src", True).alias("dst"), "w"))
    both = written(both)
    of = seeds.select(way("host", False).alias("node"), F.col("trust").alias("own")).union(seeds.select(way("host", True).alias("node"), F.col("distrust").alias("own")))
    hosts = of.select("node").union(both.select("src")).union(both.select("dst")).distinct()
    full = hosts.join(of, "node", "left").select("node", F.coalesce("own", F.lit(0.0)).alias("own"), F.lit(1.0).alias("most"))
    score = propagate(full, both, damping, tolerance)
    out = both.groupBy("src").agg(F.sum("w").alias("out"))
    come = both.join(out, "src").join(score, F.col("src") == F.col("node")).groupBy("dst").agg((F.sum(F.expr("own * w / out")) / F.sum(F.expr("most * w / out"))).alias("share"))
    share = score.join(come, F.col("node") == F.col("dst"), "left").select("node.host", "node.back", (damping * F.least(F.coalesce("share", F.lit(0.0)), F.lit(1.0))).alias("s"))
    return share.groupBy("host").agg(F.max(F.when(~F.col("back"), F.col("s"))).alias("trust"), F.max(F.when(F.col("back"), F.col("s"))).alias("distrust"))


def judge(pages: DataFrame, rules: tuple = RULES, threshold: float = THRESHOLD, damping: float = DAMPING) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of pages(page_id, url, html); trust and distrust are the host's. Other columns are ignored.

    A null url has empty host and path, fits no rule, and is allowed. The null html has no links. A row for
    each row of pages; an empty table gives none.
    """
    spark = pages.sparkSession
    prepare(spark)
    rows = with_rule(host_and_path(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))), rules)
    share = lambda v: (F.count(F.when(F.col("rule_verdict") == v, 1)) / F.count("*")).alias(v)
    hosts = written(rows.where("host <> ''").groupBy("host").agg(share("allow"), share("block")))
    edges = written(host_edges(rows))
    scores = shares(hosts.select("host", F.col("allow").alias("trust"), F.col("block").alias("distrust")), edges, damping).join(hosts, "host", "left")
    scores = written(scores.select(F.col("host").alias("_host"), F.greatest("trust", "allow").alias("trust"), F.greatest("distrust", "block").alias("distrust")))
    judged = rows.drop("html").join(scores, F.col("host") == F.col("_host"), "left").drop("_host")
    by_host = F.when(F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0.0)) > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_host).alias("verdict"), "trust", "distrust")


def op10_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
