"""URL filter: rules first, link-graph propagation for the rest.

Rules name a host and a path prefix; the longest that fits decides. Hosts whose
pages the rules allow are trusted seeds, hosts whose pages they block are
blocked seeds. Over the host graph (links in the pages' html, and each host
with its parent domain) two personalised PageRanks run in Spark: trust flows
along the links from the trusted seeds, distrust against them from the blocked
ones. Rounds go on until no host's rank grows by more than TOLERANCE of itself, so
every host that a seed reaches over any number of links has its rank. A host is blocked if distrust makes up more than a threshold of both.

A null url has an empty host and path and fits no rule; a null html has no
links. Hosts that neither rank reaches are allowed. Ties (equal ranks) are
allowed. Repeated rows are judged alike and count as often as they occur. An
empty table gives no rows. Only page_id, url and html are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import ascii_lower, dropped, table, written

# Fixed values: (verdict, host, path prefix).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""
DAMPING = 0.85
ROUNDS = 75                    # 0.85^75 = 5e-6 of the rank mass is not dealt by then
ROUNDS_PER_TABLE = 3
TOLERANCE = 1e-5
BLOCK_SHARE = 0.5


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or end; empty without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    name = verdict = None
    for what, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict."""
    d = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return d.withColumns({"rule": rule, "by_rule": verdict})


def parent_of(host: Column) -> Column:
    """The host without its first label, if at least two labels are left; else null."""
    rest = F.regexp_extract(host, r"^[^.]+\.(.+\..+)$", 1)
    return F.when(rest != "", rest)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links): links between different hosts, one row per pair."""
    found = (pages.select(host_of(F.col("url")).alias("src"),
                          F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst"))
             .select("src", ascii_lower(F.col("dst")).alias("dst")))
    hosts = pages.select(host_of(F.col("url")).alias("src")).distinct()
    up = hosts.select("src", parent_of(F.col("src")).alias("dst")).dropna()
    both = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return (found.unionByName(both).filter("src <> dst and src <> '' and dst <> ''")
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) from (src, dst, links) and seeds (host, trust, distrust).

    At least ``rounds`` rounds, or until nothing changes, then until the ranks have
    settled. Ranks only grow, and a host first reached grows by all of its rank.
    """
    out = edges.groupBy("src").agg(F.sum("links").alias("out"))
    into = edges.groupBy("dst").agg(F.sum("links").alias("into"))
    weighed = edges.join(out, "src").join(into, "dst")
    # one table of half-edges: trust goes with the link, distrust against it
    zero = F.lit(0.0)
    half = written(weighed.select("src", F.col("dst").alias("to"), (F.col("links") / F.col("out")).alias("t"),
                                  zero.alias("d"))
                   .unionByName(weighed.select(F.col("dst").alias("src"), F.col("src").alias("to"),
                                               zero.alias("t"), (F.col("links") / F.col("into")).alias("d")))
                   .groupBy("src", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d")), "host-edges")
    start = seeds.select("host", ((1 - damping) * F.col("trust")).alias("trust"),
                         ((1 - damping) * F.col("distrust")).alias("distrust"))
    ranks, last, k, growth = start, None, 0, 1.0
    while growth > (TOLERANCE if k >= rounds else 0):
        moved = half.join(ranks.withColumnRenamed("host", "src"), "src").select(
            F.col("to").alias("host"), (damping * F.col("t") * F.col("trust")).alias("trust"),
            (damping * F.col("d") * F.col("distrust")).alias("distrust"))
        k += 1
        if k % ROUNDS_PER_TABLE:
            ranks = moved.unionByName(start).groupBy("host").agg(
                F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
            continue
        # the ranks of the round before travel along, for the growth
        was = ranks.select("host", zero.alias("trust"), zero.alias("distrust"),
                           F.col("trust").alias("was_trust"), F.col("distrust").alias("was_distrust"))
        names = ["trust", "distrust", "was_trust", "was_distrust"]
        new = written(moved.unionByName(start).withColumns({"was_trust": zero, "was_distrust": zero}).unionByName(was)
                      .groupBy("host").agg(*[F.sum(c).alias(c) for c in names]), "host-ranks")
        share = [F.when(F.col(c) > 0, (F.col(c) - F.col(f"was_{c}")) / F.col(c)).otherwise(0.0) for c in names[:2]]
        # sums in another order differ in the last digits
        growth = new.agg(F.max(F.greatest(*share))).first()[0] or 0.0
        growth = growth if growth > 1e-12 else 0.0
        if last is not None:
            dropped(last)
        ranks, last = new.select("host", "trust", "distrust"), new
    dropped(half)
    return ranks


def filter_urls(pages: DataFrame, rules=RULES, block_share: float = BLOCK_SHARE) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    pages = pages.select("page_id", "url", "html")
    by_rule = judged(pages, rules)
    counts = written(by_rule.filter("host <> ''").groupBy("host").agg(
        F.count_if(F.col("by_rule") == "allow").alias("a"), F.count_if(F.col("by_rule") == "block").alias("b")),
        "host-seeds")
    a, b = counts.agg(F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    seeds = counts.select("host", (F.col("a") / max(1, a)).alias("trust"),
                          (F.col("b") / max(1, b)).alias("distrust"))
    ranks = propagate(host_edges(pages), seeds)
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    bad = (F.col("trust") + F.col("distrust") > 0) & (share > block_share)
    out = by_rule.join(ranks, "host", "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("by_rule", F.when(bad, "block").otherwise("allow")).alias("verdict"),
                      F.coalesce("trust", F.lit(0.0)).alias("trust"),
                      F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict of every page."""
    return filter_urls(table(spark, sf_dir, "pages"))
