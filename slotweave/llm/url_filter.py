"""URL filters: rules on host and path, and trust that flows over the links between hosts.

Pages that a rule judges are seeds. Trust is personalised PageRank along links from hosts with allowed pages: a rank is
x = seed + DAMPING * flow over the links, where the seed is the share of a host's pages that are allowed (that is the
walk in which hosts without links hand their rank back to the seeds, times a constant). It is held against the rank that
the same links carry when every host is a seed: the trust of a host is the share of what flows to it that comes from
trusted ones.

Distrust runs against links from hosts with blocked pages: it is the chance that a surfer who starts on a page of the host
and goes on with DAMPING from page to page meets a blocked one. Of a farm of hosts that link to a blocked one and to each
other each gets it in full, however many there are, while one bad link among many counts little.

A host's links to itself carry nothing. A host is blocked when that chance is more than a half, and its trust is not near
it. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, release

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path) of the rules.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
DAMPING = 0.85
ITERATIONS = 10
#: A host is blocked when its distrust is over so many times its trust, and over LEAST.
RATIO, LEAST, MARGIN = 4.0, 0.5, 1e-9
HREF = r"""(?i)href\s*=\s*["']?\s*([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null. A rule fits its host and all subdomains if the
    path starts with its path."""
    longest_first = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in longest_first]
    return F.coalesce(*fits)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) from (host, html): links between hosts, each counted once a page; a link without a host stays on
    its own."""
    link = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), F.lit(1)))).alias("link"))
    dst = F.when(F.col("link").contains("://"), host_of(F.col("link"))).when(F.col("link").startswith("//"), host_of(F.concat(F.lit("x:"), "link"))).otherwise(F.col("src"))
    return link.select("src", dst.alias("dst")).where("src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules=RULES, iterations: int = ITERATIONS) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), a row for each row of ``pages``; trust and distrust are those
    of the page's host, from 0 to 1, and null without a host.

    A null url, or one without ://, has an empty host and path; its page is allowed unless a rule says otherwise. A null
    html has no links; all links of a very long one count, each target once a page. Of rules of equal length the first
    in the list wins. Repeated rows are judged alike, and each counts as a page; an empty table gives an empty result;
    other columns are not looked at."""
    p = pages.select(F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(html).alias("html"))
    p = p.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    part = lambda v: F.avg((F.coalesce(F.col("hit.verdict"), F.lit("")) == v).cast("double"))
    seeds = p.where("host <> ''").groupBy("host").agg(part("allow").alias("trust0"), part("block").alias("distrust0"))
    found = materialize(host_edges(p).where("src <> dst"), "url-edges")
    out = found.groupBy("src").agg(F.sum("n").alias("out_n"))
    edges = materialize(found.join(out, "src").select("src", "dst", (F.col("n") / F.col("out_n")).alias("weight")), "url-edges")
    hosts = seeds.unionByName(edges.select(F.explode(F.array("src", "dst")).alias("host")).distinct().select("host", F.lit(0.0).alias("trust0"), F.lit(0.0).alias("distrust0")))
    hosts = materialize(hosts.groupBy("host").agg(F.sum("trust0").alias("trust0"), F.sum("distrust0").alias("distrust0")), "url-hosts")
    release(found)
    state = _ranks(hosts, edges, iterations)
    bad = (F.col("distrust") > F.col("trust") * RATIO + MARGIN) & (F.col("distrust") > LEAST + MARGIN)
    state = state.withColumn("method", F.when(bad, "block").otherwise("allow"))
    out = p.drop("html").join(state, "host", "left")
    return out.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", "method", F.lit("allow")).alias("verdict"), "trust", "distrust")


def _ranks(hosts: DataFrame, edges: DataFrame, iterations: int) -> DataFrame:
    """(host, trust, distrust) after so many rounds, or fewer if the ranks stay as they are before: they never fall, so
    that equal sums mean equal ranks. Rounds are written and combine before their shuffle, so that a host that very many
    link to is a row a task."""
    zero = F.lit(0.0)
    # flows of the seeds' trust, of trust when every host is a seed, and of distrust
    flows = ("t", "all_t", "d")
    state, before = hosts.select("host", F.col("trust0").alias("trust"), F.lit(1.0).alias("all_trust"), F.col("distrust0").alias("distrust"), *(zero.alias(c) for c in flows)), None
    for _ in range(iterations):
        carried = lambda rank, name: (F.col(rank) * F.col("weight")).alias(name)
        forth = edges.join(state.select(F.col("host").alias("src"), "trust", "all_trust"), "src").select(F.col("dst").alias("host"), carried("trust", "t"), carried("all_trust", "all_t"), zero.alias("d"))
        back = edges.join(state.select(F.col("host").alias("dst"), "distrust"), "dst").select(F.col("src").alias("host"), zero.alias("t"), zero.alias("all_t"), carried("distrust", "d"))
        flow = forth.unionByName(back).groupBy("host").agg(*(F.sum(c).alias(c) for c in flows))
        new = hosts.join(flow, "host", "left").select("host", "trust0", "distrust0", *(F.coalesce(c, zero).alias(c) for c in flows))
        meets = F.col("distrust0") + (1 - F.col("distrust0")) * F.col("d") * DAMPING
        new = materialize(new.select("host", (F.col("trust0") + F.col("t") * DAMPING).alias("trust"), (F.col("all_t") * DAMPING + 1).alias("all_trust"), meets.alias("distrust"), *flows), "url-state")
        release(state)
        state = new
        now = tuple(state.agg(*(F.coalesce(F.sum(c), zero) for c in ("trust", "all_trust", "distrust"))).first())
        if before and all(a <= b * (1 + 1e-13) for a, b in zip(now, before, strict=True)):
            break
        before = now
    share = F.when(F.col("all_t") > 0, F.col("t") / F.col("all_t")).otherwise(zero)
    return hosts.join(state.select("host", "distrust", *flows), "host").select("host", F.greatest("trust0", share).alias("trust"), "distrust")


def allowed(pages: DataFrame, key: str = "page_id", **how) -> DataFrame:
    """The pages that are not blocked."""
    ids = judge(pages, key, **how).where("verdict = 'allow'").select(F.col("page_id").alias("_allowed_id")).distinct()
    return pages.join(ids, pages[key] == ids["_allowed_id"], "left_semi")
