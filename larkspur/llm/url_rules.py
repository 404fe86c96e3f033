"""URL filter: fixed rules first, then trust and distrust that spread over the link graph of hosts.

Hosts whose pages the rules mostly allow are trusted seeds, hosts whose pages they mostly block are
blocked seeds.  Personalised PageRank carries trust along the links from trusted seeds, and distrust
against the links from blocked seeds (who links to a blocked host is suspect).  A host is blocked
where distrust is a large enough share of both.  DataFrame functions only; ranks are fixed-point
integers, so sums do not depend on their order and results are the same in every run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import BROADCAST_IDS, with_values
from .tables import materialize

#: Host of a link with a scheme, or with `//` alone, to another host.
LINK_HOST = r"""[hH][rR][eE][fF][ \t\r\n]*=[ \t\r\n]*["']?[ \t\r\n]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'<> \t\r\n\\]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Verdict for the URLs of a host and its subdomains whose path starts so."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the filter.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


@dataclass(frozen=True)
class Walk:
    """steps of PageRank that keep `damping` percent; each kind of seeds shares out `mass` units.

    A host is blocked if distrust is `num / den` or more of its trust and distrust together.  A host with
    more links than `hub` is dealt over several join keys.
    """

    steps: int = 20
    damping: int = 85
    mass: int = 1 << 50
    num: int = 1
    den: int = 2
    hub: int = 100_000


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Text of the longest rule that fits, else null; of equally long ones that of the longer host, then by text."""
    fits = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        same_site = (host == r.host) | host.endswith(F.lit("." + r.host))
        fits = F.when(same_site & path.startswith(F.lit(r.path)), F.lit(r.text)).otherwise(fits)
    return fits


def _verdict(rule: Column, rules: tuple[Rule, ...]) -> Column:
    return F.when(rule.isin(*(r.text for r in rules if r.verdict == "block")), "block").when(rule.isNotNull(), "allow")


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Distinct (src, dst) between different hosts: links of pages, and hosts with their parent domain both ways.

    pages: host, html; hosts: one row per host of the pages.  A parent domain counts if it has pages itself.
    """
    to = F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK_HOST), F.lit(1)))
    links = pages.where("host <> '' and html is not null").select(F.col("host").alias("src"), to.alias("dst"))
    links = links.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    child = hosts.where("instr(host, '.') > 0").select("host", F.expr("substr(host, instr(host, '.') + 1)").alias("parent"))
    family = child.join(hosts.select(F.col("host").alias("parent")), "parent")
    up = family.select(F.col("host").alias("src"), F.col("parent").alias("dst"))
    down = family.select(F.col("parent").alias("src"), F.col("host").alias("dst"))
    return links.unionByName(up).unionByName(down).where("src <> dst").distinct()


def spread(edges: DataFrame, seeds: DataFrame, walk: Walk = Walk()) -> DataFrame:
    """(host, trust, distrust) of the hosts that any rank reaches.

    edges: distinct src, dst; seeds: distinct host, verdict (allow or block).  A step gives each host its
    part of the seeds' mass and, of every neighbour before it, an equal share of damped rank; parts
    below one unit are dropped, and so is the rank of hosts without a way on.  One step is one join
    of ranks with links, and one sum.  While the ranks are few they are broadcast; beyond that they are
    shuffled, the links of a hub under several keys.
    """
    ways = edges.select(F.lit("allow").alias("kind"), "src", "dst")
    ways = ways.union(edges.select(F.lit("block"), F.col("dst"), F.col("src")))
    degree = ways.groupBy("kind", F.col("src").alias("host")).agg(F.count("*").alias("degree"))
    degree = materialize(degree.withColumn("size", F.col("degree")), "degrees")
    ways = with_values(ways.withColumnRenamed("src", "host"), degree, ["kind", "host"])
    slots = F.ceil(F.col("degree") / walk.hub).cast("long")
    slot = F.when(slots > 1, F.pmod(F.xxhash64("dst"), slots)).otherwise(F.lit(0).cast("long"))
    ways = materialize(ways.select("kind", "host", slot.alias("slot"), "dst"), "ways")

    n = {r.verdict: r.n for r in seeds.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    each = F.when(F.col("verdict") == "allow", walk.mass // max(n.get("allow", 0), 1)).otherwise(walk.mass // max(n.get("block", 0), 1))
    start = seeds.select(F.col("verdict").alias("kind"), "host", each.cast("long").alias("seed"), F.lit(0).cast("long").alias("degree"))
    nodes = degree.select("kind", "host", F.lit(0).cast("long").alias("seed"), "degree")
    nodes = nodes.union(start).groupBy("kind", "host").agg(F.sum("seed").alias("seed"), F.max("degree").alias("degree"))
    nodes = materialize(nodes, "nodes")
    few = nodes.count() <= BROADCAST_IDS

    back = F.expr(f"seed * {100 - walk.damping} div 100")
    ranks = nodes.select("kind", "host", F.col("seed").alias("rank"), "degree")
    for step in range(walk.steps):
        given = ranks.where("degree > 0").select("kind", "host", F.expr(f"rank * {walk.damping} div (100 * degree)").alias("share"), slots.alias("slots"))
        given = given.where("share > 0")
        if few:
            passed = ways.join(F.broadcast(given.drop("slots")), ["kind", "host"])
        else:
            dealt = given.select("kind", "host", "share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"))
            passed = ways.join(dealt, ["kind", "host", "slot"])
        passed = passed.select("kind", F.col("dst").alias("host"), F.col("share").alias("rank"), F.lit(0).cast("long").alias("degree"))
        kept = nodes.select("kind", "host", back.alias("rank"), "degree")
        ranks = kept.unionByName(passed).groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.max("degree").alias("degree"))
        ranks = materialize(ranks, f"ranks{step}")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0))
    return ranks.where("rank > 0").groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust"))


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, walk: Walk = Walk(), id_col: str = "page_id") -> DataFrame:
    """One row per row of `pages` (id, url, html): id, host, path, rule, verdict, trust, distrust.

    A rule decides alone where one fits, else the host's ranks do; hosts that no rank reaches are
    allowed.  A URL that is null or has no `://` has an empty host and path and is allowed; a null html has
    no links.  Hosts with as many allowed as blocked pages are no seeds.  Repeated rows and ids are
    judged alike; repeated links count once.  Other columns are ignored.
    """
    url = F.col("url")
    parsed = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), "html")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    known = parsed.select("id", "host", "path", rule.alias("rule"), _verdict(rule, rules).alias("verdict"))
    is_ = lambda v: F.sum((F.col("verdict") == v).cast("long"))
    hosts = known.where("host <> ''").groupBy("host").agg(F.count("*").alias("size"), is_("allow").alias("allowed"), is_("block").alias("blocked"))
    hosts = materialize(hosts, "hosts")
    edges = materialize(host_edges(parsed.select("host", "html"), hosts), "edges")
    seeds = hosts.where("allowed is distinct from blocked and coalesce(allowed, blocked) is not null")
    seeds = seeds.select("host", F.when(F.col("allowed") > F.col("blocked"), "allow").otherwise("block").alias("verdict"))
    ranks = spread(edges, seeds, walk)
    ranked = materialize(hosts.select("host", "size").join(ranks, "host"), "ranked")
    bad = (F.col("distrust") > 0) & (F.col("distrust") * walk.den >= F.expr("trust + distrust") * walk.num)
    out = with_values(known, ranked, ["host"]).withColumns({k: F.coalesce(k, F.lit(0).cast("long")) for k in ("trust", "distrust")})
    verdict = F.coalesce("verdict", F.when(bad, "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
