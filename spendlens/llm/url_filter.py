"""URL filter: host and path rules, and for pages no rule fits, link-graph propagation.

Host edges come from the pages' links: an absolute (or ``//``) link is an edge from the page's
host to the link's host, weighted by the pages that have it; links within a host are no edges.
Two random walks with restart run over these edges in Spark (personalised PageRank): *trust*
starts at the hosts of pages that a rule allows and follows links; *distrust* starts at the hosts
of blocked pages and follows links backwards, so it reaches the hosts that link to them. Both are
in units of pages: a seed host starts with as many as a rule judged there, and mass at a host
without edges goes back to the seeds. A host is blocked if its distrust is above its trust and is
at least ``THRESHOLD`` of its pages; its pages that no rule fits take that verdict.

Built-in expressions and joins only. The link scan is one projection; edges and pages are counted
map-side before they are shuffled, so a host with a third of all pages costs a row a task; each
step of the walk is a join on the source host and a sum by the target host, and is written to the
shared folder. The walks go on until at most ``TOLERANCE`` pages are on their way; each step moves
at most ``DAMPING`` times what the one before it did, which bounds their number by the logarithm of the
seeds (``steps_needed``), and what is still to come by some six times the tolerance. A host's trust and
distrust are compared in whole ``GRAIN``s, so that the order of sums cannot flip a tie. Nothing of the
graph reaches the driver but a sum a step.

Defined results: a null url, or one without ``://``, has an empty host and path, which no rule
fits; its pages are one (empty) host, which never has edges and is allowed; a null html has no
links; repeated pages count as often as they occur, and a page counts once for each host that it links to,
however it spells the host; a very long html is one value like any other; a host whose distrust
equals its trust is allowed; without seeds every unruled page is allowed; columns other than the three
named may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import written

THRESHOLD = 0.5
DAMPING = 0.85
#: pages that a step of a walk may still move when it ends, and the grain in which walks are compared
TOLERANCE = 1e-3
GRAIN = 1e-2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i:href|src)\s*=\s*["']?\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and all its subdomains where the url's path starts with the path."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def rule_for(rules: tuple[Rule, ...], host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.rule), r.verdict == "block", r.rule)):
        out = F.when(r.fits(host, path), F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(judged: DataFrame, html_col: str) -> DataFrame:
    """(src, dst, pages): pages of host src that link to another host dst, however often and in whatever spelling."""
    found = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK), 1)
    hosts = F.transform(found, lambda to: F.regexp_replace(lower_ascii(to), r"^.*@|:\d*$", ""))
    links = judged.select(F.col("_host").alias("src"), F.explode(F.array_distinct(hosts)).alias("dst"))
    edges = links.where("src != '' AND dst != '' AND src != dst")
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("pages"))


def steps_needed(mass: float, damping: float, tolerance: float) -> int:
    """Steps after which at most ``tolerance`` of this mass is still on its way: each keeps ``damping`` of it at most."""
    return max(1, math.ceil(math.log(tolerance / max(mass, tolerance), damping)) + 1)


def propagate(
    edges: DataFrame, hosts: DataFrame, *, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """``hosts`` (host, trusted, blocked: seed pages) with trust and distrust, in pages.

    A walk with restart visits each host in proportion to what its seeds send there along paths of every length,
    a step passing ``damping`` on. So each step sends on what the last one moved, the sums of all steps are the walk, and
    one factor at the end keeps its mass (what stops by chance or at a host without edges has
    started again at the seeds). Both walks step together: ``walk`` tells their rows apart, and distrust has
    its edges turned.
    """
    scratch = Scratch(edges.sparkSession)
    both = edges.selectExpr("'trust' AS walk", "src", "dst", "CAST(pages AS double) AS pages").union(
        edges.selectExpr("'distrust'", "dst", "src", "CAST(pages AS double)")
    )
    out = both.groupBy("walk", "src").agg(F.sum("pages").alias("out"))
    moves = both.join(out, ["walk", "src"]).selectExpr("walk", "src AS host", "dst", "pages / out AS share")
    moves = scratch.write(moves, "moves")
    named = hosts.select("host").union(edges.select("src")).union(edges.select("dst")).distinct()
    seeds = hosts.selectExpr(
        "host", "stack(2, 'trust', CAST(trusted AS double), 'distrust', CAST(blocked AS double)) AS (walk, mass)"
    )
    term = scratch.write(seeds.where("mass > 0").select("walk", "host", "mass"), "step-0")
    total = {r["walk"]: r["m"] for r in term.groupBy("walk").agg(F.sum("mass").alias("m")).collect()}
    steps = 0 if moves.isEmpty() else steps_needed(sum(total.values()), damping, tolerance)
    for n in range(1, steps + 1):
        sent = term.join(moves, ["walk", "host"]).groupBy("walk", "dst").agg((F.sum(F.col("mass") * F.col("share")) * damping).alias("mass"))
        term = scratch.write(sent.selectExpr("walk", "dst AS host", "mass"), f"step-{n}")
        left = term.agg(F.sum("mass")).first()[0] or 0.0
        if left <= tolerance:
            break
    else:
        if steps:
            raise RuntimeError(f"{left} pages are still on their way: the edges are not shares of their hosts")
        n = 0
    paths = [scratch.path(f"step-{k}") for k in range(n + 1)]
    visits = edges.sparkSession.read.schema(term.schema).parquet(*paths).groupBy("walk", "host").agg(F.sum("mass").alias("mass"))
    mass = {r["walk"]: r["m"] for r in visits.groupBy("walk").agg(F.sum("mass").alias("m")).collect()}

    def rank(walk: str) -> Column:
        factor = total[walk] / mass[walk] if walk in mass else 0.0
        return F.coalesce(F.sum(F.expr(f"if(walk = '{walk}', mass, 0d)")), F.lit(0.0)) * factor

    ranked = visits.groupBy("host").agg(rank("trust").alias("trust"), rank("distrust").alias("distrust"))
    return named.join(ranked, "host", "left").na.fill(0.0, ["trust", "distrust"])


def filter_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per page row: id, host, path, rule (null if none fits), verdict ("allow" or "block")."""
    base = pages.select(
        F.col(f"`{id_col}`").alias("_id"),
        host_of(F.col(f"`{url_col}`")).alias("_host"),
        path_of(F.col(f"`{url_col}`")).alias("_path"),
        F.col(f"`{html_col}`").alias("_html"),
    )
    judged = base.withColumn("_rule", rule_for(rules, F.col("_host"), F.col("_path")))
    hosts = judged.groupBy(F.col("_host").alias("host")).agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("_rule.verdict") == "allow").alias("trusted"),
        F.count_if(F.col("_rule.verdict") == "block").alias("blocked"),
    )
    hosts = written(hosts, "hosts")
    edges = written(host_edges(judged, "_html"), "edges")
    scores = propagate(edges, hosts.where("host != ''").select("host", "trusted", "blocked"))
    bad = written(
        hosts.join(scores, "host")
        .withColumns({walk: F.round(F.col(walk) / GRAIN) for walk in ("trust", "distrust")})
        .where((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= F.round(F.col("pages") * threshold / GRAIN)))
        .select(F.col("host").alias("_bad")),
        "bad-hosts",
    )
    # only pages without a rule need their host's verdict
    return judged.drop("_html").join(bad, F.col("_host") == F.col("_bad"), "left").select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce(
            F.col("_rule.verdict"), F.when(F.col("_bad").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
    )
