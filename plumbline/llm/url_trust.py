"""URL filter by rules and by trust that spreads over the link graph of hosts.

Rules decide first: a rule fits its host and all subdomains where the path starts
with the rule's; the longest fitting one wins.  For all other urls the host
decides.  Hosts are linked where a page of one has a link to the other; an edge
weighs as many links as there are.  Trust is a personalised PageRank from the
hosts of allowed pages, in the direction of the links; distrust one from the
hosts of blocked pages against it, so that who links to distrusted hosts is
distrusted.  Seeds weigh by their pages; what ends at a host without links
returns to the seeds.  A host is blocked when its distrust exceeds `margin` times
its trust, and allowed otherwise.

DataFrame functions only.  Links are summed by pair of hosts before they move.
Ranks are stored each round, until they change by less
than the tolerance; two sums come back to the driver.  Verdicts go back
to pages by a lookup that broadcasts the answers of a bounded number of hot hosts.

Defined results: a null url, or one without `://`, has empty host and path, fits
no rule and is allowed.  Null html has no links.  Ids may be null or repeated; each
row is judged.  Without seeds all ranks are 0.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored
from plumbline.operators.lookup import bounded_answers, heavy_keys, lookup

#: (verdict, host, path)
Rule = tuple[str, str, str]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\shref\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct with its verdict; null if none does."""
    found = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    return F.greatest(*found, F.lit(None).cast("struct<size:int,rule:string,verdict:string>"))


def host_links(pages: DataFrame) -> DataFrame:
    """(a, b, n): links from pages of host a to host b, other than itself."""
    own = pages.select(host_of(F.col("url")).alias("a"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), 1)).alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    to = own.where(full.rlike(r"\A(?i)(https?:)?//")).select("a", host_of(full).alias("b"))
    return to.where("a <> b and a <> '' and b <> ''").groupBy("a", "b").agg(F.count("*").alias("n"))


def spread(seeds: DataFrame, links: DataFrame, damping: float, rounds: int | None, tolerance: float) -> DataFrame:
    """(kind, host, rank) from seeds (kind, host, seed), which sum to 1 in each kind, over links (kind, a, b, n).

    A round shrinks the change of a kind, at most 2 at first, by the damping, so without
    `rounds` the tolerance is reached after a number of rounds that is known before.
    """
    most = rounds if rounds is not None else 2 + math.ceil(math.log(tolerance / 4) / math.log(damping))
    out = links.groupBy("kind", "a").agg(F.sum("n").alias("out"))
    edges = stored(
        links.join(out, ["kind", "a"]).select("kind", F.col("a").alias("host"), "b", (F.col("n") / F.col("out")).alias("p"))
    )
    seeds = stored(seeds)
    ranks = seeds.select("kind", "host", F.col("seed").alias("rank"))
    for _ in range(most):
        flow = stored(
            ranks.join(edges, ["kind", "host"])
            .groupBy("kind", F.col("b").alias("host"))
            .agg(F.sum(F.col("rank") * F.col("p")).alias("flow"))
        )
        moved = {r["kind"]: r["s"] for r in flow.groupBy("kind").agg(F.sum("flow").alias("s")).collect()}
        back = F.when(F.col("kind") == "trust", 1 - moved.get("trust", 0.0)).otherwise(1 - moved.get("distrust", 0.0))
        new = stored(
            seeds.join(flow, ["kind", "host"], "full").select(
                "kind",
                "host",
                (
                    (1 - damping + damping * back) * F.coalesce("seed", F.lit(0.0)) + damping * F.coalesce("flow", F.lit(0.0))
                ).alias("rank"),
            )
        )
        change = (
            new.join(ranks.withColumnRenamed("rank", "before"), ["kind", "host"], "full")
            .agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("before", F.lit(0.0)))))
            .first()[0]
        )
        ranks = new
        if (change or 0.0) < tolerance:
            break
    else:
        if rounds is None:
            raise RuntimeError(f"ranks did not settle in {most} rounds")
    return ranks


def judged(
    pages: DataFrame,
    rules: Sequence[Rule],
    damping: float = 0.85,
    rounds: int | None = None,
    tolerance: float = 1e-6,
    margin: float = 1.0,
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, trust, distrust."""
    url = F.col("url").cast("string")
    places = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = places.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    hosts = ruled.where("host <> ''").groupBy("host").agg(
        F.count(F.when(F.col("best.verdict") == "allow", 1)).alias("trust"),
        F.count(F.when(F.col("best.verdict") == "block", 1)).alias("distrust"),
    )
    seeds = hosts.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "n"))
    seeds = stored(seeds.where("n > 0"))
    total = {r["kind"]: r["n"] for r in seeds.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    share = F.col("n") / F.when(F.col("kind") == "trust", total.get("trust", 1)).otherwise(total.get("distrust", 1))
    links = stored(host_links(pages.select(url.alias("url"), F.col("html").cast("string").alias("html"))))
    both = links.select(F.lit("trust").alias("kind"), "a", "b", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("b").alias("a"), F.col("a").alias("b"), "n")
    )
    ranks = spread(seeds.select("kind", "host", share.alias("seed")), both, damping, rounds, tolerance)
    known = stored(
        ranks.groupBy("host").agg(
            F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("rank"))), F.lit(0.0)).alias("trust"),
            F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))), F.lit(0.0)).alias("distrust"),
        )
    )
    keys = ["host"]
    answers = bounded_answers(heavy_keys(places, keys), known, keys)
    found = lookup(ruled, known, keys, answers, "rank")
    trust, distrust = (F.coalesce(F.col(f"rank.{k}"), F.lit(0.0)) for k in ("trust", "distrust"))
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(distrust > margin * trust, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
