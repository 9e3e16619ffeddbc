"""URL filters: longest-prefix rules, and trust that flows along links between hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.llm.common import LOWER, UPPER, joined
from cinderpost.operators.lookup import BROADCAST_BYTES, measured_bytes
from cinderpost.session import discard, stage

# Scores are settled when a round changes them by less than this in all; more rounds than
# MOST_ROUNDS mean that they never will be.
TOLERANCE = 1e-9
MOST_ROUNDS = 400
CHECK_EVERY = 4
# Distrust above the threshold by less than this share of the trust doesn't block.
MARGIN = 1e-6

HREF = r"""(?i:<a\s[^>]*?\bhref)\s*=\s*["']?([^"'\s>]+)"""
Rule = tuple[str, str, str]


def url_host(url: str | Column) -> Column:
    """From after the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: str) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule whose host and path prefix fit; null if none does.

    Rules are (verdict, host, path); a handful, compared one after the other, longest first.
    """
    out = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        hit = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _parent(host: Column) -> Column:
    """The host without its first label, if at least two labels are left."""
    rest = F.regexp_extract(host, r"^[^.]+\.(.+\..+)$", 1)
    return F.nullif(rest, F.lit(""))


def host_edges(pages: DataFrame) -> DataFrame:
    """Edges between hosts with weights: src, dst, weight.

    A link counts once per page and linked host; links without a host stay on their page's
    host. Each host also has one link to its parent domain and back, since owners of a domain
    answer for its subdomains. Edges are summed before they are shuffled.
    """
    links = stage(
        pages.select(
            F.col("host").alias("src"),
            F.explode_outer(
                F.array_distinct(
                    F.transform(
                        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), F.lit(1)),
                        lambda h: url_host(F.regexp_replace(h, r"^//", "http://")),
                    )
                )
            ).alias("_to"),
        )
        .filter(F.col("_to").isNotNull())
        .select("src", F.when(F.col("_to") == "", F.col("src")).otherwise(F.col("_to")).alias("dst"))
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight")),
        "host-links",
    )
    hosts = links.select("src").union(links.select("dst")).union(pages.select("host")).distinct()
    up = hosts.select("src", _parent(F.col("src")).alias("dst")).filter("dst IS NOT NULL")
    tree = up.union(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return (
        links.union(tree.distinct().withColumn("weight", F.lit(1.0)))
        .filter((F.col("src") != "") & (F.col("dst") != ""))
        .groupBy("src", "dst")
        .agg(F.sum("weight").alias("weight"))
    )


def propagate(
    edges: DataFrame,
    seeds: DataFrame,
    damping: float = 0.85,
    rounds: int | None = None,
    tolerance: float = TOLERANCE,
    most_rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """Trust along the edges and distrust against them: host, trust, distrust.

    Two personalised PageRanks in the same rounds. ``seeds`` holds host, trust, distrust; each
    kind sums to one or is all zero. A host without outgoing edges keeps what reaches it.

    Rounds go on until one changes the scores of all hosts together by less than ``tolerance``;
    what is still on its way then is at most damping / (1 - damping) times that. No such round
    among ``most_rounds`` is an error. With ``rounds`` there are just so many, settled or not.

    Each round is one join of the edges with the scores and one aggregation, partly done before
    its shuffle; its result is written, so a lost executor costs no more than the round. Every
    CHECK_EVERY rounds the scores before are written with them, and the change is a sum over these.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("n"))
    back = edges.groupBy("dst").agg(F.sum("weight").alias("n"))
    forth = edges.join(out, "src").select(
        F.col("src").alias("host"), F.col("dst").alias("to"), (F.col("weight") / F.col("n")).alias("t"), F.lit(0.0).alias("d")
    )
    reverse = edges.join(back, "dst").select(
        F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(0.0).alias("t"), (F.col("weight") / F.col("n")).alias("d")
    )
    flow = stage(
        forth.unionByName(reverse).groupBy("host", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d")),
        "flow",
    )
    start = seeds.select("host", F.col("trust").alias("_t"), F.col("distrust").alias("_d"))
    # Every round scores some of the same hosts, so their bytes are counted once.
    hosts = flow.select(F.col("to").alias("host")).union(seeds.select("host")).distinct()
    small = measured_bytes(hosts.withColumns({"trust": F.lit(0.0), "distrust": F.lit(0.0)})) <= BROADCAST_BYTES
    old, none = ("_trust", "_distrust"), {"_trust": F.lit(0.0), "_distrust": F.lit(0.0)}
    sums = [F.sum(c).alias(c) for c in ("trust", "distrust", *old)]
    change = F.sum(F.abs(F.col("trust") - F.col("_trust")) + F.abs(F.col("distrust") - F.col("_distrust")))
    scores = stage(seeds, "scores")
    done = 0
    while rounds is None or done < rounds:
        if rounds is None and done >= most_rounds:
            raise RuntimeError(f"scores of hosts are not settled after {most_rounds} rounds")
        moved = flow.join(F.broadcast(scores) if small else scores, "host").select(
            F.col("to").alias("host"),
            (F.col("trust") * F.col("t") * damping).alias("trust"),
            (F.col("distrust") * F.col("d") * damping).alias("distrust"),
        )
        given = start.select(
            "host", (F.col("_t") * (1 - damping)).alias("trust"), (F.col("_d") * (1 - damping)).alias("distrust")
        )
        sent = moved.unionByName(given)
        done += 1
        if rounds is not None or done % CHECK_EVERY:
            after = stage(sent.groupBy("host").agg(*sums[:2]), "scores")
            discard(scores)
            scores = after
            continue
        before = scores.select("host", *[F.lit(0.0).alias(c[1:]) for c in old], *[F.col(c[1:]).alias(c) for c in old])
        after = stage(sent.withColumns(none).unionByName(before).groupBy("host").agg(*sums), "scores")
        discard(scores)
        scores = after.drop(*old)
        scores._stage_path = after._stage_path
        if (after.agg(change).first()[0] or 0.0) < tolerance:
            break
    discard(flow)
    return scores


def judge(pages: DataFrame, rules: Sequence[Rule], threshold: float = 1.0, rounds: int | None = None) -> DataFrame:
    """Verdict on every page: the longest rule's, else its host's by propagated trust.

    Seeds are the hosts of pages under rules: a host has the share of all allowed pages as trust
    and the share of all blocked pages as distrust. A host is blocked if its distrust is above
    ``threshold`` times its trust by more than MARGIN; a host that nothing reaches is allowed.
    Scores are settled, unless ``rounds`` are given.

    Null urls and urls without :// have empty host and path, fit no rule and are allowed, as the
    empty host takes no part in the graph. Null html has no links. Equal rows give equal rows;
    columns named like the result's are replaced.
    """
    host, path = url_host("url"), url_path("url")
    judged = stage(
        pages.select(
            "page_id", host.alias("host"), path.alias("path"), longest_rule(host, path, rules).alias("_hit")
        ),
        "judged-urls",
    )
    edges = stage(host_edges(pages.select(host.alias("host"), "html")), "host-edges")
    counts = judged.filter("_hit IS NOT NULL AND host != ''").groupBy("host").agg(
        F.count_if(F.col("_hit.verdict") == "allow").alias("a"), F.count_if(F.col("_hit.verdict") == "block").alias("b")
    )
    counts = stage(counts, "seed-counts")
    total = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    seeds = counts.select(
        "host",
        (F.col("a") / F.lit(float(total["a"] or 1))).alias("trust"),
        (F.col("b") / F.lit(float(total["b"] or 1))).alias("distrust"),
    )
    scores = propagate(edges, seeds, rounds=rounds)
    # Sums of doubles depend on the order of their rows; so near the threshold they count as on it.
    most = threshold * (1 + MARGIN) * F.coalesce("trust", F.lit(0.0))
    by_method = F.when(F.coalesce("distrust", F.lit(0.0)) > most, "block").otherwise("allow")
    return joined(judged, scores, "host").select(
        "page_id",
        "host",
        "path",
        F.col("_hit.rule").alias("rule"),
        F.coalesce("_hit.verdict", by_method).alias("verdict"),
        F.round(F.coalesce("trust", F.lit(0.0)), 9).alias("trust"),
        F.round(F.coalesce("distrust", F.lit(0.0)), 9).alias("distrust"),
    )
