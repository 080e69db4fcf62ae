"""URL filters by rules and by trust that spreads over the host graph, in DataFrame functions only.

Rules decide the urls they fit. Hosts with pages that a rule allows are the trusted seeds, hosts with pages that a rule blocks the
distrusted ones, each in proportion to such pages. Trust is a personalised PageRank along the links, distrust one against them:
who links to a bad host is suspect. Both run as two columns of one table over one edge table. A host with more distrust than
trust is blocked for the urls that no rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.session import materialize

#: Rounds at least.
DAMPING, ROUNDS = 0.85, 12
#: Rounds between two written tables.
WRITTEN_EVERY = 4
#: The rounds end when no score of a host changes by a larger share of itself.
SETTLED = 1e-3
#: Distrust outweighs trust when it is larger by more than this share of it, which sums in another order don't reach.
MARGIN = 1e-9

_LINK = r"""(?i)\shref\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains, under a path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules_of(text: Sequence[str]) -> list[Rule]:
    """Rules such as ``block example.com/de/``."""
    found = []
    for line in text:
        verdict, _, place = line.partition(" ")
        host, slash, path = place.partition("/")
        if verdict not in ("allow", "block") or not slash:
            raise ValueError(f"not a rule: {line}")
        found.append(Rule(verdict, host, slash + path))
    return found


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as (text, verdict), or null; of equally long ones block goes first."""
    chosen = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def host_edges(pages: DataFrame) -> DataFrame:
    """Edges between hosts, (src, dst, weight): pages of src that link to dst, and one edge each way between a host and the domain above
    it (down to two labels), through which the hosts of one owner hang together."""
    rows = pages.select(host_of(F.col("url")).alias("src"), F.coalesce("html", F.lit("")).alias("html")).where("src <> ''")
    hosts = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)), lambda h: F.translate(h, _UPPER, _LOWER)))
    links = rows.select("src", F.explode(hosts).alias("dst")).where("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    links = materialize(links, "links")
    named = rows.select(F.col("src").alias("host")).distinct().union(links.select("dst")).distinct()
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(2), F.size(labels)), lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    chain = named.select(F.when(F.size(labels) > 2, above).alias("chain")).where("chain IS NOT NULL")
    pair = F.transform(F.sequence(F.lit(1), F.size("chain") - 1), lambda n: F.struct(F.element_at("chain", n).alias("upper"), F.element_at("chain", n + 1).alias("lower")))
    owned = chain.select(F.explode(pair).alias("pair")).select("pair.upper", "pair.lower").distinct()
    one = F.lit(1.0).alias("weight")
    edges = links.union(owned.select("upper", "lower", one)).union(owned.select("lower", "upper", one))
    return edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def host_seeds(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Shares of each host in all pages that a rule allows and in all that a rule blocks, (host, trust, distrust)."""
    rows = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = rows.withColumn("verdict", matching_rule(F.col("host"), F.col("path"), rules)["verdict"]).where("verdict IS NOT NULL")
    counts = materialize(ruled.groupBy("host").agg(F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked")), "seeds")
    total = counts.agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")).first()
    share = lambda name: (F.col(name) / F.lit(float(total[name] or 1))).cast("double")
    return counts.select("host", share("allowed").alias("trust"), share("blocked").alias("distrust"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` rounds from the seeds and as many more as it takes until no score changes by more than the share ``settled``
    in a round; a score that is reached first counts as such a change, so that every host that hangs together with a seed has its score, however far away.
    Mass that reaches a host without further edges ends there."""
    out = edges.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("total"))
    into = edges.groupBy(F.col("dst").alias("node")).agg(F.sum("weight").alias("total"))
    forward = edges.join(out, edges["src"] == out["node"]).select(F.col("src").alias("host"), F.col("dst").alias("to"), (F.col("weight") / F.col("total")).alias("f"), F.lit(0.0).alias("b"))
    backward = edges.join(into, edges["dst"] == into["node"]).select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(0.0).alias("f"), (F.col("weight") / F.col("total")).alias("b"))
    steps = materialize(forward.union(backward).groupBy("host", "to").agg(F.sum("f").alias("f"), F.sum("b").alias("b")), "steps")
    start = seeds.select("host", ((1 - damping) * F.col("trust")).alias("trust"), ((1 - damping) * F.col("distrust")).alias("distrust"))
    state = seeds.select("host", "trust", "distrust")
    n, change = 0, None
    while n < rounds or change > settled:
        n += 1
        moved = state.join(steps, "host").select(F.col("to").alias("host"), (damping * F.col("trust") * F.col("f")).alias("trust"), (damping * F.col("distrust") * F.col("b")).alias("distrust"))
        if n < rounds and n % WRITTEN_EVERY or n > rounds and (n - rounds) % WRITTEN_EVERY:
            state = moved.union(start).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
            continue
        # The scores of the round before come along, as the part ``old``.
        zero = F.lit(0.0)
        both = moved.union(start).select("*", zero.alias("old_trust"), zero.alias("old_distrust")).union(state.select("host", zero, zero, "trust", "distrust"))
        both = materialize(both.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("trust", "distrust", "old_trust", "old_distrust")]), "ranks")
        share = lambda c: F.when(F.col(c) != F.col(f"old_{c}"), F.abs(F.col(c) - F.col(f"old_{c}")) / F.greatest(c, f"old_{c}")).otherwise(0.0)
        change = both.agg(F.max(F.greatest(share("trust"), share("distrust")))).first()[0] or 0.0
        state = both.select("host", "trust", "distrust")
    return state


def verdicts_of(scores: DataFrame) -> DataFrame:
    """``scores`` with the verdict: block where distrust outweighs trust, however small both are."""
    bad = F.col("distrust") > F.col("trust") * (1 + MARGIN)
    return scores.withColumn("verdict", F.when(bad, "block").otherwise("allow"))


def host_verdicts(pages: DataFrame, rules: Sequence[Rule], rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust, verdict)."""
    return verdicts_of(propagate(materialize(host_edges(pages), "edges"), host_seeds(pages, rules), rounds, damping))


def judge(pages: DataFrame, rules: Sequence[Rule], rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html and any more columns): page_id, host, path, rule, verdict.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed, as is a host that nothing is known of. Null html has no
    links. Equally long rules: block first. Repeated rows are judged each, and count as pages each. Other columns are
    ignored; an empty table gives no rows.
    """
    hosts = host_verdicts(pages, rules, rounds, damping).select("host", F.col("verdict").alias("spread"))
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("rule.verdict"), F.col("spread"), F.lit("allow"))
    return urls.join(hosts, "host", "left").select("page_id", "host", "path", F.col("rule.text").alias("rule"), verdict.alias("verdict"))
