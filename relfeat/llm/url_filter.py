"""URL filters: explicit rules, and host reputation shrunk through beta-binomial priors.

Reputation of a host is the posterior of its rate of bad pages. Its prior is centred on the posterior mean of the
registered domain, whose prior is centred on that of the suffix, whose prior is centred on the rate of all labelled
pages. The weight of each prior is fitted on all labels by the moments of the beta-binomial distribution: the less
the hosts of a domain differ beyond chance, the more a host leans on its domain. A host without labelled pages has
no counts and leans on its domain alone, or on the suffix or all labelled pages where the domain has none either.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relfeat.llm.common import LOWER, UPPER, stored

# prior weights stay within these bounds: at most this much like one common rate, at least this much
WEIGHTS = (1.0, 10_000.0)
LEVELS = ("suffix", "domain", "host")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and the path up to ``?`` or ``#``; both empty without ``://``."""
    pattern = "://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (its text host + path) that fits, else NULL. ``rules``: a short list of (verdict, host/path)."""
    chosen = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(slash + rest)
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
    return chosen


def with_levels(hosts: DataFrame) -> DataFrame:
    """Adds ``domain``, the last two labels of ``host``, and ``suffix``, the last one."""
    registered = "CASE WHEN size(parts) > 1 THEN concat_ws('.', slice(parts, -2, 2)) ELSE host END AS domain"
    return hosts.withColumn("parts", F.split("host", "[.]")).selectExpr(*hosts.columns, registered, "element_at(parts, -1) AS suffix")


@dataclass
class Levels:
    """Posteriors of the labelled nodes of each level (keys, n, k, a, b, v), the weight of each level's prior, and the
    rate of all labelled pages. ``v`` and ``spread`` are variances that count what is uncertain above a node, too."""

    nodes: dict[str, DataFrame]
    weights: dict[str, float]
    overall: float | None
    spread: float


def posterior_levels(outcomes: DataFrame) -> Levels:
    """Levels are built from counts per host, never from pages; all tables after that have one row per host at most."""
    counted = outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("k"))
    hosts = stored(with_levels(counted), "host-outcomes")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    n, k = total.n or 0, total.k or 0
    out = Levels({}, {}, k / n if n else None, (k + 1) * (n - k + 1) / ((n + 2) ** 2 * (n + 3)))
    means = None
    for i, level in enumerate(LEVELS):
        keys = list(LEVELS[: i + 1])[::-1]
        counts = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        if means is None:
            nodes = counts.withColumns({"p": F.lit(float(out.overall or 0.0)), "above": F.lit(out.spread)})
        else:
            nodes = counts.join(means, keys[1:])
        weight = out.weights[level] = prior_weight(nodes)
        a, b = F.col("p") * weight + F.col("k"), (1 - F.col("p")) * weight + F.col("n") - F.col("k")
        v = a * b / (F.pow(a + b, 2) * (a + b + 1)) + F.pow(weight / (F.col("n") + weight), 2) * F.col("above")
        nodes = stored(nodes.select(*keys, "n", "k", a.alias("a"), b.alias("b"), v.alias("v")), f"reputation-{level}")
        out.nodes[level] = nodes
        means = nodes.selectExpr(*keys, "a / (a + b) AS p", "v AS above")
    return out


def labelled_hosts(levels: Levels) -> DataFrame:
    sd = F.sqrt(F.col("a") * F.col("b") / (F.pow(F.col("a") + F.col("b"), 2) * (F.col("a") + F.col("b") + 1)))
    return levels.nodes["host"].select("host", "n", F.col("k").alias("bad"), F.expr("a / (a + b)").alias("mean"), sd.alias("sd"))


def reputation(outcomes: DataFrame) -> DataFrame:
    """One row per host of ``outcomes`` (host, bad 0/1): host, n, bad, mean, sd of the posterior rate of bad pages."""
    return labelled_hosts(posterior_levels(outcomes))


def every_reputation(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """``host, mean, sd`` of each of ``hosts`` (distinct ``host``), labelled or not; NULL when nothing is labelled.

    A host without labels has the posterior mean of its domain, else of its suffix, else the rate of all labelled
    pages. Its variance is that of the prior of each level without labels, and that of the posterior these stand on.
    """
    levels = posterior_levels(outcomes)
    known = labelled_hosts(levels).select("host", F.col("mean").alias("host_p"), F.col("sd").alias("host_sd"))
    found = with_levels(hosts).join(known, "host", "left")
    mean, v = F.lit(levels.overall).cast("double"), F.lit(levels.spread)
    for level in LEVELS[:-1]:
        keys = ["domain", "suffix"] if level == "domain" else ["suffix"]
        nodes = levels.nodes[level].selectExpr(*keys, f"a / (a + b) AS {level}_p", f"v AS {level}_v")
        found = found.join(nodes, keys, "left")
        v = F.coalesce(F.col(f"{level}_v"), mean * (1 - mean) / (levels.weights[level] + 1) + v)
        mean = F.coalesce(F.col(f"{level}_p"), mean)
    v = mean * (1 - mean) / (levels.weights["host"] + 1) + v
    return found.select("host", F.coalesce("host_p", mean).alias("mean"), F.coalesce("host_sd", F.sqrt(v)).alias("sd"))


def prior_weight(nodes: DataFrame) -> float:
    """Fit a + b of the prior from (n, k, p): spread of k/n around p against what chance alone gives."""
    row = nodes.selectExpr(
        "sum(n * pow(k / n - p, 2) / nullif(p * (1 - p), 0)) AS s", "count(1) AS m", "sum(n) AS n", "sum(n * n) AS nn"
    ).first()
    if not row.n or row.s is None:
        return WEIGHTS[1]
    free = row.n - row.nn / row.n - (row.m - 1)
    rho = (row.s - (row.m - 1)) / free if free > 0 else 0.0
    return min(max(1 / rho - 1, WEIGHTS[0]), WEIGHTS[1]) if rho > 0 else WEIGHTS[1]


def url_filter(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]],
    max_bad_rate: float = 0.3,
    z: float = 1.645,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, bad_rate, bad_at_least.

    ``outcomes``: ids of labelled pages with ``bad`` (0, 1 or NULL: no label). A page that no rule decides is blocked
    when the lower posterior bound ``mean - z * sd`` of its host's bad rate exceeds ``max_bad_rate``; a host without
    labelled pages is judged by its domain, suffix or all labelled pages. Without any label all is allowed (bounds are
    NULL). Equal rows stay apart; NULL urls have an empty host and no rule.
    """
    host, path = host_and_path(F.col(f"`{url_col}`"))
    parsed = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    labelled = outcomes.where("bad IS NOT NULL").select(F.col("page_id").cast("long").alias("page_id"), "bad")
    known = parsed.join(labelled, "page_id").select("host", F.col("bad").cast("long").alias("bad"))
    known = stored(every_reputation(known, parsed.select("host").distinct()), "reputation")
    known = known.select("host", F.col("mean").alias("bad_rate"), F.expr(f"mean - {z}D * sd").alias("bad_at_least"))
    judged = parsed.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules)).join(known, "host", "left")
    verdict = F.when(F.coalesce(F.col("bad_at_least") > max_bad_rate, F.lit(False)), "block").otherwise("allow")
    for decision, rule in rules:
        verdict = F.when(F.col("rule") == rule, decision).otherwise(verdict)
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "bad_rate", "bad_at_least")
