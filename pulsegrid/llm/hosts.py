"""URL filtering by rules and by empirical-Bayes reputation of hosts, in DataFrame functions only.

Pages with a known outcome (bad or not) vote for their host. Few votes are shrunk: the rate of a suffix towards
that of all pages, the rate of a registered domain towards its suffix, that of a host towards its domain, each
with a beta prior whose strength is fitted to how much the rates of that level differ (the beta-binomial's
moments), in which the uncertainty of all levels above adds up. A host is blocked when its domain has votes and the
lower bound of its posterior rate of bad pages exceeds a threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import saved

#: suffixes of two labels under which names are registered
TWO_LABELS = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ne.jp",
              "com.br", "com.cn", "com.mx", "co.in", "co.za", "com.tr", "com.ar")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def with_domains(rows: DataFrame) -> DataFrame:
    """Adds ``domain`` (what was registered) and ``suffix`` to rows with ``host``; user and port are left out.
    An IPv4 address is its own domain and suffix."""
    name = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    rows = rows.withColumn("_name", name).withColumn("_label", F.split("_name", r"\."))
    two, size = F.array_join(F.slice("_label", -2, 2), "."), F.size("_label")
    long = F.when((size >= 2) & two.isin(*TWO_LABELS), 2).otherwise(1)
    whole = F.col("_name").rlike(r"^[0-9]+(\.[0-9]+){3}$") | (size < 2)
    rows = rows.withColumn("_long", long).withColumn(
        "suffix", F.when(whole, F.col("_name")).when(F.col("_long") == 2, two).otherwise(F.element_at("_label", -1)))
    take = F.least(size, F.col("_long") + 1)
    return rows.withColumn("domain", F.when(whole, F.col("_name")).otherwise(
        F.array_join(F.slice("_label", size - take + 1, take), "."))).drop("_name", "_label", "_long")


def _strength(level: DataFrame, least: float = 1.0, most: float = 1000.0) -> float:
    """Prior size in pages from rows with votes ``n``, bad ones ``b`` and the parent's rate ``mu``."""
    spread = ((F.col("b") - F.col("n") * F.col("mu")) ** 2) / (F.col("mu") * (1 - F.col("mu")))
    r = level.where("n > 0").agg(F.sum(spread).alias("s"), F.sum("n").alias("n"),
                                 F.sum(F.col("n") * (F.col("n") - 1)).alias("p")).first()
    if not r.p:
        return 10.0
    share = (r.s - r.n) / r.p
    return most if share <= 1 / (most + 1) else max(least, 1 / share - 1)


def reputation(votes: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, n, b, near, rate, bound) from rows (host, outcome: 1 bad, 0 good, null unknown): votes, bad votes, votes
    of the whole domain, posterior mean and its lower bound (``z`` standard deviations) of the rate of bad pages.

    What is not known of a level is not known of those below it: a child's prior has its parent's mean, and a variance
    that is the parent's own plus that between the children of a parent. As a beta prior, that is one of fewer pages.
    """
    by_host = saved(with_domains(votes.groupBy("host").agg(F.count("outcome").alias("n"), F.coalesce(
        F.sum("outcome"), F.lit(0)).alias("b"))), "votes")
    total = by_host.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    mean = ((total.b or 0) + 0.5) / ((total.n or 0) + 1)
    above = None
    for level, parent in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        rows = by_host.groupBy(*([level] if parent is None else [level, parent])).agg(
            F.sum("n").alias("n"), F.sum("b").alias("b"))
        rows = (rows.withColumns({"mu": F.lit(mean), "var": F.lit(mean * (1 - mean) / ((total.n or 0) + 2)), "near": F.col("n")})
                if parent is None else rows.join(above, parent))
        spread = F.col("mu") * (1 - F.col("mu"))
        size = F.greatest(spread / (spread / (_strength(rows) + 1) + F.col("var")) - 1, F.lit(0.01))
        rate = (F.col("b") + F.col("size") * F.col("mu")) / (F.col("n") + F.col("size"))
        rows = rows.withColumn("size", size).withColumn("rate", rate).withColumn(
            "var", F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("size") + 1))
        above = rows.select(level, F.col("rate").alias("mu"), "var", F.col("n").alias("near"))
    return rows.select("host", "n", "b", "near", "rate", (F.col("rate") - z * F.sqrt("var")).alias("bound"))


def ruled(rows: DataFrame, rules: list[tuple[str, str, str]], literal: int = 1_000) -> DataFrame:
    """Adds ``rule`` (host and path of the longest rule that fits, else null) and ``decision`` to rows with
    ``host`` and ``path``. A rule (decision, host, path) fits its host and subdomains when the path starts with
    its path. Up to ``literal`` rules stand in the plan; more are joined on the host and its parents."""
    if not rules:
        return rows.withColumn("rule", F.lit(None).cast("string")).withColumn("decision", F.lit(None).cast("string"))
    if len(rules) <= literal:
        held = F.array(*[F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(d).alias("decision"),
                                  F.lit(h).alias("h"), F.lit(p).alias("p")) for d, h, p in rules])
        fit = F.filter(held, lambda r: ((F.col("host") == r["h"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["h"])))
                       & F.startswith(F.col("path"), r["p"]))
        best = F.array_max(F.transform(fit, lambda r: F.struct(r["size"], r["rule"], r["decision"])))
        return rows.withColumn("_best", best).withColumn("rule", F.col("_best.rule")).withColumn(
            "decision", F.col("_best.decision")).drop("_best")
    table = rows.sparkSession.createDataFrame([(d, h, p, h + p) for d, h, p in rules],
                                              "decision string, h string, p string, rule string")
    known = rows.select("host", "path").distinct()
    label = F.split("host", r"\.")
    chains = known.withColumn("h", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(label)), lambda i: F.array_join(F.slice(label, i, F.size(label)), "."))))
    best = (chains.join(table, "h").where(F.startswith(F.col("path"), F.col("p"))).groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("size"), "rule", "decision")).alias("m"))
            .select("host", "path", "m.rule", "m.decision"))
    return rows.join(best, ["host", "path"], "left")


def filtered(pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url",
             outcome: Column | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``pages``: key, ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    A rule's decision stands; other pages are blocked when their host's bound exceeds ``threshold`` and its domain has
    votes; a host about whose domain nothing is known is allowed. ``outcome``
    (1 bad, 0 good, null unknown) labels pages; by default the rules' decisions are the labels. A null url or
    one without ``://`` has empty host and path and is judged like any other host. Other columns are ignored.
    """
    host, path = parts(F.col(url).cast("string"))
    label = F.lit(None).cast("int") if outcome is None else outcome.cast("int")
    rows = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"), label.alias("given"))
    rows = ruled(rows, rules)
    own = F.when(F.col("decision") == "block", 1).when(F.col("decision") == "allow", 0)
    votes = rows.select("host", (own if outcome is None else F.col("given")).alias("outcome"))
    bad = reputation(votes).select("host", ((F.col("bound") > threshold) & (F.col("near") > 0)).alias("bad"))
    out = rows.join(bad, "host", "left")
    return out.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce(
        "decision", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))
