"""URL filter: rules by host and path, and empirical-Bayes reputations of hosts where no rule fits.

Labelled pages are counted by host. The share of good pages of a host is shrunk towards that of its
registered domain, this towards that of its suffix, this towards that of all pages: beta priors whose mean is the
parent's posterior mean and whose weight is estimated by moments from how much the children differ beyond chance.
A host is blocked if its share of good pages lies below the limit with near certainty.

Only DataFrame functions: counts are summed before they are shuffled, joins are on host, domain and suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerhouse.llm.common import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels, below which one registers (fixed values).
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "co.nz", "com.br", "co.in", "co.za")
#: Bounds of the correlation between the pages of a host.
LEAST_RHO, MOST_RHO = 0.01, 0.9


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """The last label, or the last two of a known suffix; and one label more. An address of digits is its own domain."""
    bare = F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*$", "")
    two, three = F.substring_index(bare, ".", -2), F.substring_index(bare, ".", -3)
    long = two.isin(*LONG_SUFFIXES) & (bare != two)
    number = bare.rlike(r"^[0-9.]+$")
    suffix = F.when(number, "").when(long, two).otherwise(F.substring_index(bare, ".", -1))
    return suffix, F.when(number, bare).when(long, three).otherwise(two)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest (verdict, rule host, rule path) that fits; null if none does.

    Of rules of one length the one with the longer host wins, then block. The rules are a list held by the
    caller, so they are part of the plan; no join.
    """
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    ranked = sorted({(v, h, p) for v, h, p in rules}, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r[1:]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ranked]
    chain = F.when(fits[0], F.struct(F.lit(ranked[0][1] + ranked[0][2]).alias("rule"), F.lit(ranked[0][0]).alias("verdict")))
    for fit, (verdict, h, p) in zip(fits[1:], ranked[1:]):
        chain = chain.when(fit, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
    return chain


def _weight(children: DataFrame) -> DataFrame:
    """One row (weight): the prior's weight in pages, from rows (good, n, mean) with the parent's mean."""
    v = F.col("mean") * (1 - F.col("mean"))
    s = F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("mean"), F.lit(2)))
    more = F.sum(v * (F.col("n") - 1))
    rho = F.when(more > 0, (s - F.sum(v)) / more).otherwise(F.lit(LEAST_RHO))
    rho = F.greatest(F.lit(LEAST_RHO), F.least(F.lit(MOST_RHO), F.coalesce(rho, F.lit(LEAST_RHO))))
    return children.filter("n > 0").agg((1 / rho - 1).alias("weight"))


def reputations(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url",
                label_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Rows (host, n, good, mean, deviation): the posterior of every host of ``pages``.

    A page is good if all its labels say so; labels without a value and pages without an id count nowhere. A page
    that is repeated on a host counts once.
    """
    marked = labels.select(F.col(label_id).alias("_id"), F.col(quality).alias("_q")).filter("_id is not null and _q is not null")
    marked = marked.groupBy("_id").agg(F.min(F.when(F.col("_q") > 0, 1).otherwise(0)).alias("_good"))
    seen = pages.select(F.col(page_id).alias("_id"), host_of(F.col(url)).alias("host")).distinct()
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = seen.join(marked, "_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("_good"), F.lit(0)).alias("good"), F.count("_good").alias("n"))
    hosts = saved(hosts.withColumns({"suffix": suffix, "domain": domain}), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    whole = suffixes.agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("mean"))

    def shrunk(children: DataFrame, keep: list[str]) -> DataFrame:
        """Children (keep, good, n, mean of the parent) with the posterior mean in place of the parent's."""
        weight = _weight(children).first()["weight"]  # one number
        mean = (F.col("mean") * weight + F.col("good")) / (weight + F.col("n"))
        return children.select(*keep, "good", "n", mean.alias("mean"), (weight + F.col("n")).alias("pages"))

    root = whole.first()["mean"]
    root = 0.5 if root is None else root
    by_suffix = shrunk(suffixes.withColumn("mean", F.lit(root)), ["suffix"])
    by_domain = shrunk(domains.join(by_suffix.select("suffix", "mean"), "suffix"), ["domain", "suffix"])
    by_host = shrunk(hosts.join(by_domain.select("domain", "suffix", "mean"), ["domain", "suffix"]), ["host"])
    return by_host.select("host", "n", "good", "mean", F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("pages") + 1)).alias("deviation"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url",
          limit: float = 0.5, deviations: float = 2.33) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict), one for each row of ``pages``.

    Where no rule fits, a page is blocked if the upper bound of its host's share of good pages (mean plus
    ``deviations`` posterior deviations) is below ``limit``. Urls that are null or have no ``://`` have an
    empty host, which is judged like any other. Without labels nothing is blocked but by rules.
    """
    marked = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = reputations(pages, labels, page_id, url).select(
        "host", F.when(F.col("mean") + deviations * F.col("deviation") < limit, "block").otherwise("allow").alias("_verdict"))
    found = marked.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules)).join(known, "host", "left")
    return found.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_verdict", F.lit("allow")).alias("verdict"))


def oracle(rules: list[tuple[str, str, str]], limit: float = 0.5, deviations: float = 2.33) -> str:
    """The same in DuckDB's SQL over the tables pages and labels."""
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    long = ", ".join(f"'{s}'" for s in LONG_SUFFIXES)

    def weight(table: str) -> str:
        rho = f"(sum(n * pow(good / n - mean, 2)) - sum(mean * (1 - mean))) / sum(mean * (1 - mean) * (n - 1))"
        return (f"(SELECT 1 / greatest({LEAST_RHO}, least({MOST_RHO}, coalesce(CASE WHEN sum(mean * (1 - mean) * (n - 1)) > 0 "
                f"THEN {rho} END, {LEAST_RHO}))) - 1 FROM {table} WHERE n > 0)")

    def shrunk(table: str, keep: str) -> str:
        return (f"SELECT {keep}, good, n, (mean * w + good) / (w + n) AS mean, w + n AS pages "
                f"FROM {table}, (SELECT {weight(table)} AS w)")

    return f"""
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES {listed}),
l AS (SELECT doc_id, min(CASE WHEN quality > 0 THEN 1 ELSE 0 END) AS good FROM labels
      WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
h0 AS (SELECT host, CAST(coalesce(sum(good), 0) AS DOUBLE) AS good, CAST(count(good) AS DOUBLE) AS n,
              regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare
       FROM (SELECT DISTINCT page_id, host FROM p) LEFT JOIN l ON page_id = doc_id GROUP BY host),
h1 AS (SELECT *, string_split(bare, '.') AS parts FROM h0),
h2 AS (SELECT *, array_to_string(parts[-2:], '.') AS two, array_to_string(parts[-3:], '.') AS three FROM h1),
hosts AS (
  SELECT host, good, n,
         CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN '' WHEN two IN ({long}) AND bare <> two THEN two ELSE parts[-1] END AS suffix,
         CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN bare WHEN two IN ({long}) AND bare <> two THEN three ELSE two END AS domain
  FROM h2),
domains AS (SELECT domain, suffix, sum(good) AS good, sum(n) AS n FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(good) AS good, sum(n) AS n FROM domains GROUP BY ALL),
s0 AS (SELECT *, (SELECT (sum(good) + 1) / (sum(n) + 2) FROM suffixes) AS mean FROM suffixes),
s1 AS ({shrunk("s0", "suffix")}),
d0 AS (SELECT d.domain, d.suffix, d.good, d.n, s1.mean FROM domains d JOIN s1 USING (suffix)),
d1 AS ({shrunk("d0", "domain, suffix")}),
h3 AS (SELECT h.host, h.good, h.n, d1.mean FROM hosts h JOIN d1 USING (domain, suffix)),
h4 AS ({shrunk("h3", "host")}),
known AS (SELECT host, CASE WHEN mean + {deviations} * sqrt(mean * (1 - mean) / (pages + 1)) < {limit} THEN 'block' ELSE 'allow' END AS v FROM h4),
best AS (
  SELECT host, path, r.h || r.p AS rule, r.verdict,
         row_number() OVER (PARTITION BY host, path ORDER BY length(r.h || r.p) DESC, length(r.h) DESC, r.verdict = 'allow') AS k
  FROM (SELECT DISTINCT host, path FROM p) q
  JOIN rules r ON (q.host = r.h OR ends_with(q.host, '.' || r.h)) AND starts_with(q.path, r.p))
SELECT p.page_id, p.host, p.path, best.rule, coalesce(best.verdict, known.v, 'allow') AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path AND best.k = 1 LEFT JOIN known ON p.host = known.host
"""
