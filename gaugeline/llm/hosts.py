"""URL filtering by rules and by the reputation of hosts.

Labelled page outcomes are counted per host, registered domain and suffix. Each
level's share of good pages is drawn towards the level above by a beta-binomial
prior whose strength is fitted by moments over the units of that level, so a
host with few labels behaves like its domain, and a domain with few like its
suffix. A page is blocked if the upper bound of its host's posterior is too low.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.session import materialize

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values of the contract: (rule, verdict).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

MIN_GOOD = 0.75  # the share of good pages that a host must be able to reach
BOUND = 1.645  # standard deviations of the posterior above its mean
WEAKEST, STRONGEST = 1.0, 1000.0  # limits of a prior's strength, in labels
START_MEAN, START_STRENGTH = 0.5, 2.0  # of the prior above all suffixes


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty without ``://`` or for a null url."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + F.lit(3), F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, CAPITALS, SMALL), F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)


def rule_column(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null."""
    chosen, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # longer ones override
        place = rule.index("/")
        name, start = rule[:place], rule[place:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        chosen, verdict = F.when(fits, rule).otherwise(chosen), F.when(fits, decision).otherwise(verdict)
    return chosen, verdict


def levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host without port and user.

    The suffix is the last label, or the last two if the last has two letters
    and the one before at most three (``co.uk``); the domain has one label more.
    """
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    labels = F.split(bare, r"\.")
    last, second = F.element_at(labels, -1), F.get(labels, F.size(labels) - 2)
    double = (F.length(last) == 2) & (F.length(second) <= 3) & (F.size(labels) > 2)
    parts = F.when(F.coalesce(double, F.lit(False)), 2).otherwise(1)
    tail = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")
    return tail(parts + 1), tail(parts)


def _strength(units: DataFrame) -> Column:
    """The prior's strength from (k, n, mean): how far units spread beyond chance.

    With expected squared deviation ``p(1-p)/n * (1 + (n-1) rho)`` of a unit,
    the sums over units give ``rho``, and the strength is ``1/rho - 1``. Fewer
    than two units or no labels give the strongest prior.
    """
    chance = F.sum(F.col("mean") * (1 - F.col("mean")))
    spread = F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("mean"), F.lit(2.0)))
    extra = F.sum((F.col("n") - 1) * F.col("mean") * (1 - F.col("mean")))
    rho = F.when(extra > 0, (spread - chance) / extra)
    raw = F.when(rho > 0, 1 / rho - 1)
    return F.round(F.greatest(F.least(F.coalesce(raw, F.lit(STRONGEST)), F.lit(STRONGEST)), F.lit(WEAKEST)), 6)


def reputations(hosts: DataFrame) -> DataFrame:
    """(host, a, b): the beta posterior of every host of (host, domain, suffix, k, n)."""
    total = hosts.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    # One row: the mean of all labels, drawn a little to one half.
    above = total.select(((F.col("k") + START_MEAN * START_STRENGTH) / (F.col("n") + START_STRENGTH)).alias("mean"))
    overall = above.collect()[0]["mean"]
    parent: DataFrame | None = None
    for child, up in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        keys = [child] if up is None else [child, up]
        units = hosts.groupBy(*keys).agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
        units = units.withColumn("mean", F.lit(overall)) if parent is None else units.join(
            parent.select(F.col("unit").alias(up), "mean"), up)
        units = materialize(units, f"reputation-{child}")
        strength = units.where("n > 0").agg(_strength(units).alias("s")).collect()[0]["s"]  # one number
        parent = units.select(
            F.col(child).alias("unit"),
            (F.col("k") + F.col("mean") * strength).alias("a"),
            (F.col("n") - F.col("k") + (1 - F.col("mean")) * strength).alias("b"),
        ).withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
    return parent.select(F.col("unit").alias("host"), "a", "b")


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, min_good: float = MIN_GOOD, bound: float = BOUND) -> DataFrame:
    """Per page of ``pages`` (page_id, url): page_id, host, path, rule, verdict, good_upper.

    ``outcomes`` is (page_id, good 0/1); nulls and pages that are not there do
    not count, and repeated rows count each. Rules decide first; other pages
    are blocked if the upper posterior bound of their host is below
    ``min_good``. A page without a host is blocked, as nothing speaks for it. Extra columns are not read; an
    empty table gives an empty result.
    """
    host, path = url_parts(F.col("url"))
    parted = pages.select("page_id", host.alias("host"), path.alias("path"))
    labelled = parted.join(
        outcomes.where("good is not null and page_id is not null").groupBy("page_id").agg(
            F.sum("good").cast("long").alias("k"), F.count("*").alias("n")), "page_id", "left")
    domain, suffix = levels(F.col("host"))
    # Pages are counted per host before anything is joined to hosts.
    hosts = materialize(
        labelled.where("host <> ''").groupBy("host").agg(
            F.coalesce(F.sum("k"), F.lit(0)).alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        .select("host", domain.alias("domain"), suffix.alias("suffix"), "k", "n"), "hosts")
    size = F.col("a") + F.col("b")
    upper = F.col("a") / size + bound * F.sqrt(F.col("a") * F.col("b") / (size * size * (size + 1)))
    known = materialize(
        reputations(hosts).select("host", F.round(F.least(upper, F.lit(1.0)), 9).alias("good_upper")), "host-bounds")
    rule, decision = rule_column(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.coalesce(F.col("good_upper") >= min_good, F.lit(False)), "allow").otherwise("block")
    return parted.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decision, by_host).alias("verdict"), "good_upper")


_PRIOR = """
  SELECT greatest(least(coalesce(CASE WHEN (spread - chance) / nullif(extra, 0) > 0
                                      THEN 1 / ((spread - chance) / extra) - 1 END, 1000.0), 1000.0), 1.0) AS raw
  FROM (SELECT sum(mean * (1 - mean)) AS chance, sum(n * pow(k / n - mean, 2)) AS spread,
               sum((n - 1) * mean * (1 - mean)) AS extra
        FROM {units} WHERE n > 0)
"""

SQL = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parted AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{CAPITALS}', '{SMALL}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM cut
), outcome AS (
  SELECT doc_id AS page_id, sum(quality) AS k, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), labels_of AS (
  SELECT string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':\d*$', ''), '.') AS parts,
         host, coalesce(sum(k), 0)::DOUBLE AS k, coalesce(sum(n), 0)::DOUBLE AS n
  FROM parted LEFT JOIN outcome USING (page_id) WHERE host <> '' GROUP BY host
), sized AS (
  SELECT *, CASE WHEN len(parts) > 2 AND length(parts[-1]) = 2 AND length(parts[-2]) <= 3 THEN 2 ELSE 1 END AS last FROM labels_of
), hosts AS (
  SELECT host, k, n, array_to_string(parts[greatest(len(parts) - last, 1):], '.') AS domain,
         array_to_string(parts[greatest(len(parts) - last + 1, 1):], '.') AS suffix
  FROM sized
), suffixes AS (
  SELECT suffix, sum(k) AS k, sum(n) AS n, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM hosts) AS mean FROM hosts GROUP BY suffix
), suffix_prior AS ({_PRIOR.format(units='suffixes')}
), domains AS (
  SELECT domain, h.suffix, sum(h.k) AS k, sum(h.n) AS n, any_value((s.k + s.mean * round(raw, 6)) / (s.n + round(raw, 6))) AS mean
  FROM hosts h JOIN suffixes s USING (suffix), suffix_prior GROUP BY domain, h.suffix
), domain_prior AS ({_PRIOR.format(units='domains')}
), units AS (
  SELECT host, h.k, h.n, (d.k + d.mean * round(raw, 6)) / (d.n + round(raw, 6)) AS mean
  FROM hosts h JOIN domains d USING (domain), domain_prior
), host_prior AS ({_PRIOR.format(units='units')}
), posterior AS (
  SELECT host, k + mean * round(raw, 6) AS a, n - k + (1 - mean) * round(raw, 6) AS b FROM units, host_prior
), bounds AS (
  SELECT host, round(least(a / (a + b) + {BOUND} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 1.0), 9) AS good_upper FROM posterior
), ruled AS (
  SELECT p.*, good_upper,
         CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
              WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM parted p LEFT JOIN bounds USING (host)
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN coalesce(good_upper >= {MIN_GOOD}, false) THEN 'allow' ELSE 'block' END AS verdict, good_upper
FROM ruled
"""
