"""URL filters: fixed rules first, then the reputation of the host.

The reputation is an empirical-Bayes estimate of the rate of bad pages.  Labelled page
outcomes are counted per host, registered domain and suffix; each level's rate is
shrunk to that of the level above by a beta-binomial prior whose strength is fitted by
moments over all groups of the level.  A host is blocked when the lower bound of its
posterior rate is above a threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightgrid.llm.common import replaced, table, written

#: (host, path, verdict)
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Rules are part of the plan, so their number is bounded.
MAX_RULES = 10_000
#: Public suffixes of two labels; a parameter, these are examples.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.jp", "co.uk", "com.au", "com.br", "org.uk"]
#: Bounds of the correlation within a group, from which a prior's strength follows.
LEAST_CORRELATION, MOST_CORRELATION = 0.001, 0.9
#: Block when the rate less ``DEVIATIONS`` posterior deviations is above ``BAD_RATE``.
BAD_RATE, DEVIATIONS = 0.25, 1.645

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def bare_host(host: Column) -> Column:
    """The host without user, port and final dots."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), r"\.+$", "")


def suffix_of(host: Column, two_label: list[str]) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(host.rlike(r"^[0-9.]+$|^\["), host).otherwise(
        F.when(last_two.isin(two_label), last_two).otherwise(F.substring_index(host, ".", -1))
    )


def domain_of(host: Column, two_label: list[str]) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(host.rlike(r"^[0-9.]+$|^\["), host).otherwise(
        F.when(last_two.isin(two_label), F.substring_index(host, ".", -3)).otherwise(last_two)
    )


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, else null.

    A map holds the rules of each rule host; a url looks up its host and the ends of its
    host after each dot, so the work does not grow with the number of rules.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string,path:string>")
    by_host: dict[str, list] = {}
    for rule_host, rule_path, verdict in rules:
        by_host.setdefault(rule_host, []).append(
            F.struct(
                F.lit(len(rule_host + rule_path)).alias("size"), F.lit(rule_host + rule_path).alias("rule"),
                F.lit(verdict).alias("verdict"), F.lit(rule_path).alias("path"),
            )
        )
    known = F.create_map(*[x for h, found in by_host.items() for x in (F.lit(h), F.array(*found))])
    labels = F.split(host, r"\.")
    ends = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )
    found = F.flatten(F.filter(F.transform(ends, lambda end: F.try_element_at(known, end)), F.isnotnull))
    return F.array_max(F.filter(found, lambda r: F.startswith(path, r["path"])))


def _strength(counts: DataFrame, mean: float) -> float:
    """Pseudo-counts of the prior, by moments: groups (n, bad) around ``mean``."""
    row = counts.where("n > 0").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.try_divide(F.pow(F.col("bad") - F.col("n") * F.lit(mean), F.lit(2)), F.col("n"))).alias("spread"),
    ).first()
    k, n, nn = row.k or 0, row.n or 0, row.nn or 0
    over = n - nn / n - (k - 1) if n else 0
    if k < 2 or over <= 0 or not 0 < mean < 1:
        return 1 / LEAST_CORRELATION - 1
    rho = (row.spread / (mean * (1 - mean)) - (k - 1)) / over
    rho = min(max(rho, LEAST_CORRELATION), MOST_CORRELATION)
    return 1 / rho - 1


def host_reputation(counts: DataFrame, two_label: list[str] | None = None) -> DataFrame:
    """One row per host with the posterior ``rate`` of bad pages and its ``lower`` bound.

    ``counts``: host, n labelled pages, bad ones; hosts without labels have n = 0 and
    get the rate of their domain or suffix.  Without any label every rate is 0.
    Means of the levels: suffix to the overall mean, domain to its suffix, host to its
    domain.
    """
    two_label = TWO_LABEL_SUFFIXES if two_label is None else two_label
    bare = bare_host(F.col("host"))
    hosts = counts.select(
        "host", "n", "bad", domain_of(bare, two_label).alias("domain"), suffix_of(bare, two_label).alias("suffix")
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = total.bad / total.n if total.n else 0.0
    by_suffix, by_domain, by_host = (_strength(level, mean) for level in (suffixes, domains, hosts))
    suffixes = suffixes.select(
        "suffix", ((F.col("bad") + by_suffix * mean) / (F.col("n") + by_suffix)).alias("suffix_rate")
    )
    domains = domains.join(suffixes, "suffix").select(
        "domain", ((F.col("bad") + by_domain * F.col("suffix_rate")) / (F.col("n") + by_domain)).alias("domain_rate")
    )
    alpha = F.col("bad") + by_host * F.col("domain_rate")
    weight = F.col("n") + by_host
    rate = alpha / weight
    deviation = F.sqrt(rate * (1 - rate) / (weight + 1))
    return hosts.join(domains, "domain").select(
        "host", rate.alias("rate"), (rate - DEVIATIONS * deviation).alias("lower")
    )


def filter_urls(
    pages: DataFrame, outcomes: DataFrame | None = None, rules: list[tuple[str, str, str]] | None = None,
    url: str = "url", two_label: list[str] | None = None, bad_rate: float = BAD_RATE,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``outcomes``: url and bad (0 or 1, null: not labelled) of labelled pages; it may
    hold urls of other pages too.  A rule decides where one fits, else the host's
    reputation.  A null url or one without ``://`` has empty host and path, fits no
    rule and is judged like any host.  Columns of the result's names are replaced.
    """
    rules = RULES if rules is None else rules
    at = F.col(url).cast("string")
    host, path = host_of(at), path_of(at)
    parsed = replaced(pages, {"host": host, "path": path})
    fit = rule_for(F.col("host"), F.col("path"), rules)
    seen = pages.select(host.alias("host"), F.lit(0).alias("n"), F.lit(0).alias("bad"))
    if outcomes is not None:
        bad = F.col("bad").cast("int")
        seen = seen.unionByName(
            outcomes.where(bad.isNotNull()).select(
                host_of(F.col("url").cast("string")).alias("host"), F.lit(1).alias("n"), bad.alias("bad")
            )
        )
    counts = written(seen.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "hosts")
    blocked = host_reputation(counts, two_label).where(F.col("lower") > bad_rate).select(
        F.col("host").alias("__llm_bad_host")
    )
    judged = replaced(parsed, {"__llm_fit": fit}).join(blocked, F.col("host") == F.col("__llm_bad_host"), "left")
    by_host = F.when(F.col("__llm_bad_host").isNotNull(), "block").otherwise("allow")
    return replaced(
        judged, {"rule": F.col("__llm_fit.rule"), "verdict": F.coalesce(F.col("__llm_fit.verdict"), by_host)}
    ).drop("__llm_fit", "__llm_bad_host")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled outcomes of pages whose path is ``/language/doc_id``: url and bad.

    Bad is low quality or toxic text.  Of repeated labels of a document the worst counts.
    """
    worst = labels.groupBy(F.col("doc_id").cast("string").alias("__llm_doc")).agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")
    )
    doc = F.regexp_extract(path_of(F.col("url")), r"^/[^/]+/([0-9]+)", 1)
    return pages.select("url", doc.alias("__llm_doc")).join(worst, "__llm_doc").select("url", "bad")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = page_outcomes(pages, table(spark, sf_dir, "labels"))
    return filter_urls(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def _level(name: str, keys: str, of: str) -> str:
    return f"""{name} AS (SELECT {keys}, sum(n) AS n, sum(bad) AS bad FROM {of} GROUP BY {keys})"""


def _prior(name: str, of: str) -> str:
    return f"""{name} AS (
  SELECT CASE WHEN k < 2 OR n - nn / n - (k - 1) <= 0 OR NOT (p > 0 AND p < 1) THEN 1 / {LEAST_CORRELATION} - 1
         ELSE 1 / least(greatest((spread / (p * (1 - p)) - (k - 1)) / (n - nn / n - (k - 1)),
              {LEAST_CORRELATION}), {MOST_CORRELATION}) - 1 END AS m
  FROM (SELECT count(*) AS k, sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS nn, any_value(p) AS p,
               sum((bad - n * p) ** 2 / n) AS spread
        FROM {of}, overall WHERE n > 0))"""


OP8_SQL = f"""
WITH worst AS (
  SELECT doc_id::VARCHAR AS doc, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels GROUP BY 1),
parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
           '{_UPPER}', '{_LOWER}') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
counts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM parsed LEFT JOIN worst ON regexp_extract(path, '^/[^/]+/([0-9]+)', 1) = doc GROUP BY host),
named AS (
  SELECT host, n, bad, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\\.+$', '')
         AS bare FROM counts),
labelled AS (SELECT *, string_split(bare, '.') AS l, array_to_string(string_split(bare, '.')[-2:], '.') AS two FROM named),
hosts AS (
  SELECT host, n, bad,
    CASE WHEN regexp_matches(bare, '^[0-9.]+$|^\\[') THEN bare
         WHEN two IN ({", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)}) THEN array_to_string(l[-3:], '.')
         ELSE two END AS domain,
    CASE WHEN regexp_matches(bare, '^[0-9.]+$|^\\[') THEN bare
         WHEN two IN ({", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)}) THEN two ELSE l[-1] END AS suffix
  FROM labelled),
{_level("domains", "domain, suffix", "hosts")},
{_level("suffixes", "suffix", "domains")},
overall AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0.0) AS p FROM suffixes),
{_prior("prior_s", "suffixes")},
{_prior("prior_d", "domains")},
{_prior("prior_h", "hosts")},
suffix_rates AS (SELECT suffix, (bad + m * p) / (n + m) AS rate FROM suffixes, prior_s, overall),
domain_rates AS (SELECT domain, (bad + m * rate) / (n + m) AS rate FROM domains JOIN suffix_rates USING (suffix), prior_d),
posterior AS (
  SELECT host, (bad + m * d.rate) / (n + m) AS rate, n + m AS weight
  FROM hosts JOIN domain_rates d USING (domain), prior_h),
blocked AS (
  SELECT host FROM posterior WHERE rate - {DEVIATIONS} * sqrt(rate * (1 - rate) / (weight + 1)) > {BAD_RATE}),
rules(rule_host, rule_path, said) AS (VALUES {", ".join(str(r) for r in RULES)}),
fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(said, length(rule_host || rule_path)) AS said
  FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN blocked.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM parsed LEFT JOIN fits USING (page_id) LEFT JOIN blocked USING (host)
"""
