"""URL filter: rules first, else an empirical-Bayes reputation of the host.

Labelled page outcomes (bad or not) are counted per host, registered domain and
suffix.  Each level is a beta-binomial whose prior mean is the posterior mean of
the level above and whose strength (``1 / rho - 1``) comes from the
over-dispersion ``rho`` of the counts around that mean (method of moments).  A
url is blocked when the lower bound of its host's posterior bad share,
``mean - z * sd``, exceeds ``max_bad``: few labels pull a host to its domain,
and leave the bound wide.

Everything is a grouped sum and a join on the host, so a host with a third of
all pages is summed map-side and its join partition can be split.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and is judged as the host "" is; outcomes of unknown pages or with a null
outcome count nothing; without outcomes every url is allowed; repeated pages
are judged and counted each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, pick

#: (verdict, host and path); the longest that fits wins
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: suffixes of more than one label under which domains are registered
SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "org.uk")
MAX_BAD = 0.5
Z = 1.645

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]], what) -> Column:
    """``what(rule)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):      # the last one laid on top is the longest
        rule_host, slash, rest = rule[1].partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(what(rule))).otherwise(out)
    return out


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The public suffix: the last label, or a listed pair of labels; of an
    address or a host without a dot, the host itself."""
    last = F.substring_index(host, ".", -1)
    pair = F.substring_index(host, ".", -2)
    return F.when(~host.contains(".") | last.rlike("^[0-9]*$"), host).when(pair.isin(*suffixes), pair).otherwise(last)


def domain_of(host: Column, suffix: Column) -> Column:
    """The registered domain: the suffix and one label more."""
    labels = F.size(F.split(suffix, r"\."))
    return F.when(host == suffix, host).otherwise(F.call_function("substring_index", host, F.lit("."), -(labels + 1)))


def _strength(counts: DataFrame, name: str) -> DataFrame:
    """One row: strength of the prior of a level (n, k) around its parent's share p."""
    p = F.col("p")
    rho = ((F.sum((F.col("k") - F.col("n") * p) ** 2) - F.sum(F.col("n") * p * (1 - p)))
           / F.nullif(F.sum(F.col("n") * (F.col("n") - 1) * p * (1 - p)), F.lit(0.0)))
    return counts.agg((1 / F.greatest(F.lit(0.001), F.least(F.lit(0.99), F.coalesce(rho, F.lit(0.5)))) - 1).alias(name))


def host_posteriors(hosts: DataFrame) -> DataFrame:
    """From labelled counts per host (host, domain, suffix, n, k): the mean and
    standard deviation of the host's posterior bad share."""
    def share(k, n):
        return (F.col(k) + 0.5) / (F.col(n) + 1)

    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_all"), F.coalesce(F.sum("k"), F.lit(0)).alias("k_all"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n_s"), F.sum("k").alias("k_s"))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n_d"), F.sum("k").alias("k_d"))

    def strength(level: DataFrame, n: str, k: str, up_n: str, up_k: str, name: str) -> DataFrame:
        p = share(up_k, up_n)
        rows = level.select(F.col(n).cast("double").alias("n"), F.col(k).cast("double").alias("k"), p.alias("p"))
        return _strength(rows, name)

    s = suffixes.join(F.broadcast(total))                                   # one row
    a_s = strength(s, "n_s", "k_s", "n_all", "k_all", "a_s")
    s = s.join(F.broadcast(a_s)).select(
        "suffix", "n_s", "k_s", ((F.col("k_s") + F.col("a_s") * share("k_all", "n_all")) / (F.col("n_s") + F.col("a_s"))).alias("m_s"))
    d = domains.join(s, "suffix")
    a_d = strength(d, "n_d", "k_d", "n_s", "k_s", "a_d")
    d = d.join(F.broadcast(a_d)).select(
        "suffix", "domain", "n_d", "k_d", ((F.col("k_d") + F.col("a_d") * F.col("m_s")) / (F.col("n_d") + F.col("a_d"))).alias("m_d"))
    h = hosts.join(d, ["suffix", "domain"])
    a_h = strength(h, "n", "k", "n_d", "k_d", "a_h")
    alpha, beta = F.col("k") + F.col("a_h") * F.col("m_d"), F.col("n") - F.col("k") + F.col("a_h") * (1 - F.col("m_d"))
    return h.join(F.broadcast(a_h)).select(
        "host", "n", "k", (alpha / (alpha + beta)).alias("mean"),
        F.sqrt(alpha * beta / ((alpha + beta) ** 2 * (alpha + beta + 1))).alias("sd"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, max_bad: float = MAX_BAD, z: float = Z,
          suffixes: Sequence[str] = SUFFIXES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_share, bad_bound) of every page.

    ``outcomes``: (page_id, bad) with bad 0 or 1; of several outcomes of a page
    the worst counts."""
    urls = pick(pages, page_id=id_col, url=url_col).select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = pick(outcomes, o_id="page_id", bad="bad").where("bad is not null").groupBy("o_id").agg(F.max(F.col("bad").cast("long")).alias("bad"))
    hosts = keep(urls.join(labels, urls["page_id"] == labels["o_id"], "left").groupBy("host")
                 .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
                 .withColumn("suffix", suffix_of(F.col("host"), suffixes))
                 .withColumn("domain", domain_of(F.col("host"), F.col("suffix"))), "hosts")
    # written, so that both sides of the last join are plain scans and a hot host can be split there
    known = keep(host_posteriors(hosts).select(F.col("host").alias("h"), F.col("mean").alias("bad_share"),
                                               (F.col("mean") - z * F.col("sd")).alias("bad_bound")), "reputation")
    host, path = F.col("host"), F.col("path")
    return urls.join(known, urls["host"] == known["h"], "left").select(
        "page_id", "host", "path", rule_of(host, path, rules, lambda r: r[1]).alias("rule"),
        F.coalesce(rule_of(host, path, rules, lambda r: r[0]),
                   F.when(F.col("bad_bound") > max_bad, "block").otherwise("allow")).alias("verdict"),
        "bad_share", "bad_bound")


def outcomes_from_labels(labels: DataFrame) -> DataFrame:
    """Outcomes of the pages whose id a label carries: bad if toxic or of low quality."""
    own = pick(labels, page_id="doc_id", quality="quality", toxic="toxic")
    return own.select("page_id", F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.col("quality").isNull() & F.col("toxic").isNull(), None).otherwise(0).alias("bad"))


def oracle(rules: Sequence[tuple[str, str]] = RULES, max_bad: float = MAX_BAD, z: float = Z, suffixes: Sequence[str] = SUFFIXES) -> str:
    """DuckDB SQL for ``judge`` of ``pages`` by ``outcomes_from_labels(labels)``."""
    def case(what):
        arms = []
        for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1]), reverse=True):
            host, slash, rest = rule.partition("/")
            arms.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{rest}') THEN '{what((verdict, rule))}'")
        return "CASE " + " ".join(arms) + " END"

    listed = ", ".join(f"'{s}'" for s in suffixes)

    def strength(level, n, k, p):
        return (f"SELECT 1 / greatest(0.001, least(0.99, coalesce((sum(power({k} - {n} * {p}, 2)) - sum({n} * {p} * (1 - {p}))) "
                f"/ nullif(sum({n}::DOUBLE * ({n} - 1) * {p} * (1 - {p})), 0), 0.5))) - 1 AS a FROM {level}")

    return f"""
WITH urls AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), '{_UPPER}', '{_LOWER}') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
labels1 AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY 1),
counted AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k FROM urls LEFT JOIN labels1 ON doc_id = page_id GROUP BY 1),
labelled AS (
  SELECT *, string_split(host, '.') AS w,
         CASE WHEN NOT contains(host, '.') OR regexp_full_match(string_split(host, '.')[-1], '[0-9]*') THEN host
              WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ({listed}) THEN array_to_string(string_split(host, '.')[-2:], '.')
              ELSE string_split(host, '.')[-1] END AS suffix
  FROM counted),
hosts AS (
  SELECT host, n, k, suffix,
         CASE WHEN host = suffix THEN host ELSE array_to_string(w[-(len(string_split(suffix, '.')) + 1):], '.') END AS domain
  FROM labelled),
t AS (SELECT (sum(k) + 0.5) / (sum(n) + 1) AS p FROM hosts),
s AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, any_value(p) AS p FROM hosts, t GROUP BY 1),
a_s AS ({strength('s', 'n', 'k', 'p')}),
s2 AS (SELECT suffix, (k + 0.5) / (n + 1) AS p, (k + a * s.p) / (n + a) AS m FROM s, a_s),
d AS (SELECT suffix, domain, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, any_value(p) AS p, any_value(m) AS m FROM hosts JOIN s2 USING (suffix) GROUP BY 1, 2),
a_d AS ({strength('d', 'n', 'k', 'p')}),
d2 AS (SELECT suffix, domain, (k + 0.5) / (n + 1) AS p, (k + a * m) / (n + a) AS m FROM d, a_d),
h AS (SELECT host, n::DOUBLE AS n, k::DOUBLE AS k, p, m FROM hosts JOIN d2 USING (suffix, domain)),
a_h AS ({strength('h', 'n', 'k', 'p')}),
ab AS (SELECT host, k + a * m AS x, n - k + a * (1 - m) AS y FROM h, a_h),
bound AS (SELECT host, x / (x + y) - {z} * sqrt(x * y / (power(x + y, 2) * (x + y + 1))) AS low FROM ab)
SELECT page_id, host, path, {case(lambda r: r[1])} AS rule,
       coalesce({case(lambda r: r[0])}, CASE WHEN low > {max_bad} THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN bound USING (host)"""
