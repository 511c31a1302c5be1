"""URL filters: rules by host and path, and empirical-Bayes reputation of hosts for the rest.

Labelled page outcomes (bad or not) are counted by host, registered domain and public suffix. At each
level a beta prior with the parent's posterior mean is combined with the level's own counts; the
prior's weight is estimated from how much the children of a level differ by the method of moments for
beta-binomial counts (overdispersion rho; weight 1/rho - 1). A page is blocked if the lower bound of its
host's posterior, mean minus Z standard deviations, exceeds BLOCK_ABOVE. Hosts without labelled pages
have their domain's reputation, unknown domains their suffix's, unknown suffixes that of all pages.

All of it is DataFrame operations. A null url, or one without ``://``, has an empty host and path, fits no
rule and has the reputation of all pages. Very long urls are read whole. Rows that repeat an id or a url are judged each, and each counts as an outcome. Empty tables give none.
The pages of a very frequent host (the empty one included) are split before they meet its reputation. In the query, pages that a rule judges are the labelled ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common, graphs

BLOCK_ABOVE = 0.5
Z = 1.645
RHO_RANGE = (0.001, 0.9)
RHO_DEFAULT = 0.1  # where a level has too few labelled pages to tell

#: Public suffixes of two labels.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za")


@dataclass(frozen=True)
class Rule:
    """block or allow host and its subdomains, for paths that start with path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, or nulls. Rules are a short list, tried from the longest on."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def _rho(children: DataFrame, parent: str, name: str) -> DataFrame:
    """One row: the overdispersion of children (n labelled, k bad) within their parents."""
    seen = children.where(F.col("n") > 0)
    by = seen.groupBy(parent).agg(F.sum("n").alias("all_n"), F.sum("k").alias("all_k"), F.count(F.lit(1)).alias("g"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk_n"))
    p = F.col("all_k") / F.col("all_n")
    spread = F.col("kk_n") - F.col("all_n") * p * p  # sum of n (k/n - p)**2
    within, between = p * (1 - p) * (F.col("g") - 1), p * (1 - p) * (F.col("all_n") - F.col("nn") / F.col("all_n"))
    one = by.agg(F.sum(spread).alias("s"), F.sum(within).alias("a"), F.sum(between).alias("b"))
    rho = F.when(F.round(F.col("b") - F.col("a"), 9) > 0, F.least(F.greatest((F.col("s") - F.col("a")) / (F.col("b") - F.col("a")), F.lit(RHO_RANGE[0])), F.lit(RHO_RANGE[1]))).otherwise(RHO_DEFAULT)
    return one.select((1 / rho - 1).alias(name), F.lit(1).alias("one"))


def reputation(outcomes: DataFrame) -> DataFrame:
    """From (host, bad 0/1 or null): a row a host with n, k, bad_mean, bad_bound. Counts are sums by host first, so
    a host with very many pages is no single task."""
    counts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("k"))
    hosts = common.written(counts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "k"), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("one", F.lit(1))
    whole = suffixes.agg(F.sum("n").alias("n0"), F.sum("k").alias("k0")).select(((F.col("k0") + 1) / (F.col("n0") + 2)).alias("m0"), F.lit(1).alias("one"))
    weights = reduce(lambda a, b: a.join(b, "one"), [whole, _rho(suffixes, "one", "w_suffix"), _rho(domains, "suffix", "w_domain"), _rho(hosts, "domain", "w_host")])

    def mean(prior: str, weight: str) -> Column:
        return (F.col("k") + F.col(weight) * F.col(prior)) / (F.col("n") + F.col(weight))

    s = suffixes.join(weights, "one").select("suffix", mean("m0", "w_suffix").alias("m_suffix"), "w_domain", "w_host")
    d = domains.join(s, "suffix").select("domain", mean("m_suffix", "w_domain").alias("m_domain"), "w_host")
    h = hosts.join(d, "domain").withColumn("bad_mean", mean("m_domain", "w_host"))
    total = F.col("n") + F.col("w_host")
    sd = F.sqrt(F.col("bad_mean") * (1 - F.col("bad_mean")) / (total + 1))
    return h.select("host", "n", "k", "bad_mean", (F.col("bad_mean") - Z * sd).alias("bad_bound"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES, outcomes: DataFrame | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, bad_bound) of each page. outcomes: (url, bad); by default what the rules say of pages."""
    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = common.written(parsed.select("id", "host", "path", name.alias("rule"), verdict.alias("by_rule")), "ruled")
    known = ruled.select("host", (F.col("by_rule") == "block").cast("int").alias("bad"))
    if outcomes is not None:
        u = F.col("url").cast("string")
        known = known.select("host", F.lit(None).cast("int").alias("bad")).unionByName(outcomes.select(host_of(u).alias("host"), F.col("bad").cast("int").alias("bad")))
    rep = reputation(known).select("host", "bad_bound")
    by_method = F.when(F.col("bad_bound") > BLOCK_ABOVE, "block").otherwise("allow")
    parts, _ = graphs.frequent(ruled, "host")
    out = graphs.matched(ruled, rep, "host", "id", parts)
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"), F.round("bad_bound", 6).alias("bad_bound"))


def op9(spark, sf_dir: str) -> DataFrame:
    """Verdicts on every page."""
    return judge(common.table(spark, sf_dir, "pages"))


def _sql_rho(children: str, parent: str) -> str:
    return f"""(SELECT 1 / rho - 1 FROM (SELECT CASE WHEN round(b - a, 9) > 0 THEN least(greatest((s - a) / (b - a), {RHO_RANGE[0]}), {RHO_RANGE[1]}) ELSE {RHO_DEFAULT} END AS rho
  FROM (SELECT sum(kk_n - all_n * p * p) AS s, sum(p * (1 - p) * (g - 1)) AS a, sum(p * (1 - p) * (all_n - nn / all_n)) AS b
    FROM (SELECT *, all_k / all_n AS p FROM (SELECT {parent}, sum(n)::DOUBLE AS all_n, sum(k)::DOUBLE AS all_k, count(*) AS g, sum(n * n)::DOUBLE AS nn, sum(k * k / n::DOUBLE) AS kk_n FROM {children} WHERE n > 0 GROUP BY {parent})))))"""


def _sql_rule(field: str) -> str:
    whens = []
    for r in sorted(RULES, key=lambda r: (-len(r.name), -len(r.host), r.name)):
        whens.append(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, field)}'")
    return "CASE " + " ".join(whens) + " END"


_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
OP9_SQL = f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parsed AS (SELECT page_id, translate(regexp_extract(coalesce(r, ''), '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, {_sql_rule("name")} AS rule, {_sql_rule("verdict")} AS by_rule FROM parsed),
counts AS (SELECT host, count(by_rule)::DOUBLE AS n, count(CASE WHEN by_rule = 'block' THEN 1 END)::DOUBLE AS k, regexp_extract(host, '([^.]*[.])?[^.]*$') AS two, regexp_extract(host, '([^.]*[.])?([^.]*[.])?[^.]*$') AS three FROM ruled GROUP BY host),
hosts AS (SELECT host, n, k, CASE WHEN two IN ({_TWO}) THEN three ELSE two END AS domain, CASE WHEN two IN ({_TWO}) THEN two ELSE regexp_extract(host, '[^.]*$') END AS suffix FROM counts),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, 1 AS one, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
w AS (SELECT (SELECT (sum(k) + 1) / (sum(n) + 2) FROM suffixes) AS m0, {_sql_rho("suffixes", "one")} AS ws, {_sql_rho("domains", "suffix")} AS wd, {_sql_rho("hosts", "domain")} AS wh),
s AS (SELECT suffix, (k + ws * m0) / (n + ws) AS ms, wd, wh FROM suffixes, w),
d AS (SELECT domain, (k + wd * ms) / (n + wd) AS md, wh FROM domains JOIN s USING (suffix)),
h AS (SELECT host, n + wh AS t, (k + wh * md) / (n + wh) AS m FROM hosts JOIN d USING (domain)),
b AS (SELECT host, m - {Z} * sqrt(m * (1 - m) / (t + 1)) AS bound FROM h)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN bound > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict, round(bound, 6) AS bad_bound
FROM ruled JOIN b USING (host)
"""
