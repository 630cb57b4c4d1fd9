"""URL filters: rules first, then the host's reputation by empirical Bayes.

Labelled outcomes of pages (bad or not) are counted by host, registered domain and suffix. A
suffix starts from the rate of all pages, a domain from its suffix's, a host from its domain's: at
each level the counts update a beta prior around the level above, whose strength is estimated
from how much the groups of that level differ under one parent (moments of the beta-binomial). A
host is blocked where the lower bound of its posterior rate of bad pages is above ``LIMIT``; a host
without labels has its domain's belief, a new domain its suffix's.

Rules name a host and a path and fit that host and its subdomains where the page's path begins
with the rule's; the longest decides.

Defined results: a missing url, or one without ``://``, has empty host and path, which are a host
like any other; a domain is the last two labels (three under a two-part suffix); addresses in
digits are domains of their own; repeated rows are judged alike; an empty table gives no rows;
outcomes of unknown pages are ignored; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Rules of the production query: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
TWO_PART = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au",
            "com.br", "com.cn", "com.mx", "com.sg", "com.tr", "com.tw", "gov.uk", "org.au",
            "org.uk")
LIMIT = 0.5
BOUND = 1.645                    # standard deviations below the mean: 95 % one-sided
CORRELATION = (0.001, 0.95)      # how alike outcomes within a group may be taken to be
UNKNOWN = 0.1                    # that, where no groups can be compared
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_address(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, domain, suffix``."""
    text = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    found = (pages.withColumn("host", F.translate(F.regexp_extract(text, ADDRESS, 1), UPPER, LOWER))
             .withColumn("path", F.regexp_extract(text, ADDRESS, 2)))
    last_two = F.substring_index("host", ".", -2)
    digits = F.col("host").rlike(r"^[0-9.]+(:[0-9]+)?$")
    two = last_two.isin(*TWO_PART)
    domain = F.when(digits, F.col("host")).when(two, F.substring_index("host", ".", -3)).otherwise(last_two)
    suffix = F.when(digits, F.lit("")).when(two, last_two).otherwise(F.substring_index("host", ".", -1))
    return found.withColumn("domain", domain).withColumn("suffix", suffix)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL where none does."""
    text = verdict = F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text = F.when(fits, F.lit(name + start)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _strength(counts: DataFrame, above: list[str]) -> DataFrame:
    """One number: how many outcomes the prior of a level is worth. ``counts`` has n and bad of its
    groups; what counts is how much groups differ that share the columns ``above``."""
    rate = F.col("bad") / F.col("n")
    each = counts.where("n > 0").groupBy(*above).agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("all"), F.sum("bad").alias("bads"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("n") * rate * rate).alias("spread"))
    total = each.agg(
        F.sum(F.col("groups") - 1).alias("free"), F.sum(F.col("all") - F.col("groups")).alias("left"),
        F.sum(F.col("spread") - F.col("bads") * F.col("bads") / F.col("all")).alias("between"),
        F.sum(F.col("bads") - F.col("spread")).alias("within"),
        F.sum(F.col("all") - F.col("squares") / F.col("all")).alias("size"))
    known = (F.col("free") > 0) & (F.col("left") > 0)
    between, within = F.try_divide("between", "free"), F.try_divide("within", "left")
    whole = between + (F.try_divide("size", "free") - 1) * within
    low, high = CORRELATION
    alike = F.when(known, F.when(whole > 0, F.least(F.greatest((between - within) / whole, F.lit(low)),
                                                    F.lit(high))))
    return total.select((1 / F.coalesce(alike, F.lit(UNKNOWN)) - 1).alias("m"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, key: str = "page_id") -> DataFrame:
    """``host, n, bad, rate, bound`` of every host of ``pages`` (with addresses).

    ``outcomes`` (key, bad as 0 or 1). Counts are aggregated where the rows lie before anything
    moves; all later tables have a row per host, domain or suffix, or one row.
    """
    labelled = outcomes.where("bad is not null").select(F.col(key).alias("_key"),
                                                        F.col("bad").cast("long").alias("bad"))
    hosts = (pages.join(labelled, F.col(f"`{key}`") == F.col("_key"), "left")
             .groupBy("host", "domain", "suffix")
             .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1)
                            / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("base"))
    # Each is one number, told to the level below as such.
    base = overall.scalar()
    m_suffix = _strength(suffixes, []).scalar()
    m_domain = _strength(domains, ["suffix"]).scalar()
    m_host = _strength(hosts, ["domain", "suffix"]).scalar()

    def mean(strength: str, above: Column) -> Column:
        return ((F.col(strength) * above + F.col("bad")) / (F.col(strength) + F.col("n")))

    by_suffix = suffixes.withColumn("m", m_suffix).select("suffix", mean("m", base).alias("p_suffix"))
    by_domain = domains.withColumn("m", m_domain).join(by_suffix, "suffix").select(
        "domain", "suffix", mean("m", F.col("p_suffix")).alias("p_domain"))
    known = hosts.withColumn("m", m_host).join(by_domain, ["domain", "suffix"])
    rate, weight = mean("m", F.col("p_domain")), F.col("m") + F.col("n")
    spread = F.sqrt(rate * (1 - rate) / (weight + 1))
    return known.select("host", "n", "bad", rate.alias("rate"),
                        (rate - F.lit(BOUND) * spread).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, key: str = "page_id", url: str = "url",
          rules: tuple = RULES, limit: float = LIMIT) -> DataFrame:
    """``page_id, host, path, rule, verdict, bound`` of every page."""
    rows = with_address(pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url")))
    known = host_reputation(rows, outcomes.withColumnRenamed(key, "page_id"), "page_id")
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return (rows.join(known.select("host", "bound"), "host")
            .select("page_id", "host", "path", text.alias("rule"),
                    F.coalesce(verdict, by_host).alias("verdict"), "bound"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, bad``: the label of the document that a page shows, whose number begins the last
    part of its path; a document is bad if it is of low quality or toxic in any of its labels."""
    number = F.regexp_extract("url", r"://[^/?#]*(?:/[^/?#]*)*?/([0-9]{1,18})[^/?#]*/?(?:[?#]|$)", 1)
    shown = pages.select("page_id", F.when(number != "", number.cast("long")).alias("doc_id"))
    marks = (labels.groupBy("doc_id").agg(F.max(
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")))
    return (shown.where("doc_id is not null").join(marks, "doc_id")
            .groupBy("page_id").agg(F.max("bad").alias("bad")))


def check_sql(rules: tuple = RULES) -> str:
    """The same verdicts in the check engine's SQL."""
    ordered = sorted(rules, key=lambda r: (len(r[1] + r[2]), r), reverse=True)
    fit = "(host = '{1}' or ends_with(host, '.{1}')) and starts_with(path, '{2}')"
    text = " ".join(f"when {fit.format(*r)} then '{r[1]}{r[2]}'" for r in ordered)
    verdict = " ".join(f"when {fit.format(*r)} then '{r[0]}'" for r in ordered)
    two = ", ".join(f"'{s}'" for s in TWO_PART)
    low, high = CORRELATION

    def strength(source: str, above: str) -> str:
        return f"""(select 1 / coalesce(case when f > 0 and l > 0 and b / f + (s / f - 1) * w / l > 0
          then least(greatest((b / f - w / l) / (b / f + (s / f - 1) * w / l), {low}), {high}) end,
          {UNKNOWN}) - 1
          from (select sum(g - 1) f, sum(a - g) l, sum(sp - k * k / a) b, sum(k - sp) w, sum(a - q / a) s
                from (select {above} as up, count(*)::double g, sum(n) a, sum(bad) k, sum(n * n) q,
                             sum(n * (bad / n) * (bad / n)) sp
                      from {source} where n > 0 group by up)))"""

    return f"""
with raw as (
  select page_id, coalesce(url, '') u,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['h', 'p']) m
  from pages),
rows_ as (
  select page_id, lower(m.h) as host, m.p as path,
         try_cast(regexp_extract(u, '://[^/?#]*(?:/[^/?#]*)*?/([0-9]{{1,18}})[^/?#]*/?(?:[?#]|$)', 1)
                  as bigint) as doc_id
  from raw),
parts as (
  select *, string_split(host, '.') l, regexp_matches(host, '^[0-9.]+(:[0-9]+)?$') as digits,
         array_to_string(string_split(host, '.')[-2:], '.') as last_two
  from rows_),
named as (
  select page_id, host, path, doc_id,
         case when digits then host when last_two in ({two}) then array_to_string(l[-3:], '.')
              else last_two end as domain,
         case when digits then '' when last_two in ({two}) then last_two
              else l[-1] end as suffix
  from parts),
marks as (select doc_id, max((quality = 0 or toxic = 1)::int) as bad from labels group by 1),
joined as (select n.*, m.bad from named n left join marks m using (doc_id)),
hosts as (select host, domain, suffix, count(bad)::double as n, coalesce(sum(bad), 0)::double as bad
          from joined group by all),
domains as (select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by all),
suffixes as (select suffix, sum(n) as n, sum(bad) as bad from domains group by all),
one as (select (select (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) from suffixes) as base,
               {strength('suffixes', '0')} as m_suffix, {strength('domains', 'suffix')} as m_domain,
               {strength('hosts', '(domain, suffix)')} as m_host),
by_suffix as (select suffix, m_domain, m_host, (m_suffix * base + bad) / (m_suffix + n) as p_suffix
              from suffixes, one),
by_domain as (select domain, d.suffix, m_host, (m_domain * p_suffix + bad) / (m_domain + n) as p_domain
              from domains d join by_suffix s using (suffix)),
known as (select host, m_host + h.n as weight, (m_host * p_domain + h.bad) / (m_host + h.n) as rate
          from hosts h join by_domain d using (domain, suffix))
select page_id, host, path, case {text} end as rule,
       case {verdict} when rate - {BOUND} * sqrt(rate * (1 - rate) / (weight + 1)) > {LIMIT}
            then 'block' else 'allow' end as verdict
from joined join known using (host)"""
