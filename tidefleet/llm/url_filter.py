"""Host reputation by empirical Bayes, and rules for hosts and paths.

Labelled page outcomes are counted by host; beta-binomial priors lead from the
whole corpus to the suffix, from there to the registered domain and on to the
host. What a member inherits from the level above never holds its own outcomes,
so that each outcome counts once on a host's way; how strongly a level pulls is
learnt from the spread among its members that have several outcomes, and is weak
as long as there are few. A page is blocked if even the upper posterior bound of
its host's share of good pages is low.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefleet.llm.common import SharedTables, as_row, ascii_lower, with_groups

#: (verdict, host and path prefix): a rule fits its host and all subdomains; the longest wins.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Suffixes of more than one label under which domains are registered; a fuller list, such as the public suffix list's, may be given instead.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")
MIN_GOOD, Z = 0.6, 1.64
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0
#: Correlation of outcomes within a member that is taken for granted, and how many outcomes' worth of evidence that is.
USUAL_CORRELATION, USUAL_WEIGHT = 0.5, 10.0
#: Hosts whose reputations a broadcast may hold (about 100 MB); with more, pages are joined by host.
BROADCAST_HOSTS = 1_000_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Verdict and text of the longest rule that fits; null without one."""
    verdict = text = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"))):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        verdict, text = F.when(fits, kind).otherwise(verdict), F.when(fits, rule).otherwise(text)
    return verdict, text


def _levels(host: Column, long_suffixes: tuple[str, ...]) -> dict[str, Column]:
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    address = bare.rlike(r"^[0-9.]*$|^\[")
    labels = F.split(bare, r"\.")
    last2, last3 = (F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.lit(n)), ".") for n in (2, 3))
    domain = F.when(address, bare).when(last2.isin(*long_suffixes), last3).otherwise(last2)
    suffix = F.when(address, "").otherwise(F.regexp_replace(domain, r"^[^.]*\.?", ""))
    return {"suffix": suffix, "domain": domain}


def _clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def reputations(hosts: DataFrame, z: float = Z, long_suffixes: tuple[str, ...] = LONG_SUFFIXES) -> DataFrame:
    """(host, posterior, bound) from rows (host, n, good), one per host; n may be zero.

    The corpus gives the suffix s the mean p_s = (good + 1) / (n + 2) over what
    isn't under s. A level of strength S gives each member m the mean
    p_m = (S p + good) / (S + n), with p the mean that the level itself got and
    good, n over what is in the level but not in m. A host's posterior is
    beta(S p + good, S (1 - p) + n - good). A level's strength is 1 / rho - 1
    within fixed limits, with rho = (X + w r) / (N + w), where w and r are what
    is taken for granted (USUAL), and over members of several outcomes
    X = sum ((good - n p)^2 / (n p (1 - p)) - 1) and N = sum (n - 1).
    """
    named = hosts.select("host", "n", "good", *(c.alias(k) for k, c in _levels(F.col("host"), long_suffixes).items()))
    total = named.agg(F.sum("good"), F.sum("n")).collect()[0]
    total_good, total_n = float(total[0] or 0), float(total[1] or 0)
    p, n, good = F.col("p"), F.col("n"), F.col("good")
    parent = None
    for keys in (["suffix"], ["suffix", "domain"], ["suffix", "domain", "host"]):
        members = named.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        if parent is None:
            members = members.withColumn("p", (F.lit(total_good) - good + 1) / (F.lit(total_n) - n + 2))
        else:  # strength is that of the level above, above_* are its counts and the mean it got
            members = members.join(parent, keys[:-1]).withColumn("p", (strength * F.col("above_p") + F.col("above_good") - good) / (strength + F.col("above_n") - n))
        several = members.filter("n > 1").agg(F.sum((good - n * p) ** 2 / (n * p * (1 - p)) - 1), F.sum(n - 1)).collect()[0]
        rho = (float(several[0] or 0) + USUAL_WEIGHT * USUAL_CORRELATION) / (float(several[1] or 0) + USUAL_WEIGHT)
        strength = min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / rho - 1)) if rho > 0 else MOST_STRENGTH
        parent = members.select(*keys, p.alias("above_p"), good.alias("above_good"), n.alias("above_n"))
    a, b = strength * p + good, strength * (1 - p) + n - good
    mean = a / (a + b)
    bound = mean + z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return members.select("host", mean.alias("posterior"), _clamp(bound, 0.0, 1.0).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, min_good: float = MIN_GOOD, z: float = Z, long_suffixes: tuple[str, ...] = LONG_SUFFIXES, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """Per row of pages: page_id, host, path, rule, posterior, bound, verdict.

    outcomes has (page_id, good 0 or 1), of several for a page the least. Null
    urls and those without :// have an empty host, which has a reputation like
    any other; urls of any length are read whole; a host without outcomes has
    what its domain gives it; a bound of just min_good allows; repeated rows and
    null ids get their results; without outcomes nothing but rules blocks, as the
    prior is then one half with a wide bound; an empty table gives none. Other
    columns are not read. The counts of hosts are written once to the shared
    folder, and their reputations are broadcast up to broadcast_hosts hosts; with
    more, those of the hosts with most pages only, and other pages are joined by
    their hosts.
    """
    tables = SharedTables(pages.sparkSession)
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.filter("page_id is not null and good is not null").groupBy("page_id").agg(F.min("good").cast("long").alias("good"))
    counted = parsed.select("page_id", "host").join(known, "page_id", "left").groupBy("host").agg(F.count("*").alias("pages"), F.count("good").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"))
    known_hosts = tables.keep(counted)
    found = tables.keep(reputations(known_hosts, z, long_suffixes))
    verdict, rule = _rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") < min_good, "block").otherwise("allow")
    if found.count() <= broadcast_hosts:
        joined = parsed.join(F.broadcast(found), "host")
    else:
        sized = tables.keep(found.join(known_hosts.select("host", "pages"), "host"))
        joined = with_groups(parsed, sized, ["host"], "pages", sized.agg(F.sum("pages")).collect()[0][0])
    return joined.select("page_id", "host", "path", rule.alias("rule"), "posterior", "bound", F.coalesce(verdict, own).alias("verdict"))


def allowed(pages: DataFrame, outcomes: DataFrame, rules=RULES, min_good: float = MIN_GOOD, z: float = Z) -> DataFrame:
    """The rows of pages that judge() allows, all their columns as they were, whatever their names.

    Rows of one host and path fare alike, so repeated rows and null ids do; null
    urls and those without :// are judged as the empty host; urls of any length
    are read whole; an empty table stays empty.
    """
    host, path = host_and_path(F.coalesce("row.url", F.lit("")))
    verdicts = judge(pages, outcomes, rules, min_good, z).filter("verdict = 'allow'").select("host", "path").distinct()
    return as_row(pages).join(verdicts, (host == F.col("host")) & (path == F.col("path")), "left_semi").select("row.*")
