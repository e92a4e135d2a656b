"""URL verdicts: rules by host and path, and for the rest the reputation of the host."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.storage import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Common suffixes of more than one label under which domains are registered.
LONG_SUFFIXES = (
    "ac.at", "ac.id", "ac.il", "ac.in", "ac.jp", "ac.kr", "ac.nz", "ac.uk", "ac.za", "co.at", "co.id", "co.il", "co.in", "co.jp",
    "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.co", "com.eg", "com.hk", "com.mx",
    "com.my", "com.ng", "com.pe", "com.ph", "com.pk", "com.pl", "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn",
    "edu.au", "edu.br", "edu.cn", "edu.hk", "edu.in", "edu.mx", "edu.pl", "edu.sg", "edu.tr", "edu.tw", "go.id", "go.jp", "go.kr",
    "go.th", "gob.ar", "gob.mx", "gov.au", "gov.br", "gov.cn", "gov.in", "gov.il", "gov.sg", "gov.tr", "gov.uk", "gov.za", "ne.jp",
    "net.au", "net.br", "net.cn", "net.in", "net.nz", "net.pl", "net.tr", "net.uk", "nom.br", "or.at", "or.id", "or.jp", "or.kr",
    "org.ar", "org.au", "org.br", "org.cn", "org.il", "org.in", "org.mx", "org.nz", "org.pl", "org.tr", "org.tw", "org.uk", "org.za",
    "sch.uk",
)
#: A host is allowed if its share of good pages is at least THRESHOLD with a probability of about 95 %.
THRESHOLD = 0.5
SIGMAS = 1.645


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    pattern: str  # host, then a path that begins with /

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_fitting(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Struct (pattern, action) of the longest rule that fits; of equal ones a blocking one; else null."""
    found = F.lit(None).cast("struct<pattern:string,action:string>")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.action == "block", r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.pattern).alias("pattern"), F.lit(rule.action).alias("action"))).otherwise(found)
    return found


_PLAIN = "^.*@|:[0-9]*$"
_ADDRESS = "^[0-9]{1,3}([.][0-9]{1,3}){3}$|^\\[.*\\]$"


def _suffix(host: Column, suffixes: Sequence[str]) -> Column:
    """The longest known suffix of a name, else its last label; an address has no suffix."""
    plain = F.regexp_replace(host, _PLAIN, "")
    several = sorted(suffixes, key=len, reverse=True)
    pattern = "(?:^|[.])(" + "|".join(s.replace(".", "[.]") for s in several) + ")$" if several else "(x^)"
    long = F.regexp_extract(plain, pattern, 1)
    return F.when(plain.rlike(_ADDRESS), "").when(long != "", long).otherwise(F.substring_index(plain, ".", -1))


def _domain(host: Column, suffix: Column) -> Column:
    """The suffix and one label more; an address is a domain of its own."""
    plain = F.regexp_replace(host, _PLAIN, "")
    labels = F.split(plain, "[.]")
    wanted = F.least(F.size(F.split(suffix, "[.]")) + 1, F.size(labels))
    return F.when(plain.rlike(_ADDRESS), plain).otherwise(F.array_join(F.slice(labels, F.size(labels) - wanted + 1, wanted), "."))


def _run_strength(units: DataFrame) -> float:
    """Weight of a prior, in pages: from how much more the units differ from their priors than chance allows.

    `units` has good, labelled and prior. The variance of a share is prior * (1 - prior) / n *
    (1 + (n - 1) * correlation) under a beta-binomial; the weight is 1 / correlation - 1.
    """
    share = F.col("good") / F.col("labelled")
    spread = F.col("prior") * (1 - F.col("prior"))
    row = (
        units.where("labelled > 0")
        .agg(
            F.sum(F.col("labelled") * (share - F.col("prior")) ** 2).alias("found"),
            F.sum(spread).alias("chance"),
            F.sum(spread * (F.col("labelled") - 1)).alias("room"),
        )
        .first()
    )
    if not row["room"]:
        return 1.0
    correlation = min(max((row["found"] - row["chance"]) / row["room"], 0.001), 0.999)
    return round(1 / correlation - 1, 9)


def _shrunk(strength: float) -> Column:
    return (F.col("good") + strength * F.col("prior")) / (F.col("labelled") + strength)


def run_reputation(outcomes: DataFrame, suffixes: Sequence[str] = LONG_SUFFIXES) -> DataFrame:
    """(host, bound) per host of `outcomes` (host, good: null where a page has no label).

    Shares of good pages are shrunk from the suffix to the overall share, from the registered domain
    to its suffix, and from the host to its domain; each prior's weight is learned from all units of its
    level. Suffixes of several labels are those of `suffixes`; an address is its own domain. `bound` is the lower bound of the host's beta posterior, mean less 1.645 deviations. A host
    without labels has its domain's prior.
    """
    hosts = cut(
        outcomes.groupBy("host")
        .agg(F.sum(F.when(F.col("good"), 1).otherwise(0)).alias("good"), F.count("good").alias("labelled"))
        .withColumn("suffix", _suffix(F.col("host"), suffixes))
        .withColumn("domain", _domain(F.col("host"), F.col("suffix")))
    )

    def sums(*by: str) -> DataFrame:
        return hosts.groupBy(*by).agg(F.sum("good").alias("good"), F.sum("labelled").alias("labelled"))

    total = sums().first()
    overall = ((total["good"] or 0) + 0.5) / ((total["labelled"] or 0) + 1)
    suffixes = sums("suffix").withColumn("prior", F.lit(overall))
    suffixes = suffixes.select("suffix", _shrunk(_run_strength(suffixes)).alias("prior"))
    domains = sums("domain", "suffix").join(suffixes, "suffix")
    domains = domains.select("domain", "suffix", _shrunk(_run_strength(domains)).alias("prior"))
    units = hosts.join(domains, ["domain", "suffix"])
    strength = _run_strength(units)
    good = F.col("good") + strength * F.col("prior")
    bad = F.col("labelled") - F.col("good") + strength * (1 - F.col("prior"))
    deviation = F.sqrt(good * bad / ((good + bad) ** 2 * (good + bad + 1)))
    return units.select("host", F.round(good / (good + bad) - SIGMAS * deviation, 9).alias("bound"))


def run_judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_column: str = "page_id",
    url: str = "url",
    good: Column | None = None,
    outcomes: DataFrame | None = None,
    suffixes: Sequence[str] = LONG_SUFFIXES,
) -> DataFrame:
    """id, host, path, rule and verdict (allow or block) per page.

    The host stands after the first :// up to /, ? or #, A-Z lower-cased; the path goes from there up to
    ? or #. Both are empty without :// or url. The longest rule whose host is the url's or a parent
    of it and whose path starts the url's decides; of two equal patterns the blocking one.

    Other pages go by reputation: a host is allowed if the lower bound of its share of good pages is at
    least 0.5. Labelled outcomes are `good`, a condition on the pages (null where a page tells nothing),
    and the rows of `outcomes` (host, good) from elsewhere; with neither, pages with a rule are the
    labelled ones, good if allowed. Without any label every host is blocked, as nothing speaks for it. Ids
    may be null or repeat; empty tables are allowed; other columns are not looked at.
    """
    judged = F.lit(None).cast("boolean") if good is None else good
    split = pages.select(
        F.col(id_column).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"), judged.alias("good")
    )
    ruled = split.withColumn("found", first_fitting(rules, F.col("host"), F.col("path")))
    by_rule = good is None and outcomes is None
    known = ruled.select("host", (F.col("found.action") == "allow" if by_rule else F.col("good")).alias("good"))
    if outcomes is not None:
        # Hosts without pages speak for their domains.
        known = known.union(outcomes.select(F.lower("host"), F.col("good").cast("boolean")))
    reputation = run_reputation(known, suffixes).select(
        "host", F.when(F.col("bound") >= THRESHOLD, "allow").otherwise("block").alias("reputed")
    )
    return ruled.join(reputation, "host").select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("found.pattern").alias("rule"),
        F.coalesce("found.action", "reputed").alias("verdict"),
    )
