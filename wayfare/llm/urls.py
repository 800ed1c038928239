"""URL filtering: stated rules first, then the reputation of hosts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm import quality
from wayfare.llm.common import ascii_lower, let
from wayfare.session import written


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and a path's start."""

    verdict: str
    prefix: str

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.prefix.partition("/")[2]


RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

# Suffixes of more than one label; extend by parameter.
LONG_SUFFIXES = ("co.uk", "com.au", "co.jp", "com.br")


# Words of a host, alone or beside others, that name unwanted trades; extend by parameter.
UNWANTED = ("bet", "bets", "casino", "escort", "loans", "pills", "poker", "porn", "spam", "viagra", "xxx")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for a URL without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def visible_text(html: Column) -> Column:
    """What is left of a page without scripts, styles, comments and tags; empty for null.

    What is not closed runs to the end. Tags, and references to characters such as
    ``&amp;``, become a space.
    """
    text = F.coalesce(html, F.lit(""))
    for hidden in (
        r"(?is)<script[^<>]*>.*?(?:</script[^<>]*>|\z)",
        r"(?is)<style[^<>]*>.*?(?:</style[^<>]*>|\z)",
        r"(?s)<!--.*?(?:-->|\z)",
        r"<[^<>]*>",
        r"&#?[0-9A-Za-z]{1,10};",
    ):
        text = F.regexp_replace(text, hidden, " ")
    return text


def page_outcomes(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    unwanted: Sequence[str] = UNWANTED,
) -> DataFrame:
    """``key`` and ``bad`` for each page, judged by what it says and where it lies.

    A page is bad if its visible text breaks the threshold table of the quality rules
    or if a word of its host is unwanted. Words of a host are its runs of letters.
    A page without text breaks no threshold; null URLs and pages count as empty.
    Repeated rows and null keys stay, an empty table stays empty. One projection.
    """
    host, _ = host_and_path(F.col(url))
    # Each text is made once and each verdict is known not to be null, or the planner
    # would write the text into every count, and the verdict into a filter.
    fine = let(
        visible_text(F.col(html)),
        lambda text: let(
            quality.measures(text, but=["n_repeat_words"]), lambda found: quality.passes(found)
        ),
    )
    named = F.arrays_overlap(F.split(host, "[^a-z]+"), F.array(*map(F.lit, unwanted))) if unwanted else F.lit(False)
    return pages.select(F.col(key), F.coalesce(~fine | named, F.lit(False)).alias("bad"))


def domain_and_suffix(host: Column, long_suffixes: Sequence[str]) -> tuple[Column, Column]:
    """The registered domain and the public suffix of a host, by label count.

    A host of one label is its own suffix and domain.
    """
    two = F.substring_index(host, ".", -2)
    is_long = two.isin(*long_suffixes) if long_suffixes else F.lit(False)
    domain = F.when(is_long, F.substring_index(host, ".", -3)).otherwise(two)
    return domain, F.when(is_long, two).otherwise(F.substring_index(host, ".", -1))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule's text and verdict as a struct; null if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.prefix)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        hit = F.struct(F.lit(rule.prefix).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def _strength(counts: DataFrame, mean: str) -> float:
    """The strength of the beta prior that scatters groups around ``mean``.

    Moments: the squared deviations of the groups' bad pages, beyond what
    single draws explain, give the correlation within a group.
    """
    v = F.col(mean) * (1 - F.col(mean))
    off = F.col("bad") - F.col("n") * F.col(mean)
    row = counts.where("n > 0").agg(
        F.sum(off * off).alias("seen"),
        F.sum(F.col("n") * v).alias("drawn"),
        F.sum(F.col("n") * (F.col("n") - 1) * v).alias("pairs"),
    ).first()
    if not row["pairs"]:
        return 10.0  # no group has two labelled pages: nothing to learn from
    share = min(max((row["seen"] - row["drawn"]) / row["pairs"], 1e-4), 0.99)
    return round(1 / share - 1, 6)


def reputations(
    hosts: DataFrame, long_suffixes: Sequence[str] = LONG_SUFFIXES, z: float = 1.645
) -> DataFrame:
    """The posterior of each host's share of bad pages.

    ``hosts`` has one row per host: ``host``, ``n`` labelled pages, ``bad`` of
    them. The corpus mean is the prior mean of suffixes, a suffix's posterior
    mean that of its registered domains, a domain's that of its hosts; each level's
    prior strength comes from all its groups. Adds ``mean`` and ``lower``, the
    posterior mean less ``z`` standard deviations.
    """
    domain, suffix = domain_and_suffix(F.col("host"), long_suffixes)
    hosts = hosts.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    # Without any label nothing is known against anyone.
    overall = (total["bad"] + 1) / (total["n"] + 2) if total["n"] else 0.0

    def level(groups: DataFrame, prior: str, out: str) -> tuple[DataFrame, float]:
        strength = _strength(groups, prior)
        posterior = (F.col("bad") + strength * F.col(prior)) / (F.col("n") + strength)
        return groups.withColumn(out, posterior), strength

    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("overall", F.lit(overall))
    suffixes, _ = level(suffixes, "overall", "suffix_mean")
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    domains, _ = level(domains.join(suffixes.select("suffix", "suffix_mean"), "suffix"), "suffix_mean", "domain_mean")
    hosts = hosts.join(domains.select("domain", "domain_mean"), "domain")
    hosts, strength = level(hosts, "domain_mean", "mean")
    weight = F.col("n") + strength
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return hosts.select("host", "n", "bad", "mean", (F.col("mean") - z * spread).alias("lower"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    long_suffixes: Sequence[str] = LONG_SUFFIXES,
    z: float = 1.645,
    most_bad: float = 0.25,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to each page.

    ``outcomes`` labels pages: ``key`` and ``bad`` (boolean; null is skipped).
    The longest fitting rule decides; elsewhere a page is blocked if the
    lower posterior bound of its host's share of bad pages is above ``most_bad``.

    Labels meet pages on ``key`` and are counted per host before anything
    moves on, so a hot host costs one row per task. The hosts' table joins the pages
    by host; adaptive execution splits a hot host there. Several labels of one page
    all count. A page with a null key has no label; null URLs and such without
    ``://`` share the empty host. Columns with the results' names are replaced.
    """
    host, path = host_and_path(F.col(url))
    parsed = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    labelled = outcomes.where("bad IS NOT NULL").select(F.col(key).alias("url__key"), F.col("bad").cast("int").alias("url__bad"))
    counts = written(
        parsed.select(key, "host")
        .join(labelled, F.col(key) == F.col("url__key"), "left")
        .groupBy("host")
        .agg(F.count("url__bad").alias("n"), F.coalesce(F.sum("url__bad"), F.lit(0)).alias("bad")),
        "hosts",
    )
    known = reputations(counts, long_suffixes, z).select(
        "host", (F.col("lower") > most_bad).alias("url__block")
    )
    ruled = parsed.withColumn("url__rule", matched_rule(F.col("host"), F.col("path"), rules))
    return (
        ruled.join(known, "host", "left")
        .withColumn("rule", F.col("url__rule.rule"))
        .withColumn(
            "verdict",
            F.coalesce(
                F.col("url__rule.verdict"),
                F.when(F.col("url__block"), "block").otherwise("allow"),
            ),
        )
        .select(*parsed.columns, "rule", "verdict")
    )
