"""Filter URLs by the reputation of their host, in DataFrame functions only.

Labelled pages give each host a number of good and bad outcomes. The share of
bad pages of a suffix is drawn towards that of all pages, of a registered domain
towards its suffix, of a host towards its domain: each posterior is the
mean of the next level's beta prior. How strongly a level is drawn is
estimated from the spread of its own counts (moments of the beta-binomial
distribution). A host is blocked if the lower bound of its posterior exceeds
``most_bad``. Explicit rules come before the reputation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.common import stored

#: Fixed values of the contract: (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Suffixes of more than one label under which names are registered, as far as no table of them is given; any other is the last label.
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
#: Labels that a suffix has at most.
MOST_LABELS = 5
MOST_BAD = 0.5
#: One-sided bound at 95 % of the normal approximation.
Z = 1.645
#: Limits of the correlation within a group, so that no prior is empty or absolute.
CORRELATION = (0.001, 0.5)

#: A group with more labels tells no more of the correlation than one with so many.
LARGE = 100

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def with_suffix(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``hosts`` (host, once each) with ``suffix`` and registered ``domain``, which has one label more.

    ``suffixes`` has a column ``suffix`` with public suffixes, such as ``co.uk``, ``*.ck`` for all names one label below,
    and ``!www.ck`` for exceptions from that. The longest one that a host ends with counts, an exception before all others
    (its suffix is one label shorter); without any it is the last label. A host that is a suffix itself is its own domain.
    """
    if suffixes is None:
        suffixes = hosts.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, LONG_SUFFIXES))).alias("suffix"))
    rules = suffixes.where("suffix IS NOT NULL").select(F.lower(F.trim("suffix")).alias("rule")).distinct()
    labels = lambda c: F.size(F.split(c, r"\."))
    tails = hosts.select("host", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.least(labels("host"), F.lit(MOST_LABELS))), lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n)))).alias("tail"))
    above = F.concat(F.lit("*."), F.regexp_replace("tail", r"^[^.]*\.", ""))
    asked = tails.select("host", F.inline(F.array(*[F.struct(rule.alias("rule"), (labels("tail") - less).alias("n"), F.lit(rank).alias("rank")) for rule, less, rank in (
        (F.col("tail"), 0, 0), (F.when(F.col("tail").contains("."), above), 0, 0), (F.concat(F.lit("!"), "tail"), 1, 1),
    )])))
    fits = asked.where("rule IS NOT NULL").join(rules, "rule", "left_semi").groupBy("host").agg(F.max(F.struct("rank", "n")).alias("best"))
    n = F.coalesce(F.col("best.n"), F.lit(1))
    tail = lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n)
    return hosts.join(fits, "host", "left").select(*hosts.columns, tail(n + 1).alias("domain"), tail(n).alias("suffix"))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, f"{name}{start}").otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _strength(level: DataFrame) -> float:
    """Pseudo-counts of the prior, from how far counts scatter beyond chance around their prior mean.

    Groups weigh with their pairs of labels, those beyond ``LARGE`` labels with the pairs of so many: a few
    groups that hold most of the rows do not decide for all others.
    """
    p, n = F.col("prior"), F.col("n")
    chance = p * (1 - p)
    held = F.least(n, F.lit(LARGE))
    pairs = held * (held - 1)
    row = level.where("n > 1").agg(F.sum(pairs / (n * (n - 1)) * ((F.col("bad") - n * p) ** 2 - n * chance)), F.sum(pairs * chance)).first()
    low, high = CORRELATION
    share = row[0] / row[1] if row[1] else high
    return 1 / min(max(share, low), high) - 1


def _posterior(level: DataFrame) -> DataFrame:
    m = _strength(level)
    mean = (F.col("bad") + m * F.col("prior")) / (F.col("n") + m)
    out = level.withColumn("mean", mean).withColumn("bound", mean - Z * F.sqrt(mean * (1 - mean) / (F.col("n") + m + 1)))
    return out.drop("prior")


def reputation(outcomes: DataFrame, hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """(host, domain, suffix, n, bad, mean, bound) of every host in ``hosts`` (host).

    ``outcomes`` has host and bad (boolean) for each labelled page; rows with
    null are ignored. A host without labels has the posterior of its
    domain's prior. Without any label every mean is 0.5. ``suffixes`` is a table for :func:`with_suffix`.
    """
    ones = outcomes.where("host IS NOT NULL AND bad IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    named = hosts.select("host").where("host IS NOT NULL").distinct().join(ones, "host", "left").na.fill(0, ["n", "bad"])
    named = stored(with_suffix(named, suffixes), "hosts")
    domains = stored(named.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    endings = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = endings.agg(F.sum("bad"), F.sum("n")).first()
    overall = ((total[0] or 0) + 0.5) / ((total[1] or 0) + 1)
    endings = _posterior(endings.withColumn("prior", F.lit(overall)))
    priors = endings.select("suffix", F.col("mean").alias("prior"))
    domains = _posterior(domains.join(priors, "suffix"))
    priors = domains.select("domain", F.col("mean").alias("prior"))
    return _posterior(named.join(priors, "domain"))


def filter_pages(pages: DataFrame, outcomes: DataFrame, rules=RULES, most_bad: float = MOST_BAD, suffixes: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, mean, bound) of every row of ``pages`` (page_id, url; other columns are ignored).

    ``outcomes`` has page_id and bad (boolean) for labelled pages. The verdict
    is that of the longest fitting rule; without one, block if the lower bound of the host's
    posterior exceeds ``most_bad``, else allow. A null URL or one without
    ``://`` has an empty host and path, which is judged like any other host.
    Rows with a null page_id are judged but carry no outcome. Repeated rows
    come out as often as they came in; an empty table gives an empty result.
    """
    url = F.col("url").cast("string")
    placed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    labelled = placed.join(outcomes.select("page_id", "bad"), "page_id").select("host", "bad")
    known = reputation(labelled, placed, suffixes).select("host", "mean", "bound")
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > most_bad, "block").otherwise("allow")
    return placed.join(known, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict"), "mean", "bound")
