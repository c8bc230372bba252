"""URL filters: host reputation by empirical Bayes, with fixed rules before it.

Labelled outcomes of pages are counted per host. A beta-binomial prior hands
what is known of a suffix down to its registered domains, and of a domain down to
its hosts; how strongly is estimated at each level from how far the children
differ beyond chance. A page is blocked when the lower bound of its host's
posterior bad share is above a limit. DataFrame functions only.

Per-host tables are staged, so a host with a third of all pages is an aggregate
that combines before the shuffle, and a join whose rows AQE can split.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import staged

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Z = 1.645
LIMIT = 0.25
LEAST_RHO = 1e-3
MOST_RHO = 0.5

# Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "co.jp", "ne.jp", "or.jp", "com.au", "net.au", "org.au", "co.nz", "com.br", "co.in",
    "com.cn", "co.kr", "com.mx", "co.za", "com.tr",
)


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, where the path starts with ``/`` and the rule's path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}/{self.path}"


def rule_of(verdict: str, text: str) -> Rule:
    host, _, path = text.partition("/")
    return Rule(verdict, host, path)


# Fixed values.
RULES = (
    rule_of("allow", "com/"),
    rule_of("block", "example.com/en/"),
    rule_of("allow", "www.example.com/en/"),
    rule_of("block", "net/es/"),
    rule_of("block", "net/fr/"),
)


# -- parts of a url ----------------------------------------------------------


def _after_scheme(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), "^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    """The last label, or the last two where names are registered below two."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    """The suffix and the label before it; the host itself if there is none."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two)


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``, null if none fits; of equally long ones the first given."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.text))):
        fits = (F.concat(F.lit("."), host).endswith("." + rule.host)) & path.startswith("/" + rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


# -- reputation --------------------------------------------------------------


def _strength(children: DataFrame) -> float:
    """The prior's weight in rows, by the method of moments, from ``n``, ``k`` and the parent's share ``prior``.

    Children that differ no more than chance would have them give the largest
    weight, 1 / ``LEAST_RHO`` - 1; without labelled rows it is the largest too.
    """
    spread = F.col("prior") * (1 - F.col("prior"))
    excess, room = (
        children.where("n > 0")
        .agg(
            F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("prior"), 2) - spread),
            F.sum(spread * (F.col("n") - 1)),
        )
        .first()
    )
    rho = min(MOST_RHO, max(LEAST_RHO, excess / room)) if room else LEAST_RHO
    return 1 / rho - 1


def _shrunk(children: DataFrame) -> DataFrame:
    """Add ``alpha``, ``beta`` and the posterior mean ``share`` to rows of ``n``, ``k`` and ``prior``."""
    strength = _strength(children)
    return children.select(
        "*", (F.col("k") + strength * F.col("prior")).alias("alpha"),
        (F.col("n") - F.col("k") + strength * (1 - F.col("prior"))).alias("beta"),
    ).withColumn("share", F.col("alpha") / (F.col("alpha") + F.col("beta")))


def reputations(
    outcomes: DataFrame, z: float = Z, two_labels: tuple[str, ...] = TWO_LABEL_SUFFIXES,
) -> tuple[DataFrame, float]:
    """``(host, n, k, share, lower)`` per host out of rows ``(host, bad)``, and the share of all rows.

    ``bad`` is a boolean; rows where it is null count for no outcome but their
    host is listed all the same, with what its domain tells. A null host is the empty host.
    """
    hosts = staged(
        outcomes.groupBy(F.coalesce("host", F.lit("")).alias("host"))
        .agg(F.count("bad").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("k"))
        .withColumns({"domain": domain_of(F.col("host"), two_labels), "suffix": suffix_of(F.col("host"), two_labels)})
    )
    n, k = hosts.agg(F.sum("n"), F.sum("k")).first()
    overall = ((k or 0) + 1) / ((n or 0) + 2)
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = staged(hosts.groupBy("domain", "suffix").agg(*sums))
    suffixes = staged(domains.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(overall)))
    above = _shrunk(suffixes).select("suffix", F.col("share").alias("prior"))
    above = _shrunk(staged(domains.join(above, "suffix"))).select("domain", F.col("share").alias("prior"))
    found = _shrunk(staged(hosts.join(above, "domain")))
    weight = F.col("alpha") + F.col("beta")
    deviation = F.sqrt(F.col("share") * (1 - F.col("share")) / (weight + 1))
    return found.select("host", "n", "k", "share", (F.col("share") - z * deviation).alias("lower")), overall


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT, z: float = Z,
    url_col: str = "url", two_labels: tuple[str, ...] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``n``, ``k`` and ``lower`` added or replaced.

    ``outcomes`` has rows ``(host, bad)``. Hosts it doesn't know are allowed
    unless a rule says otherwise. A null url has an empty host and path.
    ``two_labels`` are the suffixes of two labels; a full list may be given.
    """
    known = staged(reputations(outcomes, z, two_labels)[0].drop("share"))
    parts = pages.select(
        F.struct(*pages.columns).alias("page"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
    )
    found = parts.join(known, "host", "left").withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("lower") > limit, "block").otherwise("allow")
    added = {
        "host": F.col("host"), "path": F.col("path"), "rule": F.col("_rule.rule"),
        "verdict": F.coalesce("_rule.verdict", own), "n": F.coalesce("n", F.lit(0)), "k": F.coalesce("k", F.lit(0)),
        "lower": F.col("lower"),
    }
    kept = [F.col(f"page.{c}").alias(c) for c in pages.columns if c not in added]
    return found.select(*kept, *[c.alias(name) for name, c in added.items()])


def page_outcomes(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """``(host, bad)`` per page and label: a page shows the document its path names (``/lang/doc_id``).

    Pages without a label, or with one that is neither 0 nor 1, come once with a
    null ``bad``; pages whose document has several labels come once for each.
    """
    document = F.regexp_extract(path_of(F.col(url_col)), "^/[a-z]+/([0-9]{1,18})([./]|$)", 1)
    shown = pages.select(host_of(F.col(url_col)).alias("host"), document.try_cast("bigint").alias("doc"))
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("doc"), (F.col("quality") == 0).alias("bad"))
    return shown.join(known, "doc", "left").select("host", "bad")
