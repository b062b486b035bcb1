"""URL filter: host and path rules first, then the ratio of two character language models.

The models are Markov models of variable order, interpolated from order ``ORDER`` down to single
characters (Witten-Bell), one over accepted and one over rejected URLs. A URL is rejected when its log
likelihood ratio per character is below a cut calibrated on the URLs the models were counted on.
Everything is DataFrame operations.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.operators.materialize import materialize

ORDER = 3
#: Characters of the model besides those seen: the chance of a new one.
ALPHABET = 64
#: Scores are calibrated in steps of this size within these bounds.
STEP, BOUND = 0.05, 20.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Host words that mark a URL as an example of the rejected kind.
REJECTED_WORDS = ("pills", "bets", "casino", "adult", "porn", "spam", "ads", "viagra", "warez", "lottery")
#: (verdict, host/path) rules of the registered query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without it."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a parent domain and begins the path; else null."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _folded(host: Column, path: Column) -> Column:
    """The string the models see: digits count as one."""
    return F.regexp_replace(F.translate(F.concat(host, path), _UPPER, _LOWER), "[0-9]", "0")


def _grams(strings: DataFrame, *keep: str) -> DataFrame:
    """One row per character of ``folded`` and its end: the character after its ``ORDER`` predecessors."""
    padded = F.concat(F.lit("^" * ORDER), "folded", F.lit("$"))
    at = F.explode(F.sequence(F.lit(1), F.length("folded") + 1))
    return strings.select(*keep, padded.alias("padded"), at.alias("at")).select(*keep, F.col("padded").substr(F.col("at"), F.lit(ORDER + 1)).alias("gram"))


def fit_ratios(strings: DataFrame) -> DataFrame:
    """(gram, ratio): log of accepted over rejected probability of a gram's last character.

    ``strings`` has (folded, n, rejected): the string, how often it occurs, the model it belongs to.
    """
    seen = _grams(strings, "n", "rejected").groupBy("gram").agg(
        F.sum(F.when(F.col("rejected"), 0).otherwise(F.col("n"))).alias("good"), F.sum(F.when(F.col("rejected"), F.col("n")).otherwise(0)).alias("bad")
    )
    seen = materialize(seen, "grams")
    known = seen.select("gram")
    kinds = ("good", "bad")
    for kind in kinds:
        known = known.withColumn(f"p_{kind}", F.lit(1.0 / ALPHABET))
    for order in range(ORDER + 1):
        tail = F.col("gram").substr(ORDER + 1 - order, order + 1)
        before = F.col("gram").substr(ORDER + 1 - order, order) if order else F.lit("")
        counts = seen.groupBy(tail.alias("tail"), before.alias("context")).agg(*[F.sum(k).alias(k) for k in kinds])
        totals = counts.groupBy("context").agg(*[F.sum(k).alias(f"n_{k}") for k in kinds], *[F.sum((F.col(k) > 0).cast("long")).alias(f"t_{k}") for k in kinds])
        known = known.withColumn("tail", tail).join(counts.join(totals, "context").drop("context"), "tail").drop("tail")
        for k in kinds:
            mass = F.col(f"n_{k}") + F.col(f"t_{k}")
            known = known.withColumn(f"p_{k}", F.when(mass > 0, (F.col(k) + F.col(f"t_{k}") * F.col(f"p_{k}")) / mass).otherwise(F.col(f"p_{k}")))
        known = known.select("gram", *[f"p_{k}" for k in kinds])
    return known.select("gram", (F.log("p_good") - F.log("p_bad")).alias("ratio"))


def _cut(scored: DataFrame) -> float | None:
    """The score that parts rejected from accepted strings best; None when one kind is missing."""
    at = F.floor(F.least(F.greatest(F.col("score"), F.lit(-BOUND)), F.lit(BOUND)) / STEP)
    rows = scored.groupBy(at.alias("at")).agg(F.sum(F.when(F.col("rejected"), F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("rejected"), 0).otherwise(F.col("n"))).alias("good")).collect()
    bad, good = sum(r["bad"] for r in rows), sum(r["good"] for r in rows)
    if not bad or not good:
        return None
    best, cut, caught, lost = 0.0, -BOUND, 0, 0
    for r in sorted(rows, key=lambda r: r["at"]):
        caught, lost = caught + r["bad"], lost + r["good"]
        if caught / bad - lost / good > best:
            best, cut = caught / bad - lost / good, (r["at"] + 1) * STEP
    return cut


def judge_urls(pages: DataFrame, rules=RULES, rejected_words=REJECTED_WORDS) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, score.

    The verdict is the longest fitting rule's, else ``block`` when the score (mean log ratio, accepted
    over rejected) is below the cut, else ``allow``. A null url, or one without ``://``, has empty host
    and path and is judged as the empty string. Without URLs of both kinds the method allows. Repeated
    rows get equal results, further columns are ignored, an empty table gives no rows.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    parted = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parted = parted.withColumn("folded", _folded(F.col("host"), F.col("path")))
    marked = F.col("host").rlike("(^|[.-])(" + "|".join(map(re.escape, rejected_words)) + ")([.-]|$)")
    strings = materialize(parted.groupBy("folded", marked.alias("rejected")).agg(F.count("*").alias("n")), "strings")
    ratios = materialize(fit_ratios(strings), "ratios")
    scores = _grams(strings.select("folded").distinct(), "folded").join(ratios, "gram").groupBy("folded").agg(F.avg("ratio").alias("score"))
    scores = materialize(scores, "scores")
    cut = _cut(strings.join(scores, "folded"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_score = F.lit("allow") if cut is None else F.when(F.col("score") < cut, "block").otherwise("allow")
    return parted.join(scores, "folded", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_score).alias("verdict"), "score")
