"""Rule-based classification of free text into group and subgroup."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.constants import CATEGORY_PRIORITY
from arealens.functions.text import WORD, WORD_END, WORD_START, match_text
from arealens.operators.materialize import materialize
from arealens.operators.skew import hottest_keys, lookup_join

UNKNOWN = "unknown"

# A small general rule set; real feeds pass their own mapping (see load_rules).
STARTER_RULES = {
    "violent": {
        "homicide": {"keywords": ["homicide", "murder"]},
        "robbery": {"keywords": ["robbery", "armed robbery"]},
        "assault": {"keywords": ["assault", "battery", "aggravated assault", "kidnapping"]},
    },
    "property": {
        "burglary": {"keywords": ["burglary", "breaking and entering", "b&e"]},
        "vehicle_theft": {"keywords": ["auto theft", "stolen vehicle"]},
        "theft": {"keywords": ["theft", "larceny", "shoplifting"]},
        "arson": {"keywords": ["arson"]},
        "fraud": {"keywords": ["fraud", "forgery", "identity theft"]},
    },
    "drug": {"drug": {"keywords": ["drug", "narcotics", "controlled substance"]}},
    "weapons": {"weapons": {"keywords": ["weapon", "firearm", "shots fired"]}},
    "public_order": {"disorder": {"keywords": ["trespass", "vandalism", "disorderly conduct"]}},
    "other": {"other": {"keywords": ["lost property", "missing person", "other"]}},
}


@dataclass(frozen=True)
class Rule:
    """All patterns of one subgroup in one tier."""

    tier: int  # 1 regular expression, 2 phrase, 3 single word
    group: str
    subgroup: str
    patterns: tuple[str, ...]


def load_rules(path: str) -> dict:
    """Rule mapping from a JSON or YAML file: group -> subgroup -> keywords / regexes."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            return json.load(handle)
        import yaml

        return yaml.safe_load(handle)


def _plain(keyword: str) -> str:
    text = re.sub(r"[!-/:-@\[-`{-~\s]+", " ", str(keyword).lower()).strip()
    return "" if str(keyword).strip().lower() in {"nan", "none", "null"} else text


def rule_list(mapping: dict, priority: list[str] | None = None) -> list[Rule]:
    """Rules in the order they win: tier, group priority, then position in the mapping."""
    priority = priority or CATEGORY_PRIORITY
    rules = []
    for group, subgroups in mapping.items():
        if not isinstance(subgroups, dict):
            continue
        for subgroup, spec in subgroups.items():
            spec = spec or {}
            words = list(dict.fromkeys(w for w in map(_plain, spec.get("keywords") or []) if w))
            for tier, patterns in (
                (1, list(spec.get("regexes") or [])),
                (2, [w for w in words if " " in w]),
                (3, [w for w in words if " " not in w]),
            ):
                if patterns:
                    rules.append(Rule(tier, group, subgroup, tuple(patterns)))
    rank = {g: i for i, g in enumerate(priority)}
    return sorted(rules, key=lambda r: (r.tier, rank.get(r.group, len(rank))))


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in text)


def _word(text: str) -> str:
    start = WORD_START if re.match(r"\w", text) else rf"(?<={WORD})"
    end = WORD_END if re.search(r"\w$", text) else rf"(?={WORD})"
    return f"{start}{_literal(text)}{end}"


def _matches(text: Column, tokens: Column, rule: Rule) -> Column:
    if rule.tier == 1:
        return reduce(lambda a, b: a | b, [text.rlike(p) for p in rule.patterns])
    if rule.tier == 2:
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in rule.patterns])
    whole = [p for p in rule.patterns if re.fullmatch(r"\w+", p)]
    odd = [p for p in rule.patterns if p not in whole]
    tests = [F.arrays_overlap(tokens, F.array(*[F.lit(p) for p in whole]))] if whole else []
    tests += [text.rlike(_word(p)) for p in odd]
    return reduce(lambda a, b: a | b, tests)


def classify_text(df: DataFrame, column: str, mapping: dict, priority: list[str] | None = None) -> DataFrame:
    """Add ``offense_normalized``, ``offense_group`` and ``offense_subgroup``.

    The first tier with a match wins over every later tier, whatever the priorities.
    The rules become one conditional chain: no join, no shuffle, rules are tried in
    winning order and evaluation stops at the first hit.
    """
    rules = rule_list(mapping, priority)
    prepared = df.withColumn("_text", match_text(F.col(column))).withColumn(
        "_tokens", F.array_distinct(F.split("_text", rf"[^\p{{L}}\p{{N}}_]+"))
    )
    text, tokens = F.col("_text"), F.col("_tokens")
    hit = F.when(text == "", F.lit(-1))
    for i, rule in enumerate(rules):
        hit = hit.when(_matches(text, tokens, rule), F.lit(i))
    hit = hit.otherwise(F.lit(-1))
    groups = F.array(*[F.lit(r.group) for r in rules]) if rules else F.array(F.lit(UNKNOWN))
    subgroups = F.array(*[F.lit(r.subgroup) for r in rules]) if rules else F.array(F.lit(UNKNOWN))
    scored = prepared.withColumn("_hit", hit)
    return scored.select(
        *df.columns,
        F.nullif(text, F.lit("")).alias("offense_normalized"),
        F.when(F.col("_hit") >= 0, F.get(groups, F.col("_hit"))).otherwise(UNKNOWN).alias("offense_group"),
        F.when(F.col("_hit") >= 0, F.get(subgroups, F.col("_hit"))).otherwise(UNKNOWN).alias("offense_subgroup"),
    )


def classify_distinct(df: DataFrame, column: str, mapping: dict, priority: list[str] | None = None) -> DataFrame:
    """As :func:`classify_text`, but every distinct text is classified once and joined back.

    Worth it for much repeated labels; texts meet by their digest, so long ones are no join keys.
    """
    keyed = df.withColumn("_text_key", F.sha2(F.col(column).cast("string"), 256))
    counted = keyed.where(F.col(column).isNotNull()).groupBy("_text_key").agg(F.count(F.lit(1)).alias("_rows"), F.first(column).alias(column))
    outputs = ["offense_normalized", "offense_group", "offense_subgroup"]
    known = materialize(classify_text(counted, column, mapping, priority).select("_text_key", "_rows", *outputs), "classified")
    joined = lookup_join(keyed, known.select("_text_key", *outputs), ["_text_key"], hottest_keys(known, ["_text_key"], "_rows"))
    return joined.select(
        *df.columns,
        "offense_normalized",
        F.coalesce("offense_group", F.lit(UNKNOWN)).alias("offense_group"),
        F.coalesce("offense_subgroup", F.lit(UNKNOWN)).alias("offense_subgroup"),
    )
