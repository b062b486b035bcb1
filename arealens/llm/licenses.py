"""License scans: phrase counts, and ordered signature rules with interval suppression.

A rule is a regular expression with keywords and a priority. Sentences, which end at stops and blank lines but not at
other line ends, never meet a rule without a keyword that every match of its expression has. All matches of a rule count.
Where detections of a sentence overlap so that one interval contains the other, the one
with the higher priority stays (then the longer, then the earlier rule). Everything is DataFrame
operations inside the row: no join, no shuffle.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.functions.bind import bind

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of the phrase count; before lower-casing A-Z are word characters too.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Label by phrase; each phrase ends in the same word.
PHRASES = (("mit", ("mit", "license")), ("apache", ("apache", "license")), ("gpl", ("general", "public", "license")))


class Rule(NamedTuple):
    label: str
    #: Every match holds one keyword of each group.
    keywords: tuple[tuple[str, ...], ...]
    pattern: str
    priority: int


#: (label, name as written, keywords one of which every name holds, home page) of licenses; the rules for each are built below.
FAMILIES = (
    ("mit", r"mit|expat|x11", ("mit", "expat", "x11"), "opensource.org/licenses/mit"),
    ("apache-2.0", r"apache(?: software)?(?: license)?,?[ -]?(?:version|v)? ?2(?:\.0)?", ("apache",), "apache.org/licenses/license-2.0"),
    ("apache-1.1", r"apache(?: software)?(?: license)?,?[ -]?(?:version|v)? ?1\.1", ("apache",), "apache.org/licenses/license-1.1"),
    ("gpl-2.0", r"(?:gnu )?(?:general public license|gpl),?[ -]?(?:version|v)? ?2(?:\.0)?", ("general public license", "gpl"), "gnu.org/licenses/gpl-2.0"),
    ("gpl-3.0", r"(?:gnu )?(?:general public license|gpl),?[ -]?(?:version|v)? ?3(?:\.0)?", ("general public license", "gpl"), "gnu.org/licenses/gpl-3.0"),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser general public license|lgpl),?[ -]?(?:version|v)? ?2\.1", ("lesser general public license", "lgpl"), "gnu.org/licenses/lgpl-2.1"),
    ("lgpl-3.0", r"(?:gnu )?(?:lesser general public license|lgpl),?[ -]?(?:version|v)? ?3(?:\.0)?", ("lesser general public license", "lgpl"), "gnu.org/licenses/lgpl-3.0"),
    ("agpl-3.0", r"(?:gnu )?(?:affero general public license|agpl),?[ -]?(?:version|v)? ?3(?:\.0)?", ("affero general public license", "agpl"), "gnu.org/licenses/agpl-3.0"),
    ("bsd-2-clause", r"(?:bsd 2-clause|2-clause bsd|simplified bsd|freebsd)", ("bsd",), "opensource.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", r"(?:bsd 3-clause|3-clause bsd|new bsd|modified bsd)", ("bsd",), "opensource.org/licenses/bsd-3-clause"),
    ("0bsd", r"(?:zero-clause bsd|bsd zero clause|0bsd)", ("bsd",), "opensource.org/licenses/0bsd"),
    ("mpl-1.1", r"(?:mozilla public license|mpl),?[ -]?(?:version|v)? ?1\.1", ("mozilla public license", "mpl"), "mozilla.org/mpl/1.1"),
    ("mpl-2.0", r"(?:mozilla public license|mpl),?[ -]?(?:version|v)? ?2(?:\.0)?", ("mozilla public license", "mpl"), "mozilla.org/mpl/2.0"),
    ("epl-1.0", r"(?:eclipse public license|epl),?[ -]?(?:version|v)? ?1(?:\.0)?", ("eclipse public license", "epl"), "eclipse.org/legal/epl-v10"),
    ("epl-2.0", r"(?:eclipse public license|epl),?[ -]?(?:version|v)? ?2(?:\.0)?", ("eclipse public license", "epl"), "eclipse.org/legal/epl-2.0"),
    ("cddl-1.0", r"(?:common development and distribution license|cddl)", ("common development and distribution license", "cddl"), "opensource.org/licenses/cddl-1.0"),
    ("cpl-1.0", r"common public license", ("common public license",), "opensource.org/licenses/cpl1.0"),
    ("artistic-2.0", r"artistic(?: license)?,?[ -]?(?:version|v)? ?2(?:\.0)?", ("artistic",), "opensource.org/licenses/artistic-2.0"),
    ("isc", r"isc", ("isc",), "opensource.org/licenses/isc"),
    ("zlib", r"(?:zlib|zlib/libpng)", ("zlib",), "opensource.org/licenses/zlib"),
    ("bsl-1.0", r"boost software", ("boost software",), "boost.org/license_1_0"),
    ("unlicense", r"unlicense", ("unlicense",), "unlicense.org"),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public)", ("wtfpl", "do what the fuck"), "wtfpl.net"),
    ("postgresql", r"postgresql", ("postgresql",), "opensource.org/licenses/postgresql"),
    ("python-2.0", r"(?:psf|python software foundation)", ("psf", "python software foundation"), "docs.python.org/3/license"),
    ("ruby", r"ruby", ("ruby",), "ruby-lang.org/en/about/license"),
    ("php-3.01", r"php(?: license)?,?[ -]?(?:version|v)? ?3\.01", ("php",), "php.net/license/3_01"),
    ("openssl", r"openssl", ("openssl",), "openssl.org/source/license"),
    ("ncsa", r"(?:ncsa|university of illinois/ncsa)", ("ncsa",), "opensource.org/licenses/ncsa"),
    ("ms-pl", r"(?:microsoft public|ms-pl)", ("microsoft public", "ms-pl"), "opensource.org/licenses/ms-pl"),
    ("eupl-1.2", r"(?:european union public|eupl)", ("european union public", "eupl"), "joinup.ec.europa.eu/software/page/eupl"),
    ("ofl-1.1", r"(?:sil )?open font", ("open font",), "scripts.sil.org/ofl"),
    ("cc0-1.0", r"(?:cc0|creative commons zero)", ("cc0", "creative commons zero"), "creativecommons.org/publicdomain/zero"),
    ("cc-by", r"(?:cc[ -]by|creative commons attribution)(?![ -](?:nc|nd|sa|non|no|share))", ("cc by", "cc-by", "creative commons attribution"), "creativecommons.org/licenses/by/"),
    ("cc-by-sa", r"(?:cc[ -]by-sa|creative commons attribution[ -]sharealike)", ("cc by", "cc-by", "creative commons attribution"), "creativecommons.org/licenses/by-sa/"),
    ("cc-by-nd", r"(?:cc[ -]by-nd|creative commons attribution[ -]noderiv\w*)", ("cc by", "cc-by", "creative commons attribution"), "creativecommons.org/licenses/by-nd/"),
    ("cc-by-nc", r"(?:cc[ -]by-nc|creative commons attribution[ -]noncommercial)(?![ -](?:nd|sa|no|share))", ("cc by", "cc-by", "creative commons attribution"), "creativecommons.org/licenses/by-nc/"),
    ("cc-by-nc-sa", r"(?:cc[ -]by-nc-sa|creative commons attribution[ -]noncommercial[ -]sharealike)", ("cc by", "cc-by", "creative commons attribution"), "creativecommons.org/licenses/by-nc-sa/"),
    ("cc-by-nc-nd", r"(?:cc[ -]by-nc-nd|creative commons attribution[ -]noncommercial[ -]noderiv\w*)", ("cc by", "cc-by", "creative commons attribution"), "creativecommons.org/licenses/by-nc-nd/"),
    ("odbl-1.0", r"(?:open database|odbl)", ("open database", "odbl"), "opendatacommons.org/licenses/odbl"),
)

#: What may follow a name: version, country of a version, later versions.
_TAIL = r"(?:-\d+(?:\.\d+)+(?:-[a-z]{2,3})?)?(?:-only|-or-later|\+)?"
#: (priority, pattern around a family's name {n}, home page {u} or label {l}, keywords one of which the shape itself holds).
SHAPES = (
    (100, r"spdx-license-identifier:\s*\(*{l}{t}(?![\w+-]|\.\w)", ("spdx",)),
    (95, r"{u}", ()),
    (90, r"(?:licensed|released|distributed|published|available|redistributed) under (?:the )?(?:terms of )?(?:the )?(?:{n}){t}(?![\w-])(?:,? licen[sc]e)?", ("under",)),
    (80, r"licen[sc]e\s*[:=]\s*\W?(?:{n}){t}(?![\w-])", ("licen",)),
    (70, r"(?<![\w-])(?:{n}){t}(?:['’]s)? (?:public )?licen[sc]e(?!\w)", ("licen",)),
    (60, r"(?:subject to|terms of|covered by|governed by|conditions of) (?:the )?(?:{n}){t}(?![\w-])", ("subject to", "terms of", "covered by", "governed by", "conditions of")),
)

#: Wording of license texts and notices without a family's name.
WORDINGS = (
    Rule("mit", (("permission is hereby granted",),), r"permission is hereby granted, free of charge, to any person obtaining a copy", 85),
    Rule("isc", (("permission to use",),), r"permission to use, copy, modify, and(?:/or)? distribute this software", 85),
    Rule("bsd-3-clause", (("neither the name",),), r"neither the name of .{1,80} nor the names of (?:its )?contributors", 86),
    Rule("bsd-2-clause", (("redistribution and use",),), r"redistribution and use in source and binary forms", 84),
    Rule("gpl-family", (("general public licen",),), r"(?:gnu )?general public licen[sc]e", 50),
    Rule("gpl-family", (("free software",),), r"this program is free software[:;] you can redistribute it", 55),
    Rule("bsd-family", (("bsd",),), r"(?<![\w-])bsd(?:-style)? licen[sc]e", 50),
    Rule("cc-by", (("cc by", "cc-by"),), r"(?<![\w-])cc[ -]by[ -]\d\.\d", 65),
    Rule("cc-by-sa", (("cc by", "cc-by"),), r"(?<![\w-])cc[ -]by-sa[ -]\d\.\d", 65),
    Rule("cc-by-nd", (("cc by", "cc-by"),), r"(?<![\w-])cc[ -]by-nd[ -]\d\.\d", 65),
    Rule("cc-by-nc", (("cc by", "cc-by"),), r"(?<![\w-])cc[ -]by-nc[ -]\d\.\d", 65),
    Rule("cc-by-nc-sa", (("cc by", "cc-by"),), r"(?<![\w-])cc[ -]by-nc-sa[ -]\d\.\d", 65),
    Rule("cc-by-nc-nd", (("cc by", "cc-by"),), r"(?<![\w-])cc[ -]by-nc-nd[ -]\d\.\d", 65),
    Rule("zlib", (("as-is",),), r"this software is provided 'as-is', without any express or implied warranty", 85),
    Rule("unlicense", (("unencumbered",),), r"free and unencumbered software released into the public domain", 85),
    Rule("public-domain", (("public domain",),), r"(?:in|into|to) the public domain", 40),
    Rule("proprietary", (("rights reserved",),), r"all rights reserved", 30),
    Rule("proprietary", (("confidential",),), r"confidential and proprietary", 35),
    Rule("copyright", (("copyright",),), r"copyright (?:\(c\)|©)? ?(?:19|20)\d\d", 20),
    Rule("copyright", (("©",),), r"© ?(?:19|20)\d\d", 20),
    Rule("unknown-license", (("licen",),), r"licen[sc]ed under ", 10),
)


def build_rules() -> tuple[Rule, ...]:
    """All rules in order: every shape for every family, then the wordings."""
    made = []
    for label, name, keywords, home in FAMILIES:
        for priority, shape, held in SHAPES:
            pattern = shape.replace("{n}", name).replace("{u}", re.escape(home)).replace("{l}", re.escape(label)).replace("{t}", _TAIL)
            groups = ((home,),) if "{u}" in shape else (keywords, held) if "{n}" in shape else (held,)
            made.append(Rule(label, groups, pattern, priority))
    return (*made, *WORDINGS)


RULES = build_rules()
#: A text without any of these meets no rule.
_GATE = r"(?i)licen[sc]|spdx|under |terms of|governed by|covered by|subject to|conditions of|permission|redistribution|contributors|public domain|rights reserved|confidential|copyright|©|free software|unencumbered|as-is|cc[ -]by|\.org|\.net|\.eu"
#: Sentences end at stops followed by white space, and at blank lines.
_SENTENCE_END = r"\n[ \t\r]*\n\s*|(?<=[.!?;])\s+"
#: Between the identifiers of an SPDX expression.
_SPDX_NEXT = r"(?<=spdx-license-identifier:[\w.+() \t-]{0,200})[ \t]+(?:or|and|with)[ \t]+\(*"
#: White space, a line end with the marks of a comment around it.
_BLANKS = r"[ \t\r\f]*\n[ \t]*(?:(?:[*#;%]+|//+|--)(?=\s))?[ \t]*|[ \t\r\f]+"


def _intervals(order: int, rule: Rule):
    """Detections of one rule from its matches and the text between them."""

    def length(texts: Column, n: Column) -> Column:
        return F.aggregate(F.slice(texts, F.lit(1), n), F.lit(0), lambda total, t: total + F.length(t))

    def of(z: Column) -> Column:
        def hit(match: Column, i: Column) -> Column:
            start = length(z["between"], i + 1) + length(z["matches"], i) + 1
            return F.struct(
                F.lit(rule.label).alias("label"), F.lit(rule.priority).alias("priority"), F.lit(order).alias("rule"), start.alias("start"), (start + F.length(match)).alias("end")
            )

        return F.transform(z["matches"], hit)

    return of


def _detections(sentence: Column, rules: tuple[Rule, ...]) -> Column:
    """All intervals of each rule in a lower-cased sentence."""
    found = []
    for order, rule in enumerate(rules):
        pair = F.struct(F.regexp_extract_all(sentence, F.lit(rule.pattern), F.lit(0)).alias("matches"), F.split(sentence, rule.pattern).alias("between"))
        held = [reduce(or_, [sentence.contains(k) for k in group]) for group in rule.keywords]
        found.append(F.when(reduce(and_, held), bind(pair, _intervals(order, rule))))
    return F.flatten(F.filter(F.array(*found), lambda d: d.isNotNull()))


def _standing(found: Column) -> Column:
    """Detections that no stronger one contains."""

    def beats(e: Column, d: Column) -> Column:
        longer = (e["end"] - e["start"]) - (d["end"] - d["start"])
        stronger = (e["priority"] > d["priority"]) | ((e["priority"] == d["priority"]) & ((longer > 0) | ((longer == 0) & (e["rule"] < d["rule"]))))
        return stronger & (e["start"] <= d["start"]) & (e["end"] >= d["end"])

    return F.filter(found, lambda d: ~F.exists(found, lambda e: beats(e, d)))


def _phrase_places(words: Column) -> Column:
    """(start, label) of each phrase; words counted from 0."""
    last = "license"

    def place(i: Column) -> Column:
        out = F.lit(None).cast("struct<start:int,label:string>")
        for label, phrase in PHRASES:
            fits = F.lit(True)
            for back, word in enumerate(reversed(phrase[:-1]), 1):
                fits = fits & (F.get(words, i - back) == word)
            out = F.when(fits, F.struct((i - len(phrase) + 1).alias("start"), F.lit(label).alias("label"))).otherwise(out)
        return out

    at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), lambda i: F.get(words, i) == last)
    return F.filter(F.transform(at, place), lambda p: p.isNotNull())


def scan_licenses(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    The base counts the places of ``PHRASES``; the rules add labels. ``score`` is the highest priority met over 100, 0.6 for a phrase alone, 0 without either.
    Null and empty texts have no words. Repeated rows get equal results; further columns are ignored;
    an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    lower = F.translate("text", _UPPER, _LOWER)
    words = F.when(F.col("text").rlike("(?i)license"), F.regexp_extract_all(lower, F.lit(_WORD), F.lit(0))).otherwise(F.array().cast("array<string>"))
    named = F.when(lower.contains("spdx-"), F.regexp_replace(lower, _SPDX_NEXT, " spdx-license-identifier: ")).otherwise(lower)
    sentences = F.filter(F.split(named, _SENTENCE_END), lambda s: s.rlike(_GATE))
    kept = F.when(F.col("text").rlike(_GATE), F.transform(sentences, lambda s: F.regexp_replace(s, _BLANKS, " "))).otherwise(F.array().cast("array<string>"))
    rows = rows.select("doc_id", F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words"), words.alias("words"), kept.alias("sentences"))
    rows = rows.withColumn("places", _phrase_places(F.col("words"))).withColumn("found", F.transform("sentences", lambda s: _detections(s, rules)))
    rows = rows.withColumn("detections", F.flatten(F.transform("found", _standing)))
    starts, base = F.transform("places", lambda p: p["start"]), F.transform("places", lambda p: p["label"])
    labels = F.array_union(base, F.transform("detections", lambda d: d["label"]))
    best = F.array_max(F.transform("detections", lambda d: d["priority"])) / 100
    score = F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("places") > 0, 0.6).otherwise(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(labels)), ",").alias("labels"),
        score.alias("score"),
        "detections",
    )
