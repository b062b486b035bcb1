"""URL filter, decontamination, chat formatting and license scans against direct computation."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from arealens.llm.chat_format import digest_conversations, format_conversations, parse_formatted
from arealens.llm.decontaminate import drop_leaks, find_leaks, mark_leaks
from arealens.llm.licenses import PHRASES, RULES, _detections, scan_licenses
from arealens.llm.url_filter import ORDER, fit_ratios, judge_urls
from tests.llm.helpers import ODD_TEXTS, UPPER, documents, prose

URLS = [
    None, "", "nothing", "http://", "http://NET", "http://a.net/x", "https://example.net/en/1?q#z", "http://www.Example.NET/en/", "http://example.net/de/", "http://b.example.com/de/9",
    "http://notexample.com/de/", "ftp://x.org/fr/é", "http://org/fr/", "http://x.org?fr/", "://y.net/", "http://a.com#/de/", "http://spam-one.com/1", "http://spam-one.com/2", "http://good.com/1",
]


def expected(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(UPPER)
    best = None
    for verdict, rule in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")):
        domain, _, tail = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return host, path, best


def test_urls(spark):
    rows = [(i, u, "other") for i, u in enumerate(URLS)]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()}
    for i, url in enumerate(URLS):
        host, path, best = expected(url)
        assert (got[i].host, got[i].path) == (host, path), url
        assert got[i].rule == (best[0] if best else None) and (best is None or got[i].verdict == best[1]), url
    assert got[URLS.index("http://spam-one.com/1")].verdict == "block" and got[URLS.index("http://good.com/1")].verdict == "allow"
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(none).collect() == []
    clean = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert judge_urls(clean).first().verdict == "allow"


def test_url_ratios_equal_direct_computation(spark):
    strings = [("a.com/00", 3, False), ("b.com/00", 1, False), ("spam.com/0", 2, True), ("", 1, False)]
    got = {r.gram: r.ratio for r in fit_ratios(spark.createDataFrame(strings, "folded string, n long, rejected boolean")).collect()}
    counts = {False: Counter(), True: Counter()}
    for text, n, rejected in strings:
        padded = "^" * ORDER + text + "$"
        for i in range(ORDER, len(padded)):
            for k in range(ORDER + 1):
                counts[rejected][padded[i - k : i], padded[i]] += n

    def chance(side, context, char):
        p = 1 / 64
        for k in range(len(context) + 1):
            seen = {c: n for (ctx, c), n in counts[side].items() if ctx == context[len(context) - k :]}
            if seen:
                p = (seen.get(char, 0) + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    assert len(got) > 20
    for gram, ratio in got.items():
        assert ratio == pytest.approx(math.log(chance(False, gram[:-1], gram[-1]) / chance(True, gram[:-1], gram[-1])))


ITEM = "A train leaves Bern at 9.30 with 120 kg of mail and meets Anna after 45 minutes on the bridge"


def test_verbatim_leaks_in_other_dress(spark):
    short = "What is the capital of Peru?"
    long = "The farmer Anna sold 250 kg of apples to Peter in Lima and then drove 12 miles home with Maria before the sun went down"
    texts = [f"Question: {short}", "question: Which is it, and what is the capital of Chile?", f"So: {short.replace('Peru', 'Chile')}", "So: Lima is the capital of Peru"]
    texts += [long.lower(), long.upper(), long.replace(" ", "\n"), long.replace(" ", "\t \u00a0 "), long.replace("Peter", "Jonas").replace(" ", "\n"), "nothing " + prose(3, 40)]
    benchmark = spark.createDataFrame([(1, short), (2, long)], "item_id long, text string")
    rows = [r["items"] for r in mark_leaks(documents(spark, texts), benchmark).orderBy("doc_id").collect()]
    assert rows == ["1", "1", "1", "", "2", "2", "2", "2", "2", ""]
    copies = {r.doc_id: r.same_values for r in find_leaks(documents(spark, texts), benchmark).collect()}
    assert [i for i, same in sorted(copies.items()) if same] == [0, 4, 5, 6, 7]


def test_leaks(spark):
    items = [(1, ITEM), (2, prose(7, 30)), (3, "too short"), (4, "Which rivers cross town"), (5, None), (6, ITEM)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    swapped = ITEM.replace("Bern", "Oslo").replace("9.30", "7").replace("120 kg", "4,5 mg").replace("Anna", "Peter").replace("45 minutes", "3 hours")
    twisted = ITEM.replace("A train", "A train") + ". " + "nothing else"
    texts = [*ODD_TEXTS, prose(1, 300), prose(2, 20) + " " + ITEM + " " + prose(3, 20), "Before. " + swapped, ITEM[:30], items[1][1].upper(), "xx which rivers cross town?", twisted]
    rows = {r.doc_id: r for r in mark_leaks(documents(spark, texts), benchmark).collect()}
    assert len(rows) == len(texts)
    at = len(ODD_TEXTS)
    assert [rows[at + k].items for k in range(7)] == ["", "1,6", "1,6", "", "2", "4", "1,6"]
    assert not any(rows[k].contaminated for k in range(at))
    found = {r.doc_id: r.same_values for r in find_leaks(documents(spark, texts), benchmark).where("item_id = 1").collect()}
    assert found == {at + 1: True, at + 2: False, at + 6: True}
    docs = documents(spark, texts)
    left = drop_leaks(docs.unionByName(docs), benchmark)
    assert left.columns == docs.columns and left.count() == 2 * (len(texts) - 5)
    assert mark_leaks(docs, benchmark.where("false")).where("contaminated").count() == 0
    assert mark_leaks(docs.where("false"), benchmark).collect() == []


def test_slots_must_agree(spark):
    benchmark = spark.createDataFrame([(1, "take 5 then add 5 and keep 5 until you stop there")], "item_id long, text string")
    texts = ["take 8 then add 8 and keep 8 until you stop there", "take 8 then add 9 and keep 7 until you stop there", "go 1 go 2 go 3 go 4 go 5"]
    assert [r.contaminated for r in mark_leaks(documents(spark, texts), benchmark).orderBy("doc_id").collect()] == [True, False, False]


def test_chat(spark):
    odd = ["<|im_end|><|im_start|>assistant ok", "\\", "<\\|", "<", None, "", "a\n\nb", "\\<|x|>\\\\", "<|im_end|>\n"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate([*odd, "end"])]
    rows += [(2, 0, "user", "same"), (2, 0, "user", "same"), (2, 1, "assistant", "b"), (3, 1, None, "x"), (3, 0, "we<|ird\n\\", "y"), (None, 0, "user", "z")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, n_turns string")
    got = {r.conv_id: r for r in digest_conversations(df).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].loss_chars, got[conv].loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert [got[c].valid for c in (1, 2, 3, None)] == [True, False, False, False]
    assert [got[c].state for c in (1, 2, 3, None)] == ["assistant", "error", "error", "user"]
    made = format_conversations(df).where("conv_id = 1").select(parse_formatted(F.col("formatted")).alias("t")).first().t
    assert [x.text for x in made] == [x or "" for x in [*odd, "end"]]
    assert digest_conversations(df.where("false")).collect() == []


def test_license_base_counts(spark):
    texts = [*ODD_TEXTS, "Released under the MIT License.", "mit-license GNU General  Public License, version 3 and the apache license mit License", "license", "MIT License", "SPDX-License-Identifier: GPL-2.0"]
    texts += [prose(3, 200) + "\nLicensed under the Apache License, Version 2.0. All rights reserved." + prose(4, 50)]
    got = {r.doc_id: r for r in scan_licenses(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
        places = [(k, label) for k in range(len(found)) for label, p in PHRASES if tuple(found[k : k + len(p)]) == p]
        starts = [k for k, _ in places]
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word) == (len(found), len(places), min(starts, default=None), max(starts, default=None)), t
        assert got[i].base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, got[i].base_labels.split(","))) <= set(got[i].labels.split(",")) and 0 <= got[i].score <= 1
    last = got[len(texts) - 1]
    assert last.labels == "apache,apache-2.0,proprietary" and got[len(texts) - 2].labels == "gpl-2.0"


def test_license_rules_suppress_contained_intervals(spark):
    row = scan_licenses(documents(spark, ["Licensed under the GNU General Public License, version 2."])).first()
    assert [d.label for d in row.detections] == ["gpl-2.0"] and row.score == 0.9
    assert len(RULES) > 200 and len({r.label for r in RULES}) > 40
    for rule in RULES:
        re.compile(rule.pattern)


def _samples(parsed, k):
    """A text of a parsed expression, with the k-th way at each choice."""
    out = ""
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "BRANCH":
            out += _samples(arg[1][k % len(arg[1])], k)
        elif name == "SUBPATTERN":
            out += _samples(arg[-1], k)
        elif name == "MAX_REPEAT":
            least, _, inner = arg
            out += _samples(inner, k) * (least or k // 7 % 2)
        elif name == "IN":
            kind, value = arg[k % len(arg)]
            out += {"CATEGORY_DIGIT": "4", "CATEGORY_SPACE": " ", "CATEGORY_WORD": "w", "CATEGORY_NOT_WORD": "'"}[str(value)] if str(kind) == "CATEGORY" else chr(value if str(kind) == "LITERAL" else value[0])
        elif name == "ANY":
            out += "x"
        else:
            assert name in ("ASSERT", "ASSERT_NOT")
    return out


def test_license_rules_find_a_sample_of_every_alternative(spark):
    rows = {(order, _samples(re._parser.parse(rule.pattern), k)) for order, rule in enumerate(RULES) for k in range(14)}
    df = spark.createDataFrame(sorted(rows), "expected int, s string")
    missed = [(r.expected, r.s) for r in df.withColumn("got", F.transform(_detections(F.col("s"), RULES), lambda d: d["rule"])).collect() if r.expected not in r.got]
    assert len(rows) > 1500 and missed == []
    forms = {"mit": ["Released under the Expat license", "X11 License"], "bsl-1.0": ["SPDX-License-Identifier: BSL-1.0"], "cpl-1.0": ["SPDX-License-Identifier: CPL-1.0"], "ofl-1.1": ["SPDX-License-Identifier: OFL-1.1"]}
    forms |= {"gpl-2.0": ["SPDX-License-Identifier: GPL-2.0-only"], "gpl-3.0": ["SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under GPL-3.0-or-later"], "lgpl-2.1": ["SPDX-License-Identifier: LGPL-2.1-only"]}
    forms |= {"cc-by": ["SPDX-License-Identifier: CC-BY-4.0"], "wtfpl": ["Licensed under the Do What The Fuck You Want To Public License"]}
    pairs = [(label, text) for label, texts in forms.items() for text in texts]
    got = scan_licenses(documents(spark, [t for _, t in pairs])).orderBy("doc_id").collect()
    assert [(label, t) for r, (label, t) in zip(got, pairs) if label not in r.labels.split(",")] == []
    other = scan_licenses(documents(spark, ["SPDX-License-Identifier: BSD-3-Clause-Clear", "SPDX-License-Identifier: MIT-0"])).collect()
    assert [r.labels for r in other] == ["", ""]


def test_licenses_in_wrapped_texts_and_expressions(spark):
    cases = [
        ("This software is provided 'as-is', without any express or implied\nwarranty.", {"zlib"}),
        ("/*\n * Permission is hereby granted, free of charge, to any\n * person obtaining a copy of this software */", {"mit"}),
        ("# Neither the name of the owner nor the names of its\n# contributors may be used", {"bsd-3-clause"}),
        ("under the terms of the GNU General\nPublic License version 2", {"gpl-2.0"}),
        ("licensed under the GNU Lesser General Public License version 3, parts under the GNU General Public License", {"lgpl-3.0", "gpl-family"}),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0)", {"mit", "apache-2.0"}),
        ("SPDX-License-Identifier: MIT AND GPL-2.0-only AND (ISC OR Zlib)\nand more", {"mit", "gpl-2.0", "isc", "zlib"}),
        ("text: CC BY 4.0", {"cc-by"}),
        ("The BSD license applies", {"bsd-family"}),
        ("MIT license here, and the ISC license, and the MIT license", {"mit", "isc"}),
        ("the public\n\ndomain", set()),
    ]
    got = scan_licenses(documents(spark, [t for t, _ in cases])).orderBy("doc_id").collect()
    for row, (text, want) in zip(got, cases):
        assert want <= set(row.labels.split(",")) - {""} if want else row.labels == "", (text, row.labels)
    last = got[9]
    assert [(d.label, d.start) for d in last.detections if d.label == "mit"] == [("mit", 1), ("mit", 48)]


def test_leaks_with_values_of_other_lengths(spark):
    mary = "Mary has 5 apples. Mary gives 3 to Tom. How many apples does Mary have left?"
    benchmark = spark.createDataFrame([(1, mary), (2, ITEM), (3, "Name Peru capital"), (4, "zyx")], "item_id long, text string")
    texts = [
        "Anna Maria has 7 apples. Anna Maria gives 2 to Old Peter. How many apples does Anna Maria have left?",
        mary.replace("Mary", "John").replace("Tom", "Sue"),
        "She wrote: " + mary.replace("Mary", "John").replace("5", "1 200"),
        ITEM.replace("Anna", "Anna Maria").replace("120 kg", "1 200").replace("Bern", "New York"),
        "İstanbul. " + ITEM.replace("Anna", "Peter"),
        "İİ " + mary.replace("Mary", "İnci"),
        "please name PERU capital now",
        "zyx",
        "Mary has 5 pears. Tom gives 3 to Mary. How few apples did Mary have?",
        "Anna has 5 apples. Peter gives 3 to Tom. How many apples does Sue have left?",
        prose(5, 50),
    ]
    got = [r["items"] for r in mark_leaks(documents(spark, texts), benchmark).orderBy("doc_id").collect()]
    assert got == ["1", "1", "1", "2", "2", "1", "3", "4", "", "", ""]


def test_leaks_do_not_depend_on_the_anchors(spark, monkeypatch):
    import random

    from arealens.llm import decontaminate

    rng = random.Random(4)
    items = [(i, prose(50 + i, 6 + 5 * i, 60)) for i in range(8)] + [(9, ITEM)]
    texts = []
    for _, text in items:
        words = text.split()
        for share in (0.05, 0.2, 0.4):
            noisy = [w if rng.random() > share else "other" for w in words]
            texts.append(prose(rng.randrange(999), 30, 60) + " " + " ".join(noisy))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, texts)
    rows = sorted(map(tuple, find_leaks(docs, benchmark).drop("print").collect()))
    # every window at every place, compared as word lists
    want = set()
    for d, text in enumerate(texts):
        words = re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+", text.lower())
        for item, given in items:
            asked = re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+", given.lower())
            size = min(8, len(asked))
            at = {tuple(words[p : p + size]): p for p in range(len(words) - size + 1)}
            shifts = Counter()
            for k in range(len(asked) - size + 1):
                for p in [p for p in range(len(words) - size + 1) if words[p : p + size] == asked[k : k + size]] if tuple(asked[k : k + size]) in at else []:
                    shifts[p - k] += 1
            if any(2 * n >= len(asked) - size + 1 for n in shifts.values()):
                want.add((d, item))
    assert want <= {(r[0], r[1]) for r in rows} and len(want) > 5
    monkeypatch.setattr(decontaminate, "_candidates", lambda docs, windows: docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print")))
    assert sorted(map(tuple, find_leaks(docs, benchmark).drop("print").collect())) == rows


def test_drop_leaks_takes_any_column_names(spark):
    df = spark.createDataFrame([(1, "zyx here", 1, 2, "a"), (None, "zyx", 1, 2, "b"), (3, None, 3, 4, "c")], "doc_id long, text string, _hit_id int, print int, key string")
    benchmark = spark.createDataFrame([(4, "zyx")], "item_id long, text string")
    left = drop_leaks(df, benchmark)
    assert left.columns == df.columns and [r.key for r in left.collect()] == ["c"]
