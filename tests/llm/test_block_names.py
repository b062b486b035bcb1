"""Exact duplicates against plain grouping of the texts."""

import hashlib
from collections import defaultdict

import pytest

from arealens.llm.block_names import drop_copies, exact_duplicates
from tests.llm.helpers import ODD_TEXTS, documents, prose


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, order[0], len(ids), at == 0, digest) for at, i in enumerate(order)]
    return sorted(out, key=str)


def texts():
    long = prose(3, 200)
    near = [long[:k] + "#" + long[k + 1 :] for k in (0, 5, 300, len(long) // 2, len(long) - 1)]
    swapped = long[8:16] + long[:8] + long[16:]
    same = [prose(k, 20) for k in range(4)] * 3
    return [*ODD_TEXTS, *ODD_TEXTS, long, long, *near, *near[1:3], swapped, long + "x", long[:-1], *same, "Aé", "AÉ", "a" * 64, "a" * 65, "b" * 64, "b" * 64]


@pytest.mark.parametrize("block, head, longest", [(40, 4, 5_000), (4096, 256, 100_000)])
def test_groups_equal_brute_force(spark, block, head, longest):
    given = [t for t in texts() if len(t or "") <= longest]
    got = exact_duplicates(documents(spark, given), block, head)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(list(enumerate(given)))


def test_repeated_and_missing_ids_and_empty_tables(spark):
    rows = [(5, "a"), (5, "a"), (None, "a"), (None, "b"), (None, "b"), (7, "c" * 900), (7, "d" * 900), (7, "d" * 900), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, exact_duplicates(df).collect()), key=str) == brute(rows)
    assert exact_duplicates(df.limit(0)).collect() == []


def test_one_group_may_hold_most_rows(spark):
    copy = prose(1, 300)
    given = [copy] * 300 + [copy[:-1] + str(k % 10) for k in range(40)] + [prose(k, 300) for k in range(2, 60)]
    assert sorted(map(tuple, exact_duplicates(documents(spark, given)).collect()), key=str) == brute(list(enumerate(given)))


def test_kept_rows_keep_their_columns(spark):
    df = documents(spark, ["a", "b", "a", None, ""]).withColumnsRenamed({"n": "keep_id", "node": "row", "score": "class.x"})
    kept = drop_copies(df)
    assert kept.columns == df.columns
    want = [r for r in df.collect() if r.doc_id in (1, 2, 4)]
    assert sorted(kept.collect()) == sorted(want)
