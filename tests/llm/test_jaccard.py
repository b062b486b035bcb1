"""The Jaccard join against all pairs compared directly."""

import numpy as np
import pytest

from arealens.llm import jaccard_join
from arealens.llm.components import connected_components
from arealens.llm.jaccard_join import group_keys, jaccard_components, keep_one, open_group
from tests.llm.helpers import ODD_TEXTS, documents, edited, prose, words


def brute(texts):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [(i, len(s), root(i)) for i, s in enumerate(sets)]


@pytest.fixture(scope="module")
def texts():
    passage = prose(99, 40)
    out = list(ODD_TEXTS) + ["ONE", "two WORDS", "a b c d e", "a b c d e", "a b c d f", "x x x x x x x x", "x x x x x x"]
    for k in range(12):
        base = prose(k, 30 + 25 * k)
        out += [base, base.upper(), *[edited(base, 100 * k + j, s) for j, s in enumerate((0.01, 0.02, 0.03, 0.05))]]
    out += [prose(500 + k, 60) + " " + passage for k in range(60)]
    return out


@pytest.mark.parametrize("task_tokens", [4 << 20, 100])
def test_components_equal_brute_force(spark, texts, monkeypatch, task_tokens):
    monkeypatch.setattr(jaccard_join, "TASK_TOKENS", task_tokens)
    monkeypatch.setattr(jaccard_join, "ROUND_PIVOTS", 3)
    rows = jaccard_components(documents(spark, texts)).collect()
    assert sorted(map(tuple, rows)) == brute(texts)


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    text = prose(1, 50)
    df = spark.createDataFrame([(5, text), (5, text), (None, text), (3, edited(text, 2, 0.01)), (None, "alone here"), (9, None)], "doc_id long, text string")
    got = sorted(map(tuple, jaccard_components(df).collect()), key=str)
    same = len({c for *_, c in got if c == 3})
    assert same == 1 and sum(c == 3 for *_, c in got) == 4
    assert (9, 0, 9) in got and (None, 1, None) in got
    kept = keep_one(df).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == [(3, edited(text, 2, 0.01)), (9, None)]
    empty = spark.createDataFrame([], "doc_id long, text string, doc string")
    assert jaccard_components(empty).collect() == [] and keep_one(empty).collect() == []


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    for n in [1, 2, 3, 5, 8, 13, 40, 200, 900]:
        for _ in range(20):
            base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2))
            n = len(base)
            drop, add = int(rng.integers(0, n // 10 + 1)), int(rng.integers(0, n // 10 + 1))
            other = np.unique(np.concatenate([base[drop:], rng.integers(0, 1 << 63, add, dtype=np.int64).astype(np.uint64)]))
            both = len(np.intersect1d(base, other))
            if 100 * both < 80 * len(np.union1d(base, other)):
                continue
            for common in (base[:0], np.sort(base[n // 3 :]), base):
                assert len(np.intersect1d(group_keys(base, common, 80), group_keys(other, common, 80)))


def test_open_group_chains():
    base = np.arange(100, dtype=np.uint64)
    chain = [np.arange(k, k + 100, dtype=np.uint64) for k in range(0, 60, 10)] + [np.arange(1000, 1100, dtype=np.uint64), base]
    label = open_group(chain, 80)
    assert len(set(label[:6])) == 1 and label[7] == label[0] and label[6] != label[0]


def test_components_of_edges(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 200), (5, 5)], "a long, b long")
    label = {r.node: r.label for r in connected_components(edges).collect()}
    assert len({label[i] for i in range(31)}) == 1 and label[100] == label[200] != label[0]
    assert connected_components(edges.where("false")).collect() == []
