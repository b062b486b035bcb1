"""Packing by an exact round trip, and the pipeline on a small folder."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from arealens.llm.packing import END_ID, SEQUENCE, _best_fit, pack_documents, solve_patterns
from tests.llm.helpers import ODD_TEXTS, documents, prose

PATH = public_tokenizers.path(corpus_pipeline.TOKENIZER)


def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(PATH)
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [END_ID] for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, own in ids.items():
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at
            at += length
        assert at == len(own)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= SEQUENCE
    return sum(map(len, ids.values())), len(sequences)


def test_packing_round_trip(spark):
    texts = [*ODD_TEXTS, "a\x1fb It'S DON'T", "<|startoftext|>x", "日本語 Ωμέγα", *[prose(k, 20 + 37 * k % 900) for k in range(150)], prose(999, 5000)]
    docs = documents(spark, texts)
    rows = pack_documents(docs, PATH).collect()
    tokens, sequences = check_packing(rows, dict(enumerate(texts)))
    assert sequences <= 1.1 * tokens / SEQUENCE + 2
    assert pack_documents(docs.where("false"), PATH).collect() == []
    twice = docs.where("doc_id = 3").unionByName(docs.where("doc_id = 3"))
    assert pack_documents(twice, PATH).count() == 2


def test_patterns_use_each_length_as_often_as_demanded():
    rng = np.random.default_rng(2)
    for _ in range(5):
        demand = {int(w): int(n) for w, n in zip(rng.integers(1, 129, 40), rng.integers(0, 500, 40))}
        plan, used = solve_patterns(demand, 128), Counter()
        for times, pattern in plan:
            assert sum(w * n for w, n in pattern.items()) <= 128
            for w, n in pattern.items():
                used[w] += times * n
        assert used == Counter({w: n for w, n in demand.items() if n})
        assert sum(t for t, _ in plan) <= 1.01 * len(_best_fit(demand, 128)) + 1
    assert solve_patterns({}) == []


def test_stages_keep_clean_documents_and_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bad = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 0").collect()}
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    names, before = [n for n, _ in corpus_pipeline.STAGES], None
    assert names == ["quality_classifier", "quality_rules", "near_duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, folder)
        assert docs.columns == before.columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0 < docs.count() <= before.count(), name
    left = {r.doc_id: r.text for r in docs.collect()}
    assert not any(i in " ".join(t.split()) for t in left.values() for i in items) and len(set(left.values())) == len(left)
    assert len(bad & set(left)) <= 0.2 * len(bad) + 1
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect(), left)
