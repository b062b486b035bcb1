"""What workers hold: remembered stretches, batches of texts, freed memory."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from arealens.llm import token_units
from arealens.llm.token_units import LONGEST, Pool
from arealens.operators.materialize import materialize


def by_byte(stretches):
    """A token for each byte of a stretch."""
    return np.array([len(s) for s in stretches], np.int64), np.frombuffer(b"".join(stretches), np.uint8).astype("<u4")


def look_up(pool, stretches):
    bounds = np.append(0, np.cumsum([len(s) for s in stretches]))
    numbers = pool.look_up(np.frombuffer(b"".join(stretches), np.uint8), bounds)
    return [bytes(pool.tokens[a : a + n].astype(np.uint8)) for a, n in zip(pool.first[numbers].tolist(), pool.counts[numbers].tolist())]


@pytest.mark.parametrize("equal_hashes", [False, True])
def test_pool_gives_each_stretch_its_own_tokens(monkeypatch, equal_hashes):
    if equal_hashes:
        monkeypatch.setattr(token_units, "stretch_hashes", lambda data, sizes: np.full(len(sizes), 7, np.uint64))
    rng = np.random.default_rng(3)
    pool, asked = Pool(lambda s: (asked.extend(s), by_byte(s))[1], 300), []
    for _ in range(40):
        stretches = [bytes(rng.integers(97, 100, rng.integers(0, 7)).tolist()) for _ in range(60)] + [b"x" * LONGEST, b"y" * (LONGEST + 1), b"\0", b"\0\0"]
        assert look_up(pool, stretches) == stretches
    assert equal_hashes or len(asked) < 40 * 30


def test_pool_asks_once_for_a_remembered_stretch():
    asked = []
    pool = Pool(lambda s: (asked.extend(s), by_byte(s))[1], 1000)
    for _ in range(3):
        look_up(pool, [b"one", b"two", b"one", b"three"])
    assert sorted(asked) == [b"one", b"three", b"two"]


def test_pool_holds_a_stretch_in_few_bytes():
    pool, n = Pool(by_byte, 10**6), 200_000
    tracemalloc.start()
    for lo in range(0, n, 10_000):
        look_up(pool, [b"w%d" % k for k in range(lo, lo + 10_000)])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(pool.first) == n and held < 120 * n


def test_materialize_sends_fewer_rows_at_once_and_restores_the_session(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    before = spark.conf.get(key)
    df = spark.range(0, 2500, 1, 1).selectExpr("id AS n").mapInArrow(sizes, "n long")
    assert sorted(r.n for r in materialize(df, "few", 1000).collect()) == [500, 1000, 1000]
    assert spark.conf.get(key) == before
    assert [r.n for r in materialize(df, "all").collect()] == [2500]
