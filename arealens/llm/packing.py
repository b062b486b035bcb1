"""Packing documents into sequences as a cutting-stock problem.

A document's tokens are cut into whole sequences and a remainder. Only the histogram of remainder
lengths (in units) reaches the driver: a linear program over patterns (how many remainders of each
length share a sequence) is solved by column generation, where a knapsack dynamic program prices the
next pattern. Rounded patterns are dealt to the documents by their rank among equal lengths, which the
tasks number themselves; what rounding leaves is packed best fit.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealens.llm.token_units import Pool, ragged
from arealens.llm.words import chunks
from arealens.operators.materialize import TEXT_ROWS, materialize

SEQUENCE = 2048
#: Length classes are multiples of so many tokens; a remainder wastes less than one unit.
UNIT = 16
END_ID = 1
#: Columns are priced until none saves this share of a sequence, or so many were.
GAIN = 1e-3
MAX_COLUMNS = 2000
#: Texts of one piece that the tokenizer gets at once.
_AT_ONCE = 20_000
_LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u027f"
_ONE_PIECE = re.compile(rf"[{_LETTERS}]+|[0-9]|[!-/:-@\[-`{{-~]+")
_LOWER = bytes(range(256)).lower()
_START, _CUT, _ODD = 1, 2, 4


def _byte_kinds() -> tuple[bytes, bytes]:
    """A kind (below 16) for each byte, and what a byte of kind b behind one of kind a is: _STEPS[16 * a + b].

    Kinds: 0 blank, 1 letter, 2 first letter of 's, 't, 're, 've, 'm, 'll or 'd, 3 digit, 4 apostrophe, 5 <, 6 |,
    7 other ASCII punctuation, 8 first byte of a letter up to U+027F, 9 C3, 10 C4, 11 second byte, 12 97 and B7,
    13 B0, 15 all else. Odd are 15 and what is made of 9 and 12 (no letters), 10 and 13 (lower case has two
    characters) and 5 and 6 (a special token begins so).
    """
    kinds = np.full(256, 15, np.uint8)
    kinds[0x21:0x7F], kinds[0x80:0xC0], kinds[0xC3:0xCA] = 7, 11, 8
    kinds[[0x20, *range(0x09, 0x0E)]] = 0
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
    kinds[list(b"strvmldSTRVMLD")], kinds[0x30:0x3A] = 2, 3
    kinds[0x27], kinds[0x3C], kinds[0x7C], kinds[0xC3], kinds[0xC4], kinds[[0x97, 0xB7]], kinds[0xB0] = 4, 5, 6, 9, 10, 12, 13
    steps = np.zeros((16, 16), np.uint8)
    begins, ends, signs = [1, 2, 8, 9, 10], [1, 2, 11, 12, 13], [5, 6, 7]
    steps[np.ix_(ends, [3, 4, *signs])] = _CUT
    steps[np.ix_([3], [*begins, 3, 4, *signs])] = _CUT
    steps[np.ix_(signs, [*begins, 3])] = _CUT
    steps[np.ix_([4], [1, 3, 8, 9, 10])] = _CUT
    steps[9, 12] = steps[10, 13] = steps[5, 6] = _ODD
    steps[:, 15] = _ODD
    steps[0, 1:] |= _START
    return kinds.tobytes(), steps.tobytes()


_KINDS, _STEPS = _byte_kinds()


class _Encoder:
    """Token ids of texts; pieces are encoded once and remembered.

    Sound for a tokenizer that lower-cases, drops white space, encodes bytes, ends each piece with a token marked by
    ``</w>`` and lets no token cross its pieces: 's, 't, 're, 've, 'm, 'll, 'd, runs of letters, digits one by one,
    runs of other signs. Blank-separated strings of ASCII and letters up to U+027F are lower-cased and cut into pieces
    as bytes, only an apostrophe and a letter that may be the first of those seven stay together. Strings with other
    characters or the beginning of a special token go to the tokenizer whole. New pieces are encoded many at a time
    by the tokenizer's model, without the steps before it that change nothing in them, and told apart by the mark.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.pool = Pool(self._ids, 1_200_000)
        probe = [c for c in map(chr, range(0x21, 0x280)) if _ONE_PIECE.fullmatch(c)]
        probe += ["".join(probe[i : i + 3]).lower() for i in range(0, len(probe), 3) if _ONE_PIECE.fullmatch("".join(probe[i : i + 3]))]
        if any(e.ids != self._model_ids([t]).tolist() for t, e in zip(probe, self.tokenizer.encode_batch_fast(probe, add_special_tokens=False))):
            raise ValueError("the tokenizer does more than lower-case and cut")

    def _model_ids(self, pieces: list[str]) -> np.ndarray:
        return np.array(self.model.encode_batch_fast([" ".join(pieces).lower()], add_special_tokens=False)[0].ids, "<u4")

    def _ids(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings without ASCII white space: how many each has, and all of them."""
        texts = [s.decode() for s in stretches]
        one = np.fromiter((_ONE_PIECE.fullmatch(t) is not None for t in texts), bool, len(texts))
        others = [e.ids for e in self.tokenizer.encode_batch_fast([texts[i] for i in np.flatnonzero(~one)], add_special_tokens=False)]
        pieces = [texts[i] for i in np.flatnonzero(one)] if others else texts
        found = [self._model_ids(pieces[lo : lo + _AT_ONCE]) for lo in range(0, len(pieces), _AT_ONCE)]
        ids = np.concatenate([np.zeros(0, "<u4"), *found])
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(pieces):
            raise ValueError("the tokenizer does not mark the ends of words")
        counts = np.zeros(len(texts), np.int64)
        counts[one] = np.diff(last, prepend=-1)
        if not others:
            return counts, ids
        counts[~one] = [len(o) for o in others]
        whole, mine = np.empty(int(counts.sum()), "<u4"), np.repeat(one, counts)
        whole[mine], whole[~mine] = ids, [i for o in others for i in o]
        return counts, whole

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts data[offsets[i] : offsets[i + 1]], and where those of each begin (one more entry than texts)."""
        held = bytearray(data)
        kinds = np.frombuffer(held.translate(_KINDS), np.uint8)
        pairs = kinds.copy()
        pairs[1:] += kinds[:-1] << 4
        first = offsets[:-1]
        first = first[first < len(data)]
        pairs[first] = kinds[first]
        steps = np.frombuffer(bytearray(pairs).translate(_STEPS), np.uint8)
        text = np.frombuffer(held.translate(_LOWER), np.uint8)
        odd = np.flatnonzero(steps & _ODD)
        if len(odd):
            begins = np.flatnonzero(steps & _START)
            odd = np.unique(np.searchsorted(begins, odd, "right") - 1)
            left = ragged(begins[odd], np.append(begins, len(data))[odd + 1] - begins[odd])
            text[left] = data[left]
            steps[left] &= _START
        starts = np.flatnonzero(steps & (_START | _CUT))
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        inside = kinds != 0
        places = np.cumsum(inside)  # pieces stand side by side once the blanks are gone
        words = self.pool.look_up(text[inside], np.append(places[starts] - 1, places[-1]))
        counts = self.pool.counts[words]
        totals = np.append(0, np.cumsum(counts))
        return self.pool.tokens[ragged(self.pool.first[words], counts)], totals[np.searchsorted(starts, offsets)]


_encoders: dict[str, _Encoder] = {}


def _pieces(path: str):
    """Rows of pieces: whole sequences (unit 0) and remainders (unit class, rank inside this task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(path, _Encoder(path)) if path not in _encoders else _encoders[path]
        task = TaskContext.get().partitionId()
        ranks = [0] * (SEQUENCE // UNIT + 1)
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                tokens, firsts = encoder.encode(data, offsets)
                # the end id behind each text
                sizes = np.diff(firsts)
                bounds = np.append(0, np.cumsum(sizes + 1))
                whole = np.full(int(bounds[-1]), END_ID, "<u4")
                whole[ragged(bounds[:-1], sizes)] = tokens
                view = memoryview(whole).cast("B")
                rows: list[tuple] = []
                for at, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for start in range(begin, end, SEQUENCE):
                        length = min(SEQUENCE, end - start)
                        unit = 0 if length == SEQUENCE else -(-length // UNIT)
                        rows.append((lo + at, start - begin, length, zlib.crc32(view[4 * start : 4 * (start + length)]), end - begin, unit, ranks[unit]))
                        ranks[unit] += 1
                row, *values = zip(*rows)
                columns = [pa.array(v, pa.int64()) for v in values]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), *columns, pa.array([task] * len(rows), pa.int64())], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "unit", "rank", "task"]
    return run


def _price(weights: np.ndarray, gain: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of largest gain that fits the room: unbounded knapsack by dynamic programming."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        best[c], choice[c] = best[c - 1], -1
        fits = weights <= c
        if fits.any():
            value = np.where(fits, best[np.maximum(c - weights, 0)] + gain, -np.inf)
            k = int(value.argmax())
            if value[k] > best[c] + 1e-12:
                best[c], choice[c] = value[k], k
    pattern, c = np.zeros(len(weights)), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[choice[c]] += 1
            c -= weights[choice[c]]
    return float(best[room]), pattern


def solve_patterns(demand: dict[int, int], room: int = SEQUENCE // UNIT) -> list[tuple[int, dict[int, int]]]:
    """(times, {weight: items}) that use every demanded weight exactly as often as demanded."""
    weights = np.array(sorted(w for w, n in demand.items() if n), np.int64)
    if not len(weights):
        return []
    need = np.array([demand[int(w)] for w in weights], float)
    basis = np.diag((room // weights).astype(float))
    for step in range(MAX_COLUMNS):
        if step % 50 == 0:
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ need, 0)
        value, pattern = _price(weights, inverse.sum(0), room)
        if value <= 1 + GAIN:
            break
        column = inverse @ pattern
        ratio = np.where(column > 1e-9, x / np.where(column > 1e-9, column, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        theta = ratio[out]
        x = np.maximum(x - theta * column, 0)
        x[out] = theta
        basis[:, out] = pattern
        pivot = inverse[out] / column[out]
        inverse -= np.outer(column, pivot)
        inverse[out] = pivot
    times = np.floor(x + 1e-7).astype(np.int64)
    rest = need.astype(np.int64) - np.rint(basis @ times).astype(np.int64)
    while (rest < 0).any():  # rounding noise of the inverse
        k = int(np.argmin(rest))
        p = int(np.flatnonzero((basis[k] > 0) & (times > 0))[0])
        times[p] -= 1
        rest += np.rint(basis[:, p]).astype(np.int64)
    plan = [(int(n), {int(w): int(a) for w, a in zip(weights, basis[:, p]) if a > 0}) for p, n in enumerate(times) if n]
    return plan + [(1, p) for p in _best_fit({int(w): int(n) for w, n in zip(weights, rest) if n}, room)]


def _best_fit(demand: dict[int, int], room: int) -> list[dict[int, int]]:
    by_room: list[list[dict[int, int]]] = [[] for _ in range(room + 1)]
    for weight in sorted(demand, reverse=True):
        for _ in range(demand[weight]):
            left = next((r for r in range(weight, room) if by_room[r]), room)
            pattern = by_room[left].pop() if by_room[left] else {}
            pattern[weight] = pattern.get(weight, 0) + 1
            by_room[left - weight].append(pattern)
    return [p for patterns in by_room for p in patterns]


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per piece of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``END_ID``; null and empty texts are the one id. Each id lies in one piece;
    a sequence holds at most ``SEQUENCE`` ids, its pieces follow each other from offset 0. Repeated rows
    are packed each; further columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, unit long, rank long, task long"
    pieces = materialize(text.mapInArrow(_pieces(tokenizer_path), schema), "pieces", TEXT_ROWS)
    rest = pieces.where("unit > 0")
    counts = materialize(rest.groupBy("unit", "task").agg(F.count("*").alias("n")), "lengths")
    demand = {r["unit"]: r["n"] for r in counts.groupBy("unit").agg(F.sum("n").alias("n")).collect()}
    used: dict[int, int] = {}
    deals, sequences = [], 0
    for times, pattern in solve_patterns(demand):
        for unit, items in pattern.items():
            lo = used.get(unit, 0)
            used[unit] = lo + times * items
            deals.append((unit, lo, used[unit], sequences, items))
        sequences += times
    # at most two rows for each length class and pattern: 256 classes bound it whatever the input
    dealt = F.broadcast(spark.createDataFrame(deals, "unit long, lo long, hi long, base long, items long"))
    order = Window.partitionBy("unit").orderBy("task")
    before = counts.select("unit", "task", (F.sum("n").over(order) - F.col("n")).alias("before"))
    place = F.col("before") + F.col("rank")
    packed = (
        rest.join(before, ["unit", "task"])
        .withColumn("place", place)
        .join(dealt, "unit")
        .where("place >= lo and place < hi")
        .withColumn("sequence_id", F.expr("base + (place - lo) div items"))
    )
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("unit"), "place")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    packed = packed.withColumn("offset", F.sum("length").over(inside) - F.col("length")).select(columns)
    whole = pieces.where("unit = 0").withColumn("sequence_id", F.lit(sequences) + F.col("task") * F.lit(1 << 32) + F.col("rank"))
    return packed.unionByName(whole.withColumn("offset", F.lit(0).cast("long")).select(columns))
