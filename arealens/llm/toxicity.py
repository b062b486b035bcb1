"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as an embedding of its hash and the mean embedding of its character n-grams. Every
window of a text (windows overlap by half) gets a logit; a text's logit is that of its worst window.
Only document labels exist, so training follows the worst window of each text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.llm.words import Words, chunks, mix, split_words
from arealens.operators.materialize import materialize

WINDOW = 32
STRIDE = 16
WORD_SIZE = 4
CHAR_SIZE = 4
HIDDEN = 6
WORD_BUCKETS = 1 << 16
CHAR_BUCKETS = 1 << 16
CHAR_GRAMS = (3, 4, 5)
#: Longer words (bytes) enter as overlapping pieces, each a word of its own, so texts without blanks are read whole.
LONGEST_WORD = 64
PIECE_STEP = 48
#: Bounds of the labelled sample: rows of each label, in the order of a hash of doc_id, drawn from texts of at most so
#: many characters. Scoring has no such limit.
ROWS_PER_LABEL = 1000
TRAIN_CHARS = 20_000
EPOCHS = 3
LEAST_STEPS = 120
BATCH = 64
RATE = 0.02
_PAD = 0


class Vocabulary(NamedTuple):
    """Distinct words of a batch: word bucket, and character-gram buckets with the word each belongs to."""

    word: np.ndarray
    gram: np.ndarray
    owner: np.ndarray


def cut_long_words(words: Words) -> Words:
    """Words of more than ``LONGEST_WORD`` bytes as overlapping pieces in their place."""
    size = words.ends - words.starts
    if not (size > LONGEST_WORD).any():
        return words
    pieces = np.where(size > LONGEST_WORD, -(-(size - LONGEST_WORD) // PIECE_STEP) + 1, 1)
    owner = np.repeat(np.arange(len(size)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = words.starts[owner] + nth * PIECE_STEP
    long = size[owner] > LONGEST_WORD
    ends = np.where(long, np.minimum(starts + LONGEST_WORD, words.ends[owner]), words.ends[owner])
    hashes = words.hashes[owner]
    for at in np.flatnonzero(long):
        hashes[at] = zlib.crc32(words.data[starts[at] : ends[at]])
    hashes[long] = mix(hashes[long])
    return words._replace(starts=starts, ends=ends, hashes=hashes, first=np.append(0, np.cumsum(pieces))[words.first])


def _encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, Vocabulary]:
    """Index of each word among the distinct words (0 is padding), and the distinct words."""
    distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = starts[first], ends[first]
    size = ends - starts
    marked = np.zeros(int((size + 2).sum()), np.uint64)
    begin = np.concatenate([[0], np.cumsum(size + 2)])
    inner = np.repeat(begin[:-1] + 1 - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    source = np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    marked[inner] = data[source].astype(np.uint64) + np.uint64(1)
    own = np.repeat(np.arange(len(distinct)), size + 2)
    grams, owners = [], []
    rolling = np.zeros(len(marked), np.uint64)
    for k in range(max(CHAR_GRAMS)):
        rolling = rolling[: len(marked) - k] * np.uint64(263) + marked[k:] if k else marked.copy()
        if k + 1 in CHAR_GRAMS and len(rolling):
            whole = own[: len(rolling)] == own[k : k + len(rolling)]
            grams.append(mix(rolling[whole] + np.uint64(k)) % np.uint64(CHAR_BUCKETS))
            owners.append(own[: len(rolling)][whole])
    gram = np.concatenate(grams).astype(np.int64) if grams else np.zeros(0, np.int64)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    word = (distinct % np.uint64(WORD_BUCKETS)).astype(np.int64)
    return index + 1, Vocabulary(word, gram, owner)


def _windows(index: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (word indexes, padded by 0) over the words of each row, and the row of each window."""
    size = np.diff(first)
    number = np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(size)), number)
    nth = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(number)[:-1]]), number)
    begin = first[:-1][row] + np.minimum(nth * STRIDE, np.maximum(size[row] - WINDOW, 0))
    at = begin[:, None] + np.arange(WINDOW)
    inside = at < first[1:][row][:, None]
    padded = np.append(index, 0)
    return np.where(inside, padded[np.minimum(at, len(index))], _PAD), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters as float32 arrays by name; gates in the order update, reset, candidate."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        width = WORD_SIZE + CHAR_SIZE

        def init(*shape: int, scale: float = 0.3) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": init(WORD_BUCKETS, WORD_SIZE, scale=0.02), "char": init(CHAR_BUCKETS, CHAR_SIZE, scale=0.02)}
        for side in "fb":
            self.p |= {f"W{side}": init(width, 3 * HIDDEN), f"U{side}": init(HIDDEN, 3 * HIDDEN), f"b{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": init(2 * HIDDEN, HIDDEN), "a": init(HIDDEN), "o": init(2 * HIDDEN), "c": np.zeros(1, np.float32)}

    def embed(self, words: Vocabulary) -> np.ndarray:
        """Inputs of the distinct words; row 0 is padding."""
        out = np.zeros((len(words.word) + 1, WORD_SIZE + CHAR_SIZE), np.float32)
        out[1:, :WORD_SIZE] = self.p["word"][words.word]
        grams = np.maximum(np.bincount(words.owner, minlength=len(words.word)), 1)[:, None]
        for k in range(CHAR_SIZE):
            out[1:, WORD_SIZE + k] = np.bincount(words.owner, weights=self.p["char"][words.gram, k], minlength=len(words.word)) / grams[:, 0]
        return out

    def _run(self, side: str, gates: np.ndarray, ids: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        h = np.zeros((len(ids), HIDDEN), np.float32)
        u = self.p[f"U{side}"]
        out, trace = np.zeros((WINDOW, len(ids), HIDDEN), np.float32), []
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            x = gates[ids[:, t]]
            live = (ids[:, t] != _PAD).astype(np.float32)[:, None]
            zr = _sigmoid(x[:, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])
            step = live * z
            new = h + step * (n - h)
            if keep:
                trace.append((t, h, z, r, n, live))
            h = out[t] = new
        return out, trace

    def forward(self, inputs: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logit of each window; with ``keep`` also what the gradient needs."""
        p = self.p
        runs = {side: self._run(side, inputs @ p[f"W{side}"] + p[f"b{side}"], ids, keep) for side in "fb"}
        states = np.concatenate([runs["f"][0], runs["b"][0]], 2)
        hidden = np.tanh(states @ p["A"])
        energy = hidden @ p["a"] + np.where(ids.T == _PAD, np.float32(-30), np.float32(0))
        weight = np.exp(energy - energy.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * states).sum(0)
        logit = pooled @ p["o"] + p["c"][0]
        return logit, (runs, states, hidden, weight, pooled) if keep else None

    def gradient(self, inputs: np.ndarray, ids: np.ndarray, words: Vocabulary, kept, error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients for the errors of the logits, by back-propagation through time."""
        p, (runs, states, hidden, weight, pooled) = self.p, kept
        g = {"o": pooled.T @ error, "c": np.array([error.sum()], np.float32)}
        d_pooled = error[:, None] * p["o"]
        d_weight = (states * d_pooled).sum(2)
        d_energy = weight * (d_weight - (weight * d_weight).sum(0))
        d_hidden = d_energy[:, :, None] * p["a"] * (1 - hidden**2)
        g["a"] = np.einsum("tb,tbh->h", d_energy, hidden)
        g["A"] = np.einsum("tbs,tbh->sh", states, d_hidden)
        d_states = weight[:, :, None] * d_pooled + d_hidden @ p["A"].T
        d_inputs = np.zeros_like(inputs)
        for k, side in enumerate("fb"):
            u, d_gates = p[f"U{side}"], np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            g[f"U{side}"] = np.zeros_like(u)
            dh = np.zeros((len(ids), HIDDEN), np.float32)
            for t, h, z, r, n, live in reversed(runs[side][1]):
                dh = dh + d_states[t, :, k * HIDDEN : (k + 1) * HIDDEN]
                dn = dh * live * z * (1 - n**2)
                dz = dh * live * (n - h) * z * (1 - z)
                d_rh = dn @ u[:, 2 * HIDDEN :].T
                dr = d_rh * h * r * (1 - r)
                d_all = np.concatenate([dz, dr, dn], 1)
                np.add.at(d_gates, ids[:, t], d_all)
                g[f"U{side}"][:, : 2 * HIDDEN] += h.T @ d_all[:, : 2 * HIDDEN]
                g[f"U{side}"][:, 2 * HIDDEN :] += (r * h).T @ dn
                dh = dh * (1 - live * z) + d_rh * r + d_all[:, : 2 * HIDDEN] @ u[:, : 2 * HIDDEN].T
            g[f"W{side}"], g[f"b{side}"] = inputs.T @ d_gates, d_gates.sum(0)
            d_inputs += d_gates @ p[f"W{side}"].T
        d_inputs = d_inputs[1:]
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], words.word, d_inputs[:, :WORD_SIZE])
        grams = np.maximum(np.bincount(words.owner, minlength=len(words.word)), 1)[:, None]
        np.add.at(g["char"], words.gram, (d_inputs[:, WORD_SIZE:] / grams)[words.owner])
        return g

    def score_texts(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Logit of the worst window of each text; empty texts have one window of padding."""
        out = np.zeros(len(texts))
        for lo, hi, data, offsets in chunks(texts, 1 << 19):
            words = cut_long_words(split_words(data, offsets, lower=True))
            index, vocabulary = _encode(words.data, words.starts, words.ends, words.hashes)
            ids, row = _windows(index, words.first)
            inputs = self.embed(vocabulary)
            logit = np.concatenate([self.forward(inputs, ids[k : k + 4096])[0] for k in range(0, len(ids), 4096)])
            worst = np.full(hi - lo, -np.inf)
            np.maximum.at(worst, row, logit)
            out[lo:hi] = worst
        return out


def _start_from_odds(net: Network, batches: list, labels: np.ndarray) -> None:
    """Put the smoothed log odds of label 1 among the texts that hold a bucket in the first input of each kind."""
    seen = {"word": np.zeros((2, WORD_BUCKETS)), "char": np.zeros((2, CHAR_BUCKETS))}
    for (vocabulary, _, _), label in zip(batches, labels):
        seen["word"][label][np.unique(vocabulary.word)] += 1
        seen["char"][label][np.unique(vocabulary.gram)] += 1
    total = np.bincount(labels, minlength=2)
    for name, (no, yes) in seen.items():
        odds = np.log((yes + 0.5) / (total[1] + 1)) - np.log((no + 0.5) / (total[0] + 1))
        net.p[name][:, 0] = np.where(yes + no > 2, np.clip(odds, -3, 5), 0).astype(np.float32) * (1 if name == "word" else 3)


def train_network(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """Fit on whole texts with one label each; the bias is then set so that logit 0 parts the labels best."""
    net = Network(seed)
    labels = np.asarray(labels, np.int64)
    if not len(texts) or len(set(labels.tolist())) < 2:
        net.p["o"][:] = 0
        net.p["c"][:] = -3
        return net
    prepared = []
    for text in texts:
        _, _, data, offsets = next(chunks(pa.array([text]), 1 << 30))
        words = cut_long_words(split_words(data, offsets, lower=True))
        index, vocabulary = _encode(words.data, words.starts, words.ends, words.hashes)
        prepared.append((vocabulary, *_windows(index, words.first)))
    _start_from_odds(net, prepared, labels)
    rng = np.random.default_rng(seed)
    state = {name: [np.zeros_like(v), np.zeros_like(v)] for name, v in net.p.items()}
    per_epoch = -(-len(prepared) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // per_epoch))
    step = 0
    for epoch in range(epochs):
        shuffled = rng.permutation(len(prepared))
        for lo in range(0, len(prepared), BATCH):
            chosen = shuffled[lo : lo + BATCH]
            merged, ids, row = _merge([prepared[i] for i in chosen])
            inputs = net.embed(merged)
            logit = net.forward(inputs, ids)[0]
            order = np.lexsort((logit, row))
            worst = order[np.append(np.flatnonzero(np.diff(row[order])), len(order) - 1)]
            ids = ids[worst]
            logit, kept = net.forward(inputs, ids, keep=True)
            error = ((_sigmoid(logit) - labels[chosen]) / len(chosen)).astype(np.float32)
            step += 1
            for name, g in net.gradient(inputs, ids, merged, kept, error).items():
                m, v = state[name]
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                net.p[name] -= RATE * (0.5 ** (3 * epoch / epochs)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    logits = np.concatenate([net.score_texts(pa.array(texts[k : k + 256])) for k in range(0, len(texts), 256)])
    net.p["c"] -= np.float32(_best_cut(logits, labels))
    return net


def _merge(parts: list) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    shift = np.concatenate([[0], np.cumsum([len(v.word) for v, _, _ in parts])])
    words = Vocabulary(
        np.concatenate([v.word for v, _, _ in parts]), np.concatenate([v.gram for v, _, _ in parts]), np.concatenate([v.owner + s for (v, _, _), s in zip(parts, shift)])
    )
    ids = np.concatenate([np.where(i == _PAD, _PAD, i + s) for (_, i, _), s in zip(parts, shift)])
    row = np.concatenate([np.full(len(i), k) for k, (_, i, _) in enumerate(parts)])
    return words, ids, row


def _best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the cut with the best sum of both labels' shares on their own side."""
    order = np.argsort(logits)
    yes = labels[order] == 1
    gain = np.cumsum(~yes) / (~yes).sum() - np.cumsum(yes) / yes.sum()
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    at = int(best[0])
    return float((logits[order[at]] + logits[order[min(int(best[-1]) + 1, len(order) - 1)]]) / 2)


def _held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on the bounded sample of labelled rows of ``docs`` that are not held out.

    At most ``ROWS_PER_LABEL`` rows a label are drawn, from those whose text has ``TRAIN_CHARS`` characters or fewer. A doc_id labelled both ways is left out, a repeated text counts once for each row drawn.
    """
    one = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("top")).where("toxic = top")
    one = one.where(~_held_out())
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.length("text") <= TRAIN_CHARS)
    usable = one.join(texts.select("doc_id"), "doc_id", "left_semi")
    key = F.xxhash64("doc_id")
    parts = [usable.where(F.col("toxic") == x).orderBy(key, "doc_id").limit(ROWS_PER_LABEL).select("doc_id", "toxic") for x in (0, 1)]
    sample = materialize(parts[0].union(parts[1]), "sample")
    found = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic").dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    return train_network(found["text"].tolist(), found["toxic"].tolist())


def score_toxicity(docs: DataFrame, net: Network) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Null and empty texts are scored as a window of padding. Repeated rows score alike; a row without
    doc_id is not held out; further columns are ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.__new__(Network)
        model.p = sent.value
        for batch in batches:
            score = _sigmoid(model.score_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score.astype(float))], names=["doc_id", "score"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = given.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
