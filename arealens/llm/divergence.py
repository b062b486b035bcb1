"""Quality rules: base counts of a text, and its distance from the usual text of its language.

Two histograms describe a text: characters by class, and words by the language's most common words
(all others together). The references are the same histograms over all texts of a language. The
Jensen-Shannon distance to them must stay under a limit, for texts long enough to be judged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealens.llm.words import Words, chunks, split_words, window_hashes
from arealens.operators.materialize import TEXT_ROWS, materialize

#: Limits of the Jensen-Shannon distance (0 to 1) and the lengths from which they are applied.
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.48
MIN_CHARS = 150
MIN_WORDS = 50
#: Common words of a language, and the languages (those with most characters) whose references every task holds, about
#: 1 KB each; the references of all others are joined to their texts.
COMMON_WORDS = 60
LANGUAGES = 2048
_FLUSH_WORDS = 2 << 20

_SYMBOLS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    """Character class of each byte: lower, upper, digit, blank, stop, quote, symbol, other, beyond ASCII, none (inside a character)."""
    table = np.full(256, 7, np.int64)
    for k, chars in enumerate([range(97, 123), range(65, 91), range(48, 58), [32, *range(9, 14)], b".,;:!?", b"'\"()-", _SYMBOLS]):
        table[list(chars)] = k
    table[0xC0:] = 8
    table[0x80:0xC0] = 9
    return table


_CLASS = _classes()
N_CLASSES = 9
_IS_SYMBOL = np.isin(np.arange(256), list(_SYMBOLS))


def _class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    at = np.repeat(np.arange(rows), np.diff(offsets)) * (N_CLASSES + 1) + _CLASS[data]
    return np.bincount(at, minlength=rows * (N_CLASSES + 1)).reshape(rows, N_CLASSES + 1)[:, :N_CLASSES]


def repeated_words(hashes: np.ndarray, size: int = 5) -> int:
    """Words inside windows of ``size`` words that occur twice or more."""
    windows = window_hashes(hashes, size)
    if not len(windows):
        return 0
    _, inverse, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[inverse] > 1)
    if not len(twice):
        return 0
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line; lines end at \\n."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) of two histograms."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum()
        right = np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, (left + right) / 2)))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, part, key, n): part 0 characters by class, part 1 lower-cased words by hash."""
    classes: dict[str, np.ndarray] = {}
    words: dict[str, list[np.ndarray]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, total in classes.items():
            yield _counted(lang, 0, np.arange(N_CLASSES), total)
        for lang, hashes in words.items():
            yield _counted(lang, 1, *np.unique(np.concatenate(hashes).view(np.int64), return_counts=True))

    for batch in batches:
        langs = ["" if x is None else x for x in batch.column("lang").to_pylist()]
        for lo, hi, data, offsets in chunks(batch.column("text")):
            counts = _class_counts(data, offsets)
            found = split_words(data, offsets, lower=True)
            own = np.array(langs[lo:hi], object)
            for lang in set(langs[lo:hi]):
                rows = own == lang
                classes[lang] = classes.get(lang, 0) + counts[rows].sum(0)
                words.setdefault(lang, []).append(found.hashes[np.repeat(rows, np.diff(found.first))])
            held += len(found.hashes)
            if held > _FLUSH_WORDS:
                yield from flush()
                classes, words, held = {}, {}, 0
    yield from flush()


def _counted(lang: str, part: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    size = len(keys)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * size, pa.string()), pa.array(np.full(size, part, np.int32)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
        names=["lang", "part", "key", "n"],
    )


class References:
    """Histograms of languages: characters by class, keys of common words with their counts, all words.

    ``rest`` has the same for further languages as rows (lang, classes, keys, counts, total).
    """

    def __init__(self, classes: dict[str, np.ndarray], keys: dict[str, np.ndarray], counts: dict[str, np.ndarray], total: dict[str, int], rest: DataFrame | None = None):
        self.classes, self.keys, self.counts, self.total, self.rest = classes, keys, counts, total, rest

    def of(self, lang: str | None) -> str:
        return lang if lang in self.classes else "*"

    def local(self) -> References:
        """The references that travel to the tasks."""
        return References(self.classes, self.keys, self.counts, self.total)

    def joined(self, rows: pa.StructArray) -> References:
        """Those of the rows of a joined column, for a batch of texts of further languages."""
        found = {r["lang"]: r for r in rows.to_pylist() if r is not None}
        return References(
            {x: np.array(r["classes"]) for x, r in found.items()} | {"*": self.classes["*"]},
            {x: np.array(r["keys"], np.int64) for x, r in found.items()} | {"*": self.keys["*"]},
            {x: np.array(r["counts"], float) for x, r in found.items()} | {"*": self.counts["*"]},
            {x: r["total"] for x, r in found.items()} | {"*": self.total["*"]},
        )


def _common_words(counted: DataFrame, common: int) -> DataFrame:
    """The words of a language with the highest counts: first of each share of its words, then of all."""
    words = counted.where("part = 1").withColumn("share", F.pmod("key", F.lit(64)))
    order = (F.desc("n"), "key")
    some = words.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= common)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= common).select("lang", "key", "n")


def _further_references(counted: DataFrame, common: int) -> DataFrame:
    """References as one row for each language."""
    cells = F.map_from_entries(F.collect_list(F.struct("key", "n")))
    classes = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(N_CLASSES - 1).cast("long")), lambda k: F.coalesce(F.col("cells")[k], F.lit(0)).cast("double"))
    by_class = counted.where("part = 0").groupBy("lang").agg(cells.alias("cells")).select("lang", classes.alias("classes"))
    total = counted.where("part = 1").groupBy(F.col("lang").alias("t_lang")).agg(F.sum("n").alias("total"))
    listed = F.sort_array(F.collect_list(F.struct("key", "n")))
    words = _common_words(counted, common).groupBy(F.col("lang").alias("w_lang")).agg(listed.alias("words"))
    joined = by_class.join(total, F.col("lang") == F.col("t_lang"), "left").join(words, F.col("lang") == F.col("w_lang"), "left")
    none = F.array().cast("array<bigint>")
    return joined.select(
        "lang", "classes", F.coalesce("words.key", none).alias("keys"), F.coalesce("words.n", none).alias("counts"), F.coalesce("total", F.lit(0)).alias("total")
    )


def fit_references(docs: DataFrame, common: int = COMMON_WORDS) -> References:
    """References of every language, and over all rows, of ``docs`` (lang, text); null lang counts as the language ''."""
    counted = materialize(
        docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_gather, "lang string, part int, key long, n long").groupBy("lang", "part", "key").agg(F.sum("n").alias("n")),
        "counts",
        TEXT_ROWS,
    )
    everything = counted.groupBy("part", "key").agg(F.sum("n").alias("n")).select(F.lit("*").alias("lang"), "part", "key", "n")
    chars = counted.where("part = 0").groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1)
    langs = [r["lang"] for r in chars.collect()]
    rest = None
    if len(langs) > LANGUAGES:
        del langs[LANGUAGES:]
        known = F.broadcast(docs.sparkSession.createDataFrame([(x,) for x in langs], "lang string"))
        rest = materialize(_further_references(counted.join(known, "lang", "left_anti"), common), "references")
        counted = counted.join(known, "lang", "left_semi")
    counted = counted.unionByName(everything)
    top = _common_words(counted, common).collect()
    total = {r["lang"]: r["n"] for r in counted.where("part = 1").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    classes = {x: np.zeros(N_CLASSES) for x in [*langs, "*"]}
    for r in counted.where("part = 0").collect():
        classes[r["lang"]][r["key"]] = r["n"]
    found: dict[str, list[tuple[int, int]]] = {x: [] for x in classes}
    for r in top:
        found[r["lang"]].append((r["key"], r["n"]))
    keys = {x: np.array([k for k, _ in sorted(v)], np.int64) for x, v in found.items()}
    counts = {x: np.array([n for _, n in sorted(v)], float) for x, v in found.items()}
    return References(classes, keys, counts, {x: int(total.get(x, 0)) for x in classes}, rest)


def _judge(row: int, words: Words, lower: np.ndarray, classes: np.ndarray, lang: str | None, refs: References) -> tuple[float, float]:
    """Distances of a text's two histograms from its language; 0 where a text is too short."""
    name = refs.of("" if lang is None else lang)
    hashes = lower[words.first[row] : words.first[row + 1]]
    by_class = by_word = 0.0
    if classes.sum() >= MIN_CHARS and refs.classes[name].sum():
        by_class = _distance(classes.astype(float), refs.classes[name])
    keys = refs.keys[name]
    if len(hashes) >= MIN_WORDS and len(keys):
        own = hashes.view(np.int64)
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        known = np.bincount(at[keys[at] == own], minlength=len(keys)).astype(float)
        by_word = _distance(np.append(known, len(own) - known.sum()), np.append(refs.counts[name], refs.total[name] - refs.counts[name].sum()))
    return by_class, by_word


def _measure(batch: pa.RecordBatch, refs: References) -> list[np.ndarray]:
    n = batch.num_rows
    langs = batch.column("lang").to_pylist()
    out = np.zeros((5, n), np.int64)
    distance = np.zeros((2, n))
    texts = batch.column("text")
    for lo, hi, data, offsets in chunks(texts):
        words = split_words(data, offsets)
        lower = split_words(data, offsets, lower=True).hashes
        classes = _class_counts(data, offsets)
        symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[data])])
        out[0, lo:hi] = np.diff(words.first)
        out[1, lo:hi] = classes.sum(1) - classes[:, 3]
        out[2, lo:hi] = np.diff(symbols[offsets])
        for row in range(hi - lo):
            out[3, lo + row] = repeated_lines(texts[lo + row].as_py() or "")
            out[4, lo + row] = repeated_words(words.hashes[words.first[row] : words.first[row + 1]])
            distance[:, lo + row] = _judge(row, words, lower, classes[row], langs[lo + row], refs)
    failed = (out[0] < 10) | (100 * out[4] > 20 * out[0])
    kept = ~failed & (distance[0] <= MAX_CLASS_DISTANCE) & (distance[1] <= MAX_WORD_DISTANCE)
    return [*out, failed, kept, *distance]


def measure_quality(docs: DataFrame, refs: References) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, class_distance, word_distance.

    Null and empty texts have no words and fail the base rule. Texts under ``MIN_CHARS`` characters or
    ``MIN_WORDS`` words are not judged by that histogram (distance 0). Repeated rows get equal results,
    further columns are ignored, an empty table gives no rows.
    """

    def rows(batch: pa.RecordBatch, values: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, values)], names=names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]
    kinds = ["long"] * 6 + ["boolean"] * 2 + ["double"] * 2
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return _judged(given, refs, rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def _judged(docs: DataFrame, refs: References, rows: Callable, schema) -> DataFrame:
    """``rows(batch, values)`` of all rows; those of further languages with their references joined."""
    held = refs.local()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows(batch, _measure(batch, held))

    if refs.rest is None:
        return docs.mapInArrow(run, schema)
    extra = "reference"
    while extra in docs.columns:
        extra += "_"

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows(batch.drop_columns([extra]), _measure(batch, held.joined(batch.column(extra))))

    lang = F.coalesce(docs["lang"].cast("string"), F.lit(""))
    known = lang.isin([x for x in held.classes if x != "*"])
    # each of these languages has fewer characters than any of the others: no key is hot
    table = refs.rest.select(F.struct(*refs.rest.columns).alias(extra))
    further = docs.where(~known).join(table, lang == F.col(f"{extra}.lang"), "left")
    return docs.where(known).mapInArrow(run, schema).unionByName(further.mapInArrow(run_joined, schema))


def keep_usual(docs: DataFrame, refs: References) -> DataFrame:
    """The rows of ``docs`` that ``measure_quality`` keeps, with their columns."""
    return _judged(docs, refs, lambda batch, values: batch.filter(pa.array(values[6])), docs.schema)
