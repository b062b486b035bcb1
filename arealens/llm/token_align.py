"""Alignment of two tokenizers by an associative fragment monoid.

A stretch of a document, given by byte range, is a fragment: tokens before the first place where both tokenizers
end a token (the open prefix), closed groups between such places, and tokens after the last one (the open
suffix). A range without such a place is one open part. Fragments compose: a suffix and the next prefix make one
closed group. This is associative, so the ranges of a very long document are encoded in tasks of their own and
composed as a tree; what is closed leaves the tree at once as a finished piece, only the open ends travel. A
document of one range is closed at both ends and needs no tree.

Groups and links come from marks on byte positions: each place where at least one tokenizer ends a token closes
exactly one overlap of an A with a B token, each place where both do closes a group.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.llm.token_units import Pool, crosses_blank, may_follow, ragged, safe_places
from arealens.operators.materialize import materialize

#: Bytes of a range. Longer documents are shared out over tasks; results do not depend on it.
RANGE = 1 << 16
#: Ranges composed at once.
FAN = 16
#: Pairs with the highest counts that are broadcast (12 bytes each); the links of all others are joined.
FREQUENT = 1 << 20
_CHUNK_BYTES = 1 << 20


class Tokens(NamedTuple):
    """Ids and the byte positions where they end, for both tokenizers; ``sound`` is false where bytes were changed."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray
    sound: bool = True

    def within(self, lo: int, hi: int) -> Tokens:
        p, q = np.searchsorted(self.a_ends, [lo, hi], "right")
        r, s = np.searchsorted(self.b_ends, [lo, hi], "right")
        return Tokens(self.a[p:q], self.a_ends[p:q], self.b[r:s], self.b_ends[r:s], self.sound)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*[np.concatenate(p) for p in zip(self[:4], other[:4])], self.sound and other.sound)


EMPTY = Tokens(*[np.zeros(0, np.int64)] * 4)


class Fragment(NamedTuple):
    """Without ``cut`` the tokens are all in ``prefix``; else ``last`` is the place where ``suffix`` begins."""

    cut: bool
    prefix: Tokens
    last: int
    suffix: Tokens


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, tuple[int, Tokens] | None]:
    """The fragment of two neighbouring ranges, and the group (begin, tokens) that closes between them."""
    if not y.cut:
        return (Fragment(True, x.prefix, x.last, x.suffix + y.prefix) if x.cut else Fragment(False, x.prefix + y.prefix, 0, EMPTY)), None
    if not x.cut:
        return Fragment(True, x.prefix + y.prefix, y.last, y.suffix), None
    return Fragment(True, x.prefix, y.last, y.suffix), (x.last, x.suffix + y.prefix)


def _digits(size: int) -> np.ndarray:
    """(3, size, 6) bytes: each number followed by a comma, a bar or a semicolon; zero bytes are filling."""
    table = np.zeros((3, size, 6), np.uint8)
    for i in range(size):
        text = str(i).encode()
        table[:, i, : len(text)] = list(text)
        table[:, i, len(text)] = list(b",|;")
    return table


class _Codec:
    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [i for i in range(256) if i not in printable]
        byte_of = {chr(i): i for i in printable} | {chr(256 + k): i for k, i in enumerate(others)}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else b""
        self.b_bytes = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            special = self.b.is_unknown(i) or self.b.is_control(i)
            self.b_bytes.append(b"" if special else bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if any(crosses_blank(token) for token in [*self.a_bytes, *self.b_bytes]):
            raise ValueError("a token must not hold a blank after what is no white space")
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("ids must be below 65536")
        self.a_sizes, self.b_sizes = (np.array(list(map(len, table)), np.int32) for table in (self.a_bytes, self.b_bytes))
        self.text_of = _digits(max(len(self.a_bytes), len(self.b_bytes)))
        self.text_size = (self.text_of[0] > 0).sum(axis=1)
        self.pool = Pool(self._encode, 700_000)

    def _encode(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Rows (tokenizer 0 or 1, id, bytes) of each stretch, which begins with a blank; none where its bytes change.

        Stretches that end and go on without white space are encoded as one text, whose tokens end where they do.
        """
        plain = np.fromiter(map(may_follow, stretches), bool, len(stretches))
        together = np.flatnonzero(plain)
        parts, owners = [], []
        rows = self._rows(b"".join([stretches[i] for i in together])) if len(together) else None
        if rows is None:
            plain[:] = False
        else:
            ends = np.cumsum([len(stretches[i]) for i in together])
            for side in rows:
                parts.append(side)
                owners.append(together[np.searchsorted(ends, np.cumsum(side[:, 2]), "left")])
        for i in np.flatnonzero(~plain):
            for side in self._rows(stretches[i]) or []:
                parts.append(side)
                owners.append(np.full(len(side), i))
        if not parts:
            return np.zeros(len(stretches), np.int64), np.zeros((0, 3), np.int32)
        owner, found = np.concatenate(owners), np.concatenate(parts)
        return np.bincount(owner, minlength=len(stretches)), found[np.argsort(2 * owner + found[:, 0], kind="stable")]

    def _rows(self, stretch: bytes) -> list[np.ndarray] | None:
        """Rows of both tokenizers, None where one of them changes the bytes, as both do with bytes that are no UTF-8."""
        try:
            text = stretch.decode()
        except UnicodeDecodeError:
            return None
        out = []
        for k, ids, table, sizes in ((0, self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.a_bytes, self.a_sizes), (1, self.b.encode(text[1:]), self.b_bytes, self.b_sizes)):
            rows = np.empty((len(ids), 3), np.int32)
            rows[:, 0], rows[:, 1] = k, ids
            rows[:, 2] = sizes[rows[:, 1]]
            if (rows[:, 2] == 0).any() or b"".join(map(table.__getitem__, ids)) != stretch:
                return None
            out.append(rows)
        return out

    def tokens(self, data: np.ndarray, starts: np.ndarray) -> tuple[Tokens, np.ndarray]:
        """Tokens of texts that begin, with a blank, at ``starts``, and which of them are sound.

        The ends count the bytes of sound texts only.
        """
        marks = np.zeros(len(data) + 1, bool)
        marks[starts], marks[safe_places(data)], marks[-1] = True, True, True
        bounds = np.flatnonzero(marks)
        units = self.pool.look_up(data, bounds)
        first, counts = self.pool.first[units], self.pool.counts[units]
        text_of_unit = np.searchsorted(starts, bounds[:-1], "right") - 1
        sound = np.ones(len(starts), bool)
        sound[text_of_unit[counts == 0]] = False
        keep = sound[text_of_unit]
        rows = self.pool.tokens[ragged(first[keep], counts[keep])]
        parts = []
        for k in (0, 1):
            mine = rows[rows[:, 0] == k]
            parts += [mine[:, 1].astype(np.int64), np.cumsum(mine[:, 2], dtype=np.int64)]
        return Tokens(*parts, bool(sound.all())), sound

    def align(self, t: Tokens, bounds: np.ndarray):
        """Per text (its bytes end at ``bounds[1:]``): counts (n_a, n_b, n_groups, n_links), group text; and of all
        links: text, pair of ids. Every text ends where both tokenizers end a token; its group text ends with ';'."""
        end = int(bounds[-1])
        marks = [np.zeros(end + 1, bool) for _ in range(2)]
        marks[0][t.a_ends], marks[1][t.b_ends] = True, True
        both, some = marks[0] & marks[1], marks[0] | marks[1]
        n_a, n_b, n_both, n_some = (np.cumsum(m, dtype=np.int64) for m in (*marks, both, some))
        numbers = [np.diff(n[bounds]) for n in (n_a, n_b, n_both, n_some)]
        at = np.flatnonzero(some)
        pairs = (t.a[n_a[at - 1]] << 16) | t.b[n_b[at - 1]]
        owner = np.searchsorted(bounds, at, "left") - 1
        cuts = np.append(0, np.flatnonzero(both))
        ids, kinds = np.empty(len(t.a) + len(t.b), np.int64), np.empty(len(t.a) + len(t.b), np.int64)
        place = np.arange(len(t.a)) + n_b[cuts[n_both[t.a_ends - 1]]]
        ids[place], kinds[place] = t.a, np.where(both[t.a_ends], 1, 0)
        place = np.arange(len(t.b)) + n_a[cuts[n_both[t.b_ends - 1] + 1]]
        ids[place], kinds[place] = t.b, np.where(both[t.b_ends], 2, 0)
        text = self.text_of[kinds, ids].ravel()
        text = text[text > 0]
        sizes = np.append(0, np.cumsum(self.text_size[ids]))
        ends = sizes[n_a[bounds] + n_b[bounds]]
        return numbers, [text[lo:hi] for lo, hi in zip(ends[:-1], ends[1:])], owner, pairs


_codecs: dict[tuple[str, str], _Codec] = {}


def _codec(a_path: str, b_path: str) -> _Codec:
    if (a_path, b_path) not in _codecs:
        _codecs[a_path, b_path] = _Codec(a_path, b_path)
    return _codecs[a_path, b_path]


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)), pa.array(values))


def _distinct(owner: np.ndarray, pairs: np.ndarray, n: int) -> tuple[pa.ListArray, pa.ListArray]:
    """Distinct pairs of each text as signed 32-bit numbers, and how often it links them."""
    found, times = np.unique((owner << 32) | pairs, return_counts=True)
    return (
        _lists((found & 0xFFFFFFFF).astype(np.uint32).view(np.int32), found >> 32, n),
        _lists(times.astype(np.int32), found >> 32, n),
    )


_SHORT = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"


def _align_short(a_path: str, b_path: str):
    names = [part.split()[0] for part in _SHORT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(a_path, b_path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            lo, ends = 0, np.cumsum(sizes)
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + _CHUNK_BYTES, "left")))
                yield _short_rows(codec, batch.slice(lo, hi - lo), sizes[lo:hi], names)
                lo = hi

    return run


def _short_rows(codec: _Codec, batch: pa.RecordBatch, sizes: np.ndarray, names: list[str]) -> pa.RecordBatch:
    n = batch.num_rows
    given = np.flatnonzero(sizes > 0)
    texts = batch.column("text").cast(pa.binary()).take(pa.array(given)).to_pylist()
    data = np.frombuffer(b" " + b" ".join(texts), np.uint8) if texts else np.zeros(0, np.uint8)
    lengths = sizes[given] + 1
    numbers, digests = np.zeros((4, n), np.int64), [""] * n
    owner, pairs = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(given):
        tokens, sound = codec.tokens(data, np.cumsum(lengths) - lengths)
        good = given[sound]
        if len(good):
            found, groups, owner, pairs = codec.align(tokens, np.append(0, np.cumsum(lengths[sound])))
            numbers[:, good] = found
            owner = good[owner]
            for at, text in zip(good.tolist(), groups):
                digests[at] = hashlib.sha256(text[:-1]).hexdigest()
    columns = [batch.column("row"), batch.column("doc_id"), *[pa.array(v) for v in numbers], pa.array(digests), *_distinct(owner, pairs, n)]
    return pa.RecordBatch.from_arrays(columns, names)


def _cut_ranges(size: int):
    """Byte ranges of long texts with the whole stretches that cover them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").cast(pa.binary())):
                data = b" " + text.as_py()
                places = np.concatenate([[0], safe_places(np.frombuffer(data, np.uint8)), [len(data)]])
                for k, lo in enumerate(range(0, len(data), size)):
                    hi = min(lo + size, len(data))
                    begin = int(places[np.searchsorted(places, lo, "right") - 1])
                    end = int(places[np.searchsorted(places, hi, "left")])
                    yield pa.RecordBatch.from_pylist([{"row": row, "k": k, "lo": lo, "hi": hi, "begin": begin, "data": data[begin:end]}], schema=arrow)

    arrow = pa.schema([(c, pa.int64()) for c in ("row", "k", "lo", "hi", "begin")] + [("data", pa.binary())])
    return run


_OPEN = ["a", "a_ends", "b", "b_ends"]
_PARTS = ", ".join(
    ["row long", "k long", "begin long", "groups binary", "n_a long", "n_b long", "n_groups long", "n_links long", "pairs array<int>", "times array<int>"]
    + ["cut boolean", "last long", "sound boolean", *[f"{side}_{c} array<long>" for side in ("prefix", "suffix") for c in _OPEN]]
)
_PART_NAMES = [part.split()[0] for part in _PARTS.split(", ")]


def _piece(codec: _Codec, row: int, begin: int, tokens: Tokens) -> dict:
    """A finished piece: groups that are closed at ``begin`` and at the last end."""
    shifted = tokens._replace(a_ends=tokens.a_ends - begin, b_ends=tokens.b_ends - begin)
    numbers, groups, owner, pairs = codec.align(shifted, np.array([0, shifted.a_ends[-1]]))
    found, times = _distinct(owner, pairs, 1)
    names = ("n_a", "n_b", "n_groups", "n_links")
    return {"row": row, "begin": begin, "groups": groups[0].tobytes(), "pairs": found[0].as_py(), "times": times[0].as_py()} | {c: int(v[0]) for c, v in zip(names, numbers)}


def _fragment_row(row: int, k: int, f: Fragment) -> dict:
    sides = {f"{side}_{c}": v.tolist() for side, t in (("prefix", f.prefix), ("suffix", f.suffix)) for c, v in zip(_OPEN, t[:4])}
    return {"row": row, "k": k, "cut": f.cut, "last": f.last, "sound": f.prefix.sound and f.suffix.sound} | sides


def _read_fragment(r: dict) -> Fragment:
    prefix, suffix = (Tokens(*[np.array(r[f"{side}_{c}"], np.int64) for c in _OPEN], r["sound"]) for side in ("prefix", "suffix"))
    return Fragment(r["cut"], prefix, r["last"], suffix)


def _parts_table(rows: list[dict]) -> pa.Table:
    kinds = {"array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "binary": pa.binary(), "boolean": pa.bool_(), "long": pa.int64()}
    schema = pa.schema([(c, kinds[kind]) for c, kind in (part.split() for part in _PARTS.split(", "))])
    return pa.Table.from_pylist(rows, schema=schema)


def _range_rows(codec: _Codec, row: int, k: int, lo: int, hi: int, begin: int, data: bytes) -> list[dict]:
    """The fragment of one range, and what is closed inside it as a piece."""
    found, sound = codec.tokens(np.frombuffer(data, np.uint8), np.zeros(1, np.int64))
    if not sound[0]:
        return [_fragment_row(row, k, Fragment(lo == 0, EMPTY._replace(sound=False), 0, EMPTY))]
    tokens = found._replace(a_ends=found.a_ends + begin, b_ends=found.b_ends + begin).within(lo, hi)
    cuts = np.intersect1d(tokens.a_ends, tokens.b_ends, assume_unique=True)
    if lo == 0:
        cuts = np.append(0, cuts)  # a document begins closed
    if not len(cuts):
        return [_fragment_row(row, k, Fragment(False, tokens, 0, EMPTY))]
    first, last = int(cuts[0]), int(cuts[-1])
    out = [_fragment_row(row, k, Fragment(True, tokens.within(-1, first), last, tokens.within(last, hi)))]
    if last > first:
        out.append(_piece(codec, row, first, tokens.within(first, last)))
    return out


def _fragments(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(a_path, b_path)
        for batch in batches:
            for r in batch.to_pylist():
                yield from _parts_table(_range_rows(codec, r["row"], r["k"], r["lo"], r["hi"], r["begin"], r["data"])).to_batches()

    return run


def _compose_group(a_path: str, b_path: str):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        whole, out = _read_fragment(rows[0]), []
        for r in rows[1:]:
            whole, closed = compose(whole, _read_fragment(r))
            if closed and whole.prefix.sound and closed[1].sound and len(closed[1].a):
                out.append(_piece(_codec(a_path, b_path), r["row"], *closed))
        sound = all(r["sound"] for r in rows)
        return _parts_table([_fragment_row(rows[0]["row"], rows[0]["k"] // FAN, whole) | {"sound": sound}, *out])

    return run


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the pieces of each row, which come in order; the last semicolon is left out."""

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r for r, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], ["row", "groups_sha256"])

    current, digest, held = None, None, b""
    for batch in batches:
        done = []
        for row, text in zip(batch.column("row").to_pylist(), batch.column("groups")):
            if row != current:
                if digest:
                    done.append((current, digest.hexdigest()))
                current, digest, held = row, hashlib.sha256(), b""
            digest.update(held)
            text = text.as_buffer()
            digest.update(text[: len(text) - 1])
            held = b";"
        yield rows(done)
    if digest:
        yield rows([(current, digest.hexdigest())])


def _align_long(docs: DataFrame, a_path: str, b_path: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, counts, groups_sha256) and (row, pair, times) of documents of more than one range."""
    ids = materialize(docs, "long")
    ranges = ids.select("row", "text").mapInArrow(_cut_ranges(size), "row long, k long, lo long, hi long, begin long, data binary")
    parts = [materialize(ranges.repartition("row", "k").mapInArrow(_fragments(a_path, b_path), _PARTS), "ranges")]
    top = parts[0].agg(F.max("k")).first()[0] or 0
    tree = [c for c in _PART_NAMES if c not in ("begin", "groups", "n_a", "n_b", "n_groups", "n_links", "pairs", "times")]
    while top:
        open_ = parts[-1].where("k is not null").select(*tree)
        composed = open_.groupBy("row", F.expr(f"k div {FAN}").alias("above")).applyInArrow(_compose_group(a_path, b_path), _PARTS)
        parts.append(materialize(composed, "composed"))
        top //= FAN
    pieces = parts[0].where("k is null")
    for more in parts[1:]:
        pieces = pieces.unionByName(more.where("k is null"))
    roots = ids.select("row", "doc_id").join(parts[-1].where("k is not null").select("row", "sound"), "row").where("sound")
    # Written, for the pieces of a row to be shuffled together by the repartitioning itself: one that the joins before it
    # already meet is left out of the plan, and those joins may be changed at run time.
    pieces = materialize(pieces.join(roots.select("row"), "row", "left_semi").drop(*[c for c in tree if c != "row"]), "pieces")
    numbers = pieces.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")])
    ordered = pieces.select("row", "begin", "groups").repartition("row").sortWithinPartitions("row", "begin")
    digests = ordered.select("row", "groups").mapInArrow(_digest_pieces, "row long, groups_sha256 string")
    found = ids.select("row", "doc_id").join(numbers, "row", "left").join(digests, "row", "left")
    found = found.fillna(0, ["n_a", "n_b", "n_groups", "n_links"]).fillna("", ["groups_sha256"])
    links = pieces.selectExpr("row", "inline(arrays_zip(pairs, times))").groupBy("row", F.col("pairs").alias("pair")).agg(F.sum("times").alias("times"))
    return materialize(found, "long_counts"), materialize(links, "long_links")


def _frequent(counts: DataFrame, limit: int) -> tuple[int, bool]:
    """The count from which on at most ``limit`` pairs are left, and whether that leaves out any."""
    level = F.floor(F.log2("n") * 8).alias("level")
    levels = sorted(counts.groupBy(level).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("n")).collect(), key=lambda r: -r["level"])
    total, least = 0, None  # a few hundred levels at most
    for r in levels:
        total += r["pairs"]
        if total > limit:
            return (least if least is not None else 1 << 62), True
        least = r["n"]
    return (least or 0), False


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, size: int = RANGE, frequent: int = FREQUENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A, a byte-level tokenizer (``tokenizers`` file), reads a blank and the text; B, a sentencepiece model that
    sets a blank in front, the text. Null and empty texts, and texts whose bytes either of them changes (so all that are
    no UTF-8), have no tokens: zeros and an empty digest. A pair of ids counts once for each document (row) that links it.
    Repeated rows and null ids are rows like others; further columns are ignored; an empty table gives no rows.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") >= size, F.lit(False))  # with the blank in front more than one range
    number = F.monotonically_increasing_id() * 2
    short = text.where(~is_long).select(number.alias("row"), "doc_id", "text").mapInArrow(_align_short(a_path, b_path), _SHORT)
    short = materialize(short, "short")
    long, long_links = _align_long(text.where(is_long).select((number + 1).alias("row"), "doc_id", "text"), a_path, b_path, size)
    links = short.selectExpr("row", "inline(arrays_zip(pairs, times)) AS (pair, times)").unionByName(long_links)
    counts = links.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    highest = counts.groupBy(F.shiftrightunsigned("pair", 16).alias("a")).agg(F.max("n").alias("highest"))
    counts = counts.join(highest, F.shiftrightunsigned("pair", 16) == F.col("a")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    counts = materialize(counts, "pair_counts")
    least, more = _frequent(counts, frequent)
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    known = F.broadcast(counts.where(F.col("n") >= least))  # at most ``frequent`` rows
    totals = links.join(known, "pair").groupBy("row").agg(*sums)
    if more:
        rare = links.join(known.select("pair"), "pair", "left_anti").join(counts.where(F.col("n") < least), "pair")
        totals = totals.unionByName(rare.groupBy("row").agg(*sums)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    found = short.select("row", "doc_id", *numbers, "groups_sha256").unionByName(long.select("row", "doc_id", *numbers, "groups_sha256"))
    joined = found.join(totals, "row", "left").fillna(0, ["n_best", "count_sum"])
    return joined.select("doc_id", *numbers, "n_best", "count_sum", "groups_sha256")
