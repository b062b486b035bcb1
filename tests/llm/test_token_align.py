"""Token alignment against whole texts encoded and compared token by token."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from arealens.llm.token_align import EMPTY, Fragment, Tokens, align_tokenizers, compose
from tests.llm.helpers import ODD_TEXTS, documents, prose

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def byte_table():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, k = {}, 0
    for i in range(256):
        if i in keep:
            table[chr(i)] = i
        else:
            table[chr(256 + k)] = i
            k += 1
    return table


def spans(ids, sizes):
    at, out = 0, []
    for i, n in zip(ids, sizes):
        out.append((i, at, at + n))
        at += n
    return out


def brute(texts):
    a_tok, b_tok, table = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), byte_table()
    a_tok.encode_special_tokens = True
    docs = []
    for text in texts:
        if not text:
            docs.append(([], [], []))
            continue
        a, b, whole = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text), (" " + text).encode()
        a_parts = [bytes(table[c] for c in a_tok.id_to_token(i)) for i in a]
        b_parts = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_tok.id_to_piece(i)) for i in b)]
        if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            docs.append(([], [], []))
            continue
        a, b = spans(a, map(len, a_parts)), spans(b, map(len, b_parts))
        links, j = [], 0
        for i, lo, hi in a:
            while b[j][2] <= lo:
                j += 1
            links += [(i, other) for other, begin, end in b[j : j + 40] if begin < hi and end > lo]
        docs.append((a, b, links))
    count = Counter(pair for *_, links in docs for pair in set(links))
    highest = defaultdict(int)
    for (i, _), n in count.items():
        highest[i] = max(highest[i], n)
    out = []
    for at, (a, b, links) in enumerate(docs):
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [[[str(i) for i, lo, hi in t if begin <= lo and hi <= end] for t in (a, b)] for begin, end in zip([0, *ends], ends)] if len(a) < 3000 else slow_groups(a, b, ends)
        text = ";".join("|".join(map(",".join, g)) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((at, len(a), len(b), len(ends), len(links), sum(count[p] == highest[p[0]] for p in links), sum(count[p] for p in links), digest))
    return sorted(out)


def slow_groups(a, b, ends):
    groups, a, b = [], list(a), list(b)
    for end in ends:
        group = []
        for side in (a, b):
            k = next(k for k, t in enumerate(side) if t[2] == end) + 1
            group.append([str(i) for i, *_ in side[:k]])
            del side[:k]
        groups.append(group)
    return groups


def texts():
    rng = random.Random(5)
    chars = ["a", "B", " ", " ", "  ", "\n", "\t", "é", "ß", "漢", "字", "🙂", "'s", "1", "23", ".", "…", " ", "　", " ", " ", "<s>", "<0x41>", "the", " and", "\x00", "\x1c", "\x85"]
    noise = ["".join(rng.choice(chars) for _ in range(rng.randrange(1, 80))) for _ in range(150)]
    special = ["<|endoftext|> x", "x <unk> </s>", "a ▁ b", "x▁y", "  two", "two  ", " ", "\n", "don't we'll", "漢字" * 60, "नमस्ते दुनिया", "é ﬁn", "x" * 300, " " * 90, "a" + " " * 40 + "b"]
    return [*[t for t in ODD_TEXTS if len(t or "") < 1000], *special, *noise, *[prose(k, 60) for k in range(20)], prose(1, 60), prose(9, 2000), "Ünïcödé wörds " * 40]


@pytest.mark.parametrize("size, frequent", [(1 << 16, 1 << 20), (64, 500), (7, 0)])
def test_alignment_equals_brute_force(spark, size, frequent):
    given = texts() if size > 7 else texts()[:120]
    got = align_tokenizers(documents(spark, given), *PATHS, size, frequent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(given)


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(5, "one two"), (5, "one two"), (None, "one"), (None, None), (6, "")], "doc_id long, text string")
    got = sorted(map(tuple, align_tokenizers(df, *PATHS, 4).collect()), key=str)
    want = brute(["one two", "one two", "one", None, ""])
    assert got == sorted([(i, *w[1:]) for i, w in zip([5, 5, None, None, 6], want)], key=str)
    assert align_tokenizers(df.limit(0), *PATHS).collect() == []


def test_long_documents_when_joins_become_broadcasts_at_run_time(spark):
    given = [prose(k, 40 + 9 * k) for k in range(12)]
    names = {"spark.sql.autoBroadcastJoinThreshold": "1000", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB"}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        got = align_tokenizers(documents(spark, given), *PATHS, 64).collect()
    finally:
        for name in names:
            spark.conf.unset(name)
    assert sorted(map(tuple, got)) == brute(given)


def test_bytes_that_are_no_text(spark):
    df = spark.sql("SELECT 1L AS doc_id, cast(x'61FF62' AS string) AS text UNION ALL SELECT 2L, 'ab cd' UNION ALL SELECT 3L, concat(repeat('a ', 40), cast(x'E280' AS string))")
    want = [(0, 0, 0, 0, 0, 0, ""), brute(["ab cd"])[0][1:], (0, 0, 0, 0, 0, 0, "")]
    for size in (64, 1 << 16):
        assert sorted(map(tuple, align_tokenizers(df, *PATHS, size).collect())) == [(i + 1, *w) for i, w in enumerate(want)]


def test_composition_is_associative():
    rng = random.Random(2)

    def state(f):
        return f.cut, f.last, [v.tolist() for t in (f.prefix, f.suffix) for v in t[:4]]

    for _ in range(50):
        a_ends, b_ends = (np.array(sorted({*rng.sample(range(1, 60), 20), 60})) for _ in range(2))
        whole = Tokens(np.arange(len(a_ends)), a_ends, np.arange(len(b_ends)), b_ends)
        bounds = sorted({0, 60, *rng.sample(range(60), 9)})
        parts = []
        for lo, hi in zip(bounds, bounds[1:]):
            t = whole.within(lo, hi)
            cuts = np.intersect1d(t.a_ends, t.b_ends)
            parts.append(Fragment(True, t.within(-1, cuts[0]), int(cuts[-1]), t.within(cuts[-1], hi)) if len(cuts) else Fragment(False, t, 0, EMPTY))
        left = reduce(lambda x, y: compose(x, y)[0], parts)
        right = reduce(lambda y, x: compose(x, y)[0], reversed(parts))
        assert state(left) == state(right)
