"""Quality rules, importance resampling, toxicity and HTML extraction against direct computation."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from arealens.llm.divergence import fit_references, keep_usual, measure_quality, repeated_words
from arealens.llm.html_text import TREE, extract_pages, grow_tree, main_text
from arealens.llm.importance import _kth_largest, fit_importance, keep_drawn, resample
from arealens.llm.toxicity import BATCH, Network, _encode, _merge, _windows, fit_toxicity, score_toxicity, train_network
from arealens.llm.words import chunks, split_words
from tests.llm.helpers import ODD_TEXTS, documents, prose, words


def test_words_are_split_as_defined():
    texts = [*ODD_TEXTS, "A b\x0bC", "\x0c x", "end ", "über ALLES"]
    for limit in (1, 1 << 20):
        got = []
        for lo, hi, data, offsets in chunks(pa.array(texts), limit):
            w = split_words(data, offsets, lower=True)
            got += [[bytes(w.data[a:b]).decode() for a, b in zip(w.starts[w.first[r] : w.first[r + 1]], w.ends[w.first[r] : w.first[r + 1]])] for r in range(hi - lo)]
        assert got == [words(t) for t in texts]


def base(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 5)}
    failed = len(found) < 10 or 100 * len(inside) > 20 * len(found)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed


def test_quality_rules(spark):
    junk = " ".join(f"%%{i}$$ ||" for i in range(120))
    texts = [*ODD_TEXTS, *[prose(k, 150) for k in range(40)], "l one\nl one\n \nl one\nx", ("a b c d e f g " * 3) + prose(5, 30), junk, "né " * 4 + prose(6, 20)]
    docs = documents(spark, texts)
    refs = fit_references(docs)
    rows = {r.doc_id: r for r in measure_quality(docs, refs).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), t
        assert not (r.base_failed and r.kept)
    clean = range(len(ODD_TEXTS), len(ODD_TEXTS) + 40)
    assert all(rows[i].kept for i in clean) and not rows[texts.index(junk)].kept
    kept = keep_usual(docs, refs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}
    none = docs.where("false")
    assert measure_quality(none, fit_references(none)).collect() == []
    other = docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang")
    assert measure_quality(other, refs).count() == len(texts)
    assert repeated_words(np.array([1, 1, 1, 1, 1, 1], np.uint64)) == 6


def test_importance(spark):
    good = [prose(k, 120) for k in range(80)]
    bad = [" ".join(f"zz{(7 * k + j) % 50}%%" for j in range(120)) for k in range(20)]
    texts = [*good, *bad, *ODD_TEXTS]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 80), 0) for i in range(0, 100, 2)] + [(None, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    model, rows = fit_importance(docs, labels)
    got = {r.doc_id: r for r in rows.collect()}
    assert all(got[i].kept for i in range(80)) and not any(got[i].kept for i in range(80, 100))
    assert got[100].log_weight == got[101].log_weight == 0
    kept = keep_drawn(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    twice = {(r.doc_id, r.sample_key) for r in resample(docs.unionByName(docs), labels).collect()}
    assert len(twice) == len(texts)
    assert all(r.kept for r in resample(docs, labels.where("false")).collect())
    assert resample(docs.where("false"), labels).collect() == []


def test_kth_largest(spark):
    values = [float(v) for v in np.random.default_rng(1).normal(size=3000)] + [0.25] * 500
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 700, 1500, 3500):
        assert _kth_largest(df, "v", k) == ordered[k - 1]


def _prepared(texts):
    out = []
    for t in texts:
        _, _, data, offsets = next(chunks(pa.array([t]), 1 << 30))
        w = split_words(data, offsets, lower=True)
        index, vocabulary = _encode(w.data, w.starts, w.ends, w.hashes)
        out.append((vocabulary, *_windows(index, w.first)))
    return out


def test_network_gradient_is_the_slope():
    net = Network(3)
    net.p = {k: v.astype(np.float64) * (20 if k in ("word", "char") else 1) for k, v in net.p.items()}
    merged, ids, _ = _merge(_prepared([prose(1, 40, 30), prose(2, 9, 30)]))

    def logits():
        return net.forward(net.embed(merged).astype(np.float64), ids)[0]

    inputs = net.embed(merged).astype(np.float64)
    logit, kept = net.forward(inputs, ids, keep=True)
    error = np.arange(1, len(logit) + 1) / 7
    grads = net.gradient(inputs, ids, merged, kept, error)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        spots = np.argwhere(np.abs(grads[name]) > 1e-6) if value.ndim > 1 else np.arange(len(value))[:, None]
        for spot in rng.permutation(spots)[:4]:
            at, step = tuple(spot), 1e-3
            value[at] += step
            up = (logits() * error).sum()
            value[at] -= 2 * step
            down = (logits() * error).sum()
            value[at] += step
            assert grads[name][at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-3), name


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 200):
        ids, row = _windows(np.arange(1, n + 1), np.array([0, n]))
        assert set(ids.ravel()) - {0} == set(range(1, n + 1)) and set(row) == {0} and ids.shape[1] == 32


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(5)
    texts, toxic = [], []
    for k in range(300):
        t = prose(k, int(rng.integers(5, 200))).split()
        toxic.append(int(k % 3 == 0))
        if toxic[-1]:
            t.insert(int(rng.integers(0, len(t))), ["vileword", "vilest", "foulmouth"][k % 9 // 3])
        texts.append(" ".join(t))
    docs = documents(spark, [*texts, *ODD_TEXTS])
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(rows[i].held_out == (i in held) for i in range(300))
    assert np.mean([rows[i].predicted == toxic[i] for i in held]) > 0.85 and len(held) > BATCH // 2
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values()) and len(rows) == 300 + len(ODD_TEXTS)
    assert score_toxicity(docs.where("false"), train_network([], [])).collect() == []
    assert fit_toxicity(docs, labels.where("false")).score_texts(pa.array(["x"]))[0] < 0


PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style><script>if (a < b) document.write("<p>no</p>")</script></head><body class="home">
<header><h1>Site name</h1><nav><ul><li><a href="/">Home</a><li><a href="/a">About us</a></ul></nav></header><div id="cookie-consent"><p>We use cookies on this site to do many things for you.</p></div>
<main><article><header><h1>Big &amp; small</h1></header><p>First <b>para</b>graph<br>with&nbsp;a <a href="x">link</a>.<p>Second\n  one &lt;3 &#233;.<ul><li>item</ul><!-- <p>gone</p> --><aside><p>See also these other things.</p></aside>
<form><label>Mail</label><input></form><section class="comments"><p>Nice, said a reader at great length.</p></section></article></main><footer>&copy; 2024 Somebody</footer>"""


def test_html_main_text(spark):
    assert main_text(PAGE) == "Big & small\nFirst paragraph with a link.\nSecond one <3 é.\nitem"
    pages = [None, "", "no tags here", "<", "<p", "<p>a<", "<script>x", "</div></p>", "<p>" * 3000 + "deep", PAGE]
    df = spark.createDataFrame([(i, f"u{i}", p, "text") for i, p in enumerate(pages)], "page_id long, url string, html string, text string")
    rows = {r.page_id: r for r in extract_pages(df).collect()}
    assert [rows[i].text for i in (0, 1, 6, 7)] == [""] * 4 and rows[9].text == main_text(PAGE) and len(rows) == len(pages)
    assert all(r.n_chars == len(r.text) for r in rows.values())
    assert extract_pages(df.where("false")).collect() == []


def test_html_without_an_article():
    text = "<div><p>" + "word " * 60 + "</p><p>" + "more " * 45 + "</p></div>"
    links = "<ul>" + "".join(f"<li><a href={i}>Link {i}</a></li>" for i in range(9)) + "</ul>"
    assert main_text(f"<body>{links}{text}{links}</body>") == ("word " * 60).strip() + "\n" + ("more " * 45).strip()


def test_tree_fits_its_table():
    rows, labels = np.array([[0, 0], [0, 1], [1, 0], [1, 1.0]]), np.array([0, 1, 1, 1])
    tree = grow_tree(rows, labels)
    assert tree.feature is not None and TREE.feature is not None


def test_every_language_has_its_reference(spark, monkeypatch):
    from arealens.llm import divergence

    rows = []
    for k in range(300):
        words = " ".join(f"q{k}x{j % 40}" for j in range(120))
        rows += [(2 * k, words, f"l{k}", "a"), (2 * k + 1, words.replace("x", "y", 5), f"l{k}", "b")]
    rows += [(900, rows[0][1], "l299", "c"), (901, rows[0][1], None, "d"), (902, None, "new", "e"), (903, "", None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, reference string")
    refs = fit_references(docs)
    assert refs.rest is None
    want = sorted(map(tuple, measure_quality(docs, refs).collect()))
    monkeypatch.setattr(divergence, "LANGUAGES", 3)
    few = fit_references(docs)
    assert few.rest.count() == len({r[2] or "" for r in rows}) - 3
    assert sorted(map(tuple, measure_quality(docs, few).collect())) == want
    kept = keep_usual(docs, few)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in want if r[7]]
    distance = {r[0]: r[9] for r in want}
    assert distance[900] > 0.5 > 0.2 > distance[0]


def test_long_words_are_read_to_their_end():
    import numpy as np

    from arealens.llm.toxicity import Network, cut_long_words
    from arealens.llm.words import split_words

    def cut(*texts):
        data = [t.encode() for t in texts]
        words = split_words(np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data])), lower=True)
        return words, cut_long_words(words)

    plain, same = cut("one two", "", "three " + "x" * 64)
    assert same is plain
    before, after = cut("one " + "字" * 60 + " two", "", "x" * 500)
    assert after.first.tolist() == [0, 6, 6, 17] and before.first.tolist() == [0, 3, 3, 4]
    assert (after.ends - after.starts).max() <= 64 and after.ends[4] == before.ends[1] and after.starts[1] == before.starts[1]
    assert (after.starts[2:5] < after.ends[1:4]).all()
    import pyarrow as pa

    net = Network()
    a, b = net.score_texts(pa.array(["字" * 30 + "好人", "字" * 30 + "坏蛋"]))
    assert a != b
