"""Corpus operators against brute force, exact round trips and held-out labels, with odd rows."""

from __future__ import annotations

import base64
import collections
import hashlib
import html
import math
import os
import re
import textwrap
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from countertide.llm import (
    QUERIES,
    SQL,
    components,
    cotraining,
    decontaminate,
    host_quality,
    html_text,
    jaccard_join,
    licence_texts,
    licences,
    private_terms,
    sentencepiece_bpe,
    trie_counts,
    warc_zstd,
)
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, row string, ids string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i}" for i in range(30_000))
ODD = [None, "", " \n\t ", "one", "one two", "a b c \x1f d", "é\U0001f600ß ▁▁ x\r\ny", "  two  spaces   here ", "A b c D e f g a B c d", LONG]


def rows_of(texts, first=0):
    return [(first + k, t, "en", "h" if k % 3 else None, None if t is None else len(t), "clash", "clash", "clash") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = rows_of(ODD)
    return spark.createDataFrame([*rows, rows[4], rows[8]], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def given(spark):
    return {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "pages", "benchmark", "labels")}


def repeats(text):
    w = WORD.findall(text or "")
    n = collections.Counter(zip(w, w[1:], w[2:]))
    return len({i + j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in range(3)})


def test_host_quality_equals_sql(spark):
    class Q:
        sql = SQL["op2_host_quality"]

        def __call__(self, s, d):
            return QUERIES["op2_host_quality"](s, d)

    assert compare(spark, connect(FOLDER), FOLDER, Q())[0].startswith("ok")


def test_measures_of_odd_texts(odd, empty):
    got = host_quality.measure(odd).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        words = WORD.findall(r.text or "")
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), repeats(r.text))
    assert {r.doc_id for r in host_quality.keep_good(odd).collect()} == {len(ODD) - 1}
    assert host_quality.keep_good(odd).columns == odd.columns
    assert host_quality.keep_good(empty).count() == 0


def test_hosts_are_shrunk(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}$$$" for i in range(60))
    docs = [(i, good, "good") for i in range(40)] + [(100 + i, bad, "bad") for i in range(40)] + [(200, bad, "single")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    hosts = {r.host: r for r in host_quality.host_verdicts(host_quality.measure(frame), host_quality.Limits()).collect()}
    assert hosts["bad"].rate_any > hosts["single"].rate_any > hosts["good"].rate_any
    assert hosts["bad"].blocked and not hosts["good"].strict


def test_sentencepiece_equals_the_library(odd, empty, given):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = sentencepiece_bpe.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for frame in (odd, given["documents"].select("doc_id", "text")):
        texts = collections.defaultdict(set)
        for r in frame.collect():
            texts[r.doc_id].add(r.text)
        for r in sentencepiece_bpe.digests(frame, path).collect():
            (text,) = texts[r.doc_id]
            ids = library.encode(text or "", add_eos=True)
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    whole = sentencepiece_bpe.encode(odd, path)
    assert whole.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "row", "ids", "decoded"]
    for r in whole.filter("doc_id > 0").collect():
        assert r.ids == library.encode(ODD[r.doc_id], add_eos=True) and r.decoded == library.decode(r.ids)
    assert sentencepiece_bpe.encode(empty, path).count() == 0


def test_merges_of_hard_words_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    path = sentencepiece_bpe.default_model()
    library, codec = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_bpe.Codec(sentencepiece_bpe.load_model(path))
    rng = np.random.default_rng(5)
    texts = ["a" * 500, "ab" * 300, " " * 37, "=" * 65, "日本語" * 20, "\x00x", "\n\n a\n"]
    texts += ["".join(rng.choice(list("aeinorst lhe.\n-"), 60)) for _ in range(300)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids == library.encode(text, add_eos=True), text
        assert codec.decode(ids) == library.decode(ids)


def brute_spans(text):
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and private_terms.luhn(digits(m))]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_the_patterns(given):
    rng = np.random.default_rng(3)
    texts = [r.text for r in given["documents"].select("text").collect()]
    texts += ["".join(rng.choice(list("ab@..1290 +-()%é"), 80)) for _ in range(4000)]
    texts += ["a@b@c.d.e@f.g", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111", "x" * 50_000, "1" * 50_000, "@" * 50_000]
    for t in texts:
        assert private_terms.base_spans(t or "") == brute_spans(t), t


def test_disclosing_terms_are_cleaned(spark, odd, empty):
    fill = [f"filler{i}x" for i in range(200)]
    rng = np.random.default_rng(1)
    texts = []
    for k in range(60):
        words = list(rng.choice(fill, 30))
        if k < 6:
            words[10:12] = ["ask", "Zebulon", "jo@mail.example.com"]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(rows_of(texts + [texts[50] + " only@once.example.com unique"] * 5), DOCS)
    clean = {r.doc_id: r for r in private_terms.sanitise(docs).collect()}
    assert len(clean) == 65 and private_terms.sanitise(docs).columns == docs.columns
    assert all("Zebulon" not in clean[k].text and "[EMAIL]" in clean[k].text for k in range(6))
    assert clean[10].text == texts[10] and clean[62].text.endswith("[EMAIL] unique")  # five copies are one context
    assert [r.text for r in private_terms.sanitise(odd).orderBy("doc_id").collect()] == [r.text for r in odd.orderBy("doc_id").collect()]
    assert private_terms.sanitise(empty).count() == 0 and private_terms.sanitise_spans(empty).count() == 0


def test_terms_in_copied_texts_are_cleaned(spark):
    fill, rng, texts = [f"filler{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)], np.random.default_rng(10), []
    for k in range(60):
        words = list(rng.choice(fill, 30))
        if k < 3:  # stands without the entity nowhere
            words[10:12] = ["ask", "Zebulon", "jo@mail.example.com"]
        if k < 12:  # stands without it mostly
            words[14] = "Ordinary"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(rows_of([*texts[:3] * 10, *texts[3:], *texts[20:30] * 4]), DOCS)
    clean = [r.text for r in private_terms.sanitise(docs).collect()]
    assert sum("[...] [EMAIL]" in t for t in clean) == 30 and not any("Zebulon" in t for t in clean)
    assert sum("Ordinary" in t for t in clean) == 39
    once = spark.createDataFrame(rows_of(texts), DOCS)
    assert {r.text for r in private_terms.sanitise(once).collect()} == set(clean)


def test_benchmark_passages_are_found(spark, given, odd, empty):
    items = {r.item_id: r.text for r in given["benchmark"].collect()}
    rng = np.random.default_rng(2)
    words = WORD.findall(" ".join(r.text or "" for r in given["documents"].limit(60).collect()))
    texts, truth = [], {}
    for k, (i, t) in enumerate(items.items()):
        around = [" ".join(rng.choice(words, n)) for n in (k % 37, 5 + k % 11)]
        texts.append(around[0] + " " + (re.sub("[a-z]+", lambda m: m[0].upper(), t) if k % 2 else t) + "\n" + around[1])
        truth[k] = i
    texts += [" ".join(rng.choice(words, 300)) for _ in range(50)]
    found = decontaminate.contamination(spark.createDataFrame(rows_of(texts), DOCS), given["benchmark"]).collect()
    assert {r.doc_id: r.item_id for r in found} == truth
    kept = decontaminate.decontaminate(spark.createDataFrame(rows_of(texts), DOCS), given["benchmark"])
    assert {r.doc_id for r in kept.collect()} == set(range(len(items), len(texts)))
    assert decontaminate.decontaminate(odd, given["benchmark"]).count() == odd.count()
    assert decontaminate.contamination(empty, given["benchmark"]).count() == 0
    assert decontaminate.contamination(odd, given["benchmark"].limit(0)).count() == 0


def test_exact_copies_of_short_items_are_found():
    rng = np.random.default_rng(8)
    items = [(k, " ".join(f"s{x}" for x in rng.integers(0, 10**6, 1 + k % 20))) for k in range(800)]
    index = decontaminate.Index(items, decontaminate.Matching())
    around = [[" ".join(f"r{x}" for x in rng.integers(0, 10**6, n)) for n in rng.integers(0, 12, 2)] for _ in items]
    found = decontaminate.matches(pa.array([f"{a} {t} {b}" for (_, t), (a, b) in zip(items, around)]), index)
    assert {(t, i) for t, i, s, _ in found if s == 1.0} >= {(k, k) for k, _ in items}


def test_passages_with_changed_words_are_found():
    rng = np.random.default_rng(9)
    word = lambda n: [f"c{x}" for x in rng.integers(10**5, 10**6, n)]
    items = [word(n) for n in (9, 13, 16, 20, 31, 49, 52, 54, 56, 75, 109, 160, 230)]
    index, places = decontaminate.Index([(k, " ".join(w)) for k, w in enumerate(items)], decontaminate.Matching()), []
    for k, w in enumerate(items):
        for at in range(len(w)):
            places += [(k, w[:at] + word(1) + w[at + 1 :]), (k, w[:at] + word(1) + w[at:]), (k, w[:at] + w[at + 1 :])]
        for _ in range(60):  # two changes
            a, b = sorted(rng.integers(0, len(w), 2).tolist())
            places.append((k, w[:a] + word(1) + w[a + 1 : b] + word(1) + w[b + 1 :]))
    texts = [" ".join(word(k % 9) + w + word(k % 7)) for k, (_, w) in enumerate(places)]
    found = {(t, i) for t, i, _, _ in decontaminate.matches(pa.array(texts), index)}

    def told(text):
        w = decontaminate.Words(pa.array([text]))
        return w.hash, w.end - w.start

    want = {(t, k) for t, (k, _) in enumerate(places) if decontaminate.best_similarity(told(" ".join(items[k])), told(texts[t]), 5) >= 0.8}
    assert len(want) > 1500 and want <= found


def test_hamming_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(4)
    index = decontaminate.Index([(k, " ".join(f"t{x}" for x in rng.integers(0, 10**6, 40))) for k in range(200)], decontaminate.Matching())
    ((size, (own, _, _, _)),) = index.by_size.items()
    near = own[rng.integers(0, len(own), 3000)].copy()
    for k in range(5):
        near ^= np.where(rng.random(len(near)) < 0.6, np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64), np.uint64(0))
    window, other = index.candidates(near, size)
    brute = np.argwhere(np.bitwise_count(near[:, None] ^ own[None, :]) <= 3)
    assert set(zip(window.tolist(), other.tolist())) == set(map(tuple, brute.tolist()))


def brute_components(docs, k, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in docs:
        w = WORD.findall((t or "").translate(low))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i in sorted(sets):
        shared = collections.Counter(j for x in sets[i] for j in holders[x])
        for j, c in shared.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in sets[i]:
            holders[x].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_join_equals_brute_force(spark, given, k, percent):
    rng = np.random.default_rng(7)
    docs = [(r.doc_id, r.text) for r in given["documents"].select("doc_id", "text").collect()]
    base = [f"v{i}" for i in range(120)]
    for n in range(150):  # near copies of one text, and short texts, where subsets are listed
        w = list(base)
        for at in rng.integers(0, 120, n % 5):
            w[at] = f"x{rng.integers(0, 9)}"
        docs.append((10_000 + n, " ".join(w)))
        docs.append((20_000 + n, " ".join(base[: 8 + n % 25] + [f"y{n % 3}"])))
    docs += [(30_000 + j, t) for j, t in enumerate(ODD)]
    frame = spark.createDataFrame([*docs, docs[-1]], "doc_id bigint, text string")
    rule = jaccard_join.Similarity(k, percent)
    want = brute_components(docs, k, percent)
    got = jaccard_join.join_classes(frame, rule).collect()
    assert len(got) == len(docs) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    kept = jaccard_join.keep_one(frame, rule).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, (_, c) in want.items() if c == i)


def test_repeated_and_missing_ids_link_by_any_of_their_texts(spark):
    """Each row is a node of its own by brute force; rows of one id are tied, and the least id names a component."""
    rng = np.random.default_rng(23)
    near = lambda b: " ".join(f"b{b}w{i}" if i != at else f"x{rng.integers(0, 99)}" for at in [rng.integers(0, 60)] for i in range(60))
    rows = [(5, near(1)), (5, near(2)), (9, near(2)), (9, near(3)), (3, near(3)), (None, near(4)), (None, near(4)), (8, near(4)), (None, near(5))]
    copy = near(6)
    rows += [(1, copy), (9, copy), (20, near(7)), (20, None), (None, ""), (21, near(7)), (None, near(5)), (20, near(7))]
    want = brute_components([(n, t) for n, (_, t) in enumerate(rows)], 3, 80)
    group = {n: want[n][1] for n in want}
    for i in {i for i, _ in rows if i is not None}:
        tied = {group[n] for n, r in enumerate(rows) if r[0] == i}
        group = {n: min(tied) if c in tied else c for n, c in group.items()}
    least = {c: min((r[0] for n, r in enumerate(rows) if group[n] == c and r[0] is not None), default=None) for c in group.values()}
    expected = collections.Counter((r[0], want[n][0], least[group[n]]) for n, r in enumerate(rows))
    assert (9, 58, 1) in expected and (None, 58, 8) in expected and (None, 58, None) in expected
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = jaccard_join.join_classes(frame, jaccard_join.Similarity(3, 80)).collect()
    assert collections.Counter(map(tuple, got)) == expected


def test_near_copies_that_stay_apart_meet_in_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(11)
    base, docs = [f"v{i}" for i in range(200)], []
    for n in range(500):
        w = list(base)
        for at in np.random.default_rng(n % 60).integers(0, 200, n % 3):  # edits that some share
            w[at] = f"s{n % 60}"
        for at in rng.integers(0, 200, 2 + n % 5):  # edits of one's own
            w[at] = f"x{rng.integers(0, 10**9)}"
        docs.append((n, " ".join(w)))
    made = []
    real = jaccard_join._delta_pairs
    monkeypatch.setattr(jaccard_join, "_delta_pairs", lambda *a: made.append(real(*a)) or made[-1])
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_classes(frame, jaccard_join.Similarity(3, 90)).collect()}
    assert got == brute_components(docs, 3, 90)
    assert made and made[0].count() < 10 * len(docs)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_isolated_texts_and_their_extensions_link(spark, k, percent):
    rng, docs = np.random.default_rng(3), []
    for n in range(240):
        w = [f"p{n}w{i}" for i in range(60 + n)]
        more = [f"p{n}x{i}" for i in range(max(1, round(len(w) * (0.02 + 0.02 * (n % 6)))))]
        at = len(w) if n % 2 else int(rng.integers(0, len(w)))
        docs += [(2 * n + n % 2, " ".join(w)), (2 * n + 1 - n % 2, " ".join(w[:at] + more + w[at:]))]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute_components(docs, k, percent)
    assert 100 < sum(c != i for i, (_, c) in want.items()) <= 240
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_classes(frame, jaccard_join.Similarity(k, percent)).collect()}
    assert got == want


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for n, m, shared in [(1, 1, 0), (2, 900, 2), (40, 40, 40), (300, 310, 290), (5000, 70, 70), (700, 700, 0)]:
        both = rng.integers(0, 2**64, n + m - shared, dtype=np.uint64)
        x, y = both[:n], np.concatenate([both[:shared], both[n:]])
        a, b = (np.frombuffer(jaccard_join.parities(np.unique(s)), np.uint8) for s in (x, y))
        apart = len(np.setxor1d(x, y))
        assert jaccard_join.differing(a, b) == jaccard_join.differing(b, a) <= apart
        assert jaccard_join.differing(a, b) > 0.2 * apart or apart == 0 or n != m


def test_jaccard_join_of_nothing(empty, odd):
    assert jaccard_join.join_classes(empty).count() == 0
    assert jaccard_join.keep_one(empty).count() == 0
    assert jaccard_join.keep_one(odd).count() == len(ODD) and jaccard_join.keep_one(odd).columns == odd.columns


def test_archives_round_trip(spark, tmp_path):
    pages = [(k, f"http://h/{k} x\r\n", t) for k, t in enumerate(["a" * 9, None, "", "b\r\n\r\nc", "a" * 9, LONG, "é" * 3, "a" * 9])]
    pages += [(None, None, "n"), pages[3]]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    archives = warc_zstd.write_archives(warc_zstd.with_originals(frame))
    got = warc_zstd.read_archives(archives, with_payload=True).collect()
    assert len(got) == len(pages)
    for r in got:
        text = "n" if r.page_id is None else pages[r.page_id][2] or ""
        original = {"a" * 9: 7, "": 2}.get(text, r.page_id)
        data = text.encode()
        assert r.payload_bytes == len(data) and r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if original == r.page_id else ("revisit", original))
        assert r.payload == (data if r.record_type == "response" else None)
    files = warc_zstd.export_archives(archives, f"file://{tmp_path}/warc").collect()
    again = spark.read.format("binaryFile").load(f"{tmp_path}/warc")
    assert again.count() == len({f.path for f in files})
    assert warc_zstd.read_archives(again).count() == len(pages)
    none = warc_zstd.write_archives(warc_zstd.with_originals(frame.limit(0)))
    assert warc_zstd.read_archives(none).count() == 0


def test_broken_archives_are_refused():
    write = warc_zstd._archive_writer(iter([pa.RecordBatch.from_pydict({"page_id": [1, 2], "url": ["u", "v"], "html": ["x" * 50, "y"], "_refers_to": pa.nulls(2, pa.int64())})]))
    good = next(write).column("content")[0].as_py()
    assert len(list(warc_zstd.frames_of(good))) == 2
    for bad in (b"", good[4:], good[:-3], good + b"junk", good[:-1] + bytes([good[-1] ^ 1])):
        with pytest.raises(warc_zstd.BadArchive):
            list(warc_zstd.frames_of(bad))
    one = next(iter(warc_zstd.frames_of(good)))
    for old, new in ((b"Content-Length: ", b"Content-Length: 1"), (b"x" * 50, b"z" * 50), (b"WARC/1.1", b"WARC/9.9"), (b"WARC-Date", b"WARC Date")):
        with pytest.raises(warc_zstd.BadArchive):
            warc_zstd.parse_record(one.replace(old, new, 1))


def test_main_text_of_given_pages(given):
    for r in html_text.extract(given["pages"]).join(given["pages"].select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", p))).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_main_text_without_article_element(spark):
    prose = "This is the text of the page and it is long enough to be told from a menu by the words that are in it."
    page = f"""<html><head><title>T</title><style>p {{}}</style></head><body><div class="top-bar menu"><a href=/>Home</a> | <a href=/x>More</a></div>
    <h2>Short title</h2><p>{prose} &lt;b&gt; &amp; c</p><p>Yes.</p><p>{prose}</p><ul><li><a href=1>One link</a><li><a href=2>Another</a></ul>
    <form>{prose}</form><div id="comments"><p>{prose}</p></div><div class='cookie-notice'>{prose}</div><!-- {prose} --><script>"{prose}"</script>
    <footer><p>{prose}</p></footer></body>"""
    assert html_text.main_text(page) == f"Short title\n{prose} <b> & c\nYes.\n{prose}"
    pages = spark.createDataFrame([(1, None, None, "x"), (2, "u", "", "x"), (3, "u", "<p", "x"), (3, "u", "<p", "x")], "page_id bigint, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert [(r.text, r.n_chars) for r in got] == [("", 0)] * 4 and html_text.extract(pages).columns == ["page_id", "url", "text", "n_chars"]


BODY = [f"This is what the page has to say and it is told in plain words that are easy to read for all of us, part {k}." for k in range(4)]


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<div>{body}</div><article><h3>Next</h3><p>Short teaser</p></article>", "{text}"),
        ("<article><h3>Next</h3><p>Short teaser</p></article><div>{body}</div>", "{text}"),
        ("<article><h1>Head</h1></article><div>{body}</div>", "Head\n{text}"),
        ("<article>{body}</article><article><h3>Next</h3><p>Short teaser</p></article>", "{text}"),
        ("<article>{body}</article><p>Short end</p>", "{text}"),
        ("<div>{body}<p>Short end.</p></div>", "{text}\nShort end."),
        ("<div>{body}</div><ul><li><a href='/x'>All of the other pages</a></li></ul><p>Short end.</p>", "{text}"),
        ("<div class='social-history'>{body}</div>", "{text}"),
        ("<article><section class='legal_theory'>{body}</section></article>", "{text}"),
        ("<article>{body}<div class='social-links'>{body}</div><div class='related'>{body}</div></article>", "{text}"),
        ("<article>{body}<div class='share-it-now'><p>Tell your friends</p></div></article>", "{text}"),
        ("<div>Closed today.</div><div>Open on Monday.</div>", "Closed today.\nOpen on Monday."),
        ("<article><p>Kurz.</p></article><p>Anderes</p>", "Kurz."),
        ("<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul>", ""),
    ],
)
def test_main_text_by_block_rules(page, expected):
    body, text = "".join(f"<p>{b}</p>" for b in BODY), "\n".join(BODY)
    assert html_text.main_text("<html><body>" + page.replace("{body}", body) + "</body></html>") == expected.replace("{text}", text)


def test_main_text_of_odd_pages(spark):
    long = "<article>" + "".join(f"<p>{b}</p>" for b in BODY * 3000)
    rows = [(1, None, "x"), (2, "", "x"), (3, long, "x"), (3, long, "x"), (4, "<p>Cut off <a href='", "x"), (None, "<p", "x")]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_text.extract(frame).collect()
    assert sorted(len(r.text) for r in got) == sorted([0, 0, len("\n".join(BODY * 3000)), len("\n".join(BODY * 3000)), 7, 0])
    assert all(r.n_chars == len(r.text) for r in got) and html_text.extract(frame.limit(0)).count() == 0


def test_quality_of_labels_held_out(spark, given):
    docs = given["documents"].selectExpr("doc_id", "text", "source AS host", "lang AS language")
    labels = given["labels"]
    model = cotraining.train(docs, labels.filter("doc_id % 2 = 0"))
    told = cotraining.score(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in told) >= 0.9 * len(told)
    odd = spark.createDataFrame([(k, t, None, None) for k, t in enumerate(ODD)], "doc_id bigint, text string, host string, language string")
    assert cotraining.score(odd, model).filter("score BETWEEN 0 AND 1").count() == len(ODD)
    assert cotraining.score(odd.limit(0), cotraining.train(odd.limit(0), labels.limit(0))).count() == 0


def test_rounds_of_cotraining_equal_brute_force(spark):
    """What either view passes on, over all unlabelled vectors, against plain counting over sorted scores."""
    rng = np.random.default_rng(5)
    x = [rng.normal(size=(700, 6)).astype(np.float16), rng.normal(size=(700, 3)).astype(np.float16)]
    x = [np.concatenate([v, v[:1].repeat(350, 0), v[:20]]) for v in x]  # one vector holds a third of all rows
    views = [rng.normal(size=7), rng.normal(size=4)]
    rows = list(zip(*[[bytearray(r.tobytes()) for r in v] for v in x]))
    fresh = spark.createDataFrame(rows, "content binary, metadata binary").selectExpr("xxhash64(content, metadata) AS vector", "*").repartition(5)
    rule = cotraining.Training(exchanged=30, share=0.2)
    sure = cotraining._sure_rows(fresh, rule)
    gone = set()
    for turn in range(2):
        left = [k for k in range(700) if k not in gone]
        cell = [cotraining.cells(v, w) for v, w in zip(x, views)]
        says = []
        for c in cell:
            ordered = sorted(c[k] for k in left)
            low, high = ordered[math.ceil(0.2 * 0.6 * len(left)) - 1], ordered[-math.ceil(0.2 * 0.4 * len(left))]
            says.append({k: 1 if c[k] >= high else 0 for k in left if c[k] >= high or c[k] <= low})
        clash = {k for k in says[0] if says[1].get(k, says[0][k]) != says[0][k]}
        for view, (rows, told) in enumerate(sure(views, turn, 0.4)):
            got = [next(k for k in left if (x[0][k] == r).all()) for r in rows[0]]
            assert len(set(got)) == len(got) == 30 and told.sum() == 12 and not clash & set(got)
            assert all(says[view][k] == t for k, t in zip(got, told)) and all((x[1][k] == r).all() for k, r in zip(got, rows[1]))
            gone |= set(got)


def test_cotraining_of_odd_rows(spark, given):
    docs = given["documents"].selectExpr("doc_id", "text", "source AS host", "lang AS language")
    clash = "'a' AS Score", "'b' AS p_content", "'c' AS kept", "1 AS row", "2 AS vector", "3 AS told", "'d' AS content"
    odd = spark.createDataFrame([(None, "a text of no id", None, None), (3, None, "h", None), (3, LONG, "h", "en"), (3, LONG, "h", "en")], "doc_id long, text string, host string, language string")
    both = docs.unionByName(odd).unionByName(docs.limit(5)).selectExpr("*", *clash)
    labels = given["labels"].select("doc_id", "quality").unionAll(spark.createDataFrame([(None, 1), (3, None), (3, 1), (3, 1), (10**9, 0)], "doc_id long, quality long"))
    got = cotraining.score(both, cotraining.train(both, labels))
    assert got.columns == ["doc_id", "row", "vector", "told", "content", "p_content", "p_metadata", "score", "kept"]
    rows = got.collect()
    assert len(rows) == both.count() and all(0 <= r.score <= 1 and r.row == 1 and r.content == "d" for r in rows)
    one = cotraining.train(both, labels.filter("quality = 1"))
    assert cotraining.score(odd, one).filter("score > 0.99").count() == 4


def test_trie_counts_equal_unigram_library(odd, empty):
    tokenizers = pytest.importorskip("tokenizers")
    vocabulary = trie_counts.zipf_vocabulary(trie_counts.default_model())
    model = sentencepiece_bpe.load_model(trie_counts.default_model())
    names = [p for p, k in zip(model.pieces, model.kinds) if k == sentencepiece_bpe.NORMAL]
    scores = -np.log(np.arange(len(names)) + 3.0)
    scores -= np.log(np.exp(scores).sum())
    library = tokenizers.Tokenizer(tokenizers.models.Unigram([("<unk>", 0.0), *zip(names, scores.tolist())], unk_id=0))
    rng = np.random.default_rng(6)
    words = sorted({"▁" * (k % 2) + "".join(rng.choice(list("etaoinshrdlu"), 1 + k % 50)) for k in range(600)})
    counts = trie_counts.trie_counts(words, vocabulary)
    for w, c in zip(words, counts):
        assert c == len(library.encode(w).ids) == trie_counts.plain_count(w, vocabulary), w
    got = trie_counts.count_tokens(odd, vocabulary).collect()
    assert len(got) == len(ODD) + 2 and {r.n_tokens for r in got if r.doc_id < 2} == {0}
    assert trie_counts.count_tokens(empty, vocabulary).count() == 0


def test_licences_and_inheritance(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [("r/a/LICENSE", mit), ("r/a/b/code", "x\n" * 50), ("r/LICENSE", gpl), ("r/c/code", "plain words here"), ("q/x", "nothing"), (None, mit), ("r/a/d", "long text " * 40 + "\n" + gpl), ("r/e", None)]
    frame = spark.createDataFrame(files, "path string, text string")
    got = {r.path: r for r in licences.inherit(licences.own_licences(frame)).collect()}
    assert got["r/a/LICENSE"].licence == "MIT" and got["r/a/LICENSE"].is_file
    assert (got["r/a/b/code"].effective, got["r/a/b/code"].inherited_from) == ("MIT", "r/a")
    assert got["r/c/code"].effective == got["r/e"].effective == "GPL-3.0" and got["q/x"].effective is None
    assert got["r/a/d"].licence == "GPL-3.0" and not got["r/a/d"].is_file and got[None].licence == "MIT"
    assert licences.inherit(licences.own_licences(frame.limit(0))).count() == 0


def test_licences_equal_sql(spark):
    class Query:
        sql = SQL["op8_licences"]

        def __call__(self, spark, folder):
            return QUERIES["op8_licences"](spark, folder)

    state, rows, _ = compare(spark, connect(FOLDER), FOLDER, Query())
    assert state == "ok" and rows


def test_whole_licence_texts_are_licence_files(spark):
    rows = [(name, f"Copyright (c) 2021 Some Body\n\n{textwrap.fill(text, 60)}", True) for name, text in licence_texts.LICENCE_TEXTS]
    story = "It was a bright cold day in April and the clocks were striking thirteen as they went home. " * 60
    rows += [("MPL-2.0", story + "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. " + story, False)]
    wrapped = textwrap.fill(dict((n, t) for n, t in licences.NOTICES if n == "Apache-2.0" and len(t) > 90)["Apache-2.0"], 30)
    rows += [("Apache-2.0", story + "\n" + wrapped + "\n" + story, False), (None, story, False), (None, "license " + story, False)]
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id long, expected string, text string, expected_file boolean")
    for r in licences.own_licences(frame).collect():
        assert (r.licence, r.is_file) == (r.expected, r.expected_file), r


def test_licences_of_odd_rows(spark):
    """Ties in a directory, columns that clash with results and internal names, repeated rows, nulls, very long texts."""
    mit, apache = "SPDX-License-Identifier: MIT", "SPDX-License-Identifier: Apache-2.0"
    rows = [("r/A", apache), ("r/B", mit), ("r/B", mit), ("r/c", "x"), ("r/c", "x"), ("r/d", None), (None, None), ("e", ""), ("z/long", "word " * 200_000 + "\n" + mit)]
    schema = "path string, text string, licence string, Similarity string, key int, row int, dir string, up string, effective int"
    frame = spark.createDataFrame([(*r, "mine", "mine", 5, 6, "mine", "mine", 7) for r in rows], schema)
    got = licences.inherit(licences.own_licences(frame))
    assert sorted(got.columns) == sorted(["path", "key", "row", "dir", "up", "licence", "similarity", "is_file", "effective", "inherited_from"])
    told = {r.path: r for r in got.collect()}
    assert got.count() == len(rows) and told["r/A"].similarity == told["r/B"].similarity == 1.0
    assert told["r/c"].effective == told["r/d"].effective == "Apache-2.0" and told["r/c"].inherited_from == "r"
    assert told[None].effective is None and told["e"].effective is None and (told["r/c"].key, told["r/c"].dir) == (5, "mine")
    assert told["z/long"].licence == "MIT" and not told["z/long"].is_file


def test_pipeline_stages(spark, given):
    import corpus_pipeline

    docs = given["documents"]
    sets = brute_components([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    items = [r.text for r in given["benchmark"].collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == given["documents"].columns
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "decontamination":
            assert before - after == {i for i in before if any(t in rows[i] for t in items)}
        if name == "near_duplicates":
            assert len(after) == len({c for i, (_, c) in brute_components([(i, rows[i]) for i in before], 5, 80).items()}) and sets
        if name == "personal_data":
            assert before == after
            assert not any(brute_spans(r.text) for r in docs.select("text").collect())
    assert corpus_pipeline.token_ids(spark, docs, FOLDER).filter("size(ids) != n_tokens").count() == 0


def test_only_crowded_lists_are_told_as_differences(spark, monkeypatch):
    """Documents that share a key with few others are compared as they are; members of long lists alone have anchors."""
    rng = np.random.default_rng(12)

    def edited(name, places):
        words = [f"{name}v{i}" for i in range(200)]
        for at in rng.choice(200, places, replace=False):
            words[at] = f"x{rng.integers(0, 10**9)}"
        return " ".join(words)

    docs = [(n, edited("base", 4)) for n in range(60)]  # long lists
    docs += [(100 + n, edited(f"own{n // 2}", 3)) for n in range(80)]  # lists of two
    seen = []
    real = jaccard_join._deltas
    monkeypatch.setattr(jaccard_join, "_deltas", lambda members, *a: seen.extend(r.doc_id for r in members.select("doc_id").distinct().collect()) or real(members, *a))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_classes(frame, jaccard_join.Similarity(3, 90)).collect()}
    assert got == brute_components(docs, 3, 90)
    assert seen and max(seen) < 100


def test_few_links_meet_in_one_partition(spark, monkeypatch):
    rng = np.random.default_rng(13)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(n, n + 1) for n in range(1000, 1040)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    plans = []
    real = components.freeze
    monkeypatch.setattr(components, "freeze", lambda df, label: plans.append((label, df._jdf.queryExecution().executedPlan().toString())) or real(df, label))
    few = {(r.node, r.component) for r in components.components(frame).collect()}
    assert all("hashpartitioning" not in plan for label, plan in plans if label == "large") and len(plans) > 1
    monkeypatch.setattr(components, "BROADCAST_ROWS", 0)
    assert few == {(r.node, r.component) for r in components.components(frame).collect()}


def test_texts_are_worked_on_in_bounded_memory(spark, given):
    """A batch of 8 MB of text, and what is counted of it, stays far below what its words' signs and hashes would take at once."""
    rng = np.random.default_rng(14)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**5, 10_000)) for _ in range(120)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["_id", "_text"])
    items = [(r.item_id, r.text) for r in given["benchmark"].select("item_id", "text").collect()]
    shared = type("Shared", (), {"value": decontaminate.Index(items, decontaminate.Matching())})
    tracemalloc.start()
    try:
        assert sum(part.num_rows for part in decontaminate._cleaner([shared], "_text")([batch])) == len(texts)
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()


def test_pipeline_hands_texts_over_in_short_batches(spark, given):
    import corpus_pipeline

    before = spark.conf.get(corpus_pipeline.ARROW_ROWS_KEY)
    frame = spark.range(0, 10_000, 1, 1)

    def longest():
        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["rows"])

        return max(r.rows for r in frame.mapInArrow(sizes, "rows bigint").collect())

    try:
        for name, stage in corpus_pipeline.STAGES[1:]:
            spark.conf.set(corpus_pipeline.ARROW_ROWS_KEY, "10000")
            stage(spark, given["documents"].limit(5), FOLDER)
            assert longest() <= corpus_pipeline.ARROW_ROWS, name
    finally:
        spark.conf.set(corpus_pipeline.ARROW_ROWS_KEY, before)
