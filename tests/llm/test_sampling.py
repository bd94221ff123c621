"""Importance resampling, whitening and packing against plain versions, with odd rows."""

from __future__ import annotations

import collections
import hashlib
import json
import math
import os
import re
import zlib

import numpy as np
import pytest
from hypothesis import given as any_of
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from countertide.llm import QUERIES, SQL, importance, packing, whitening
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, _id string, score string, rank string, length string, _text string, piece string, ids string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ODD = [None, "", " \n\t ", "one", "A-b C3 é漢字 x", "x" * 5000 + " y " + "x" * 5000, "ab ab ab " * 30, LONG, "\x00 a\x00b", "Ünï Çode <|endoftext|> end"]


class Registered:
    def __init__(self, name):
        self.name, self.sql = name, SQL.get(name)

    def __call__(self, spark, folder):
        return QUERIES[self.name](spark, folder)


def rows_of(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return [(k, t, *["clash"] * 7) for k, t in zip(ids, texts)]


@pytest.fixture(scope="module")
def odd(spark):
    texts = [*ODD, ODD[6], ODD[6], "tie one two", *["many words " * 12] * 3]
    ids = [*range(len(ODD)), 6, None, None, 50, 51, 52]
    return spark.createDataFrame(rows_of(texts, ids), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- importance resampling


def plain_features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return w, [zlib.crc32(f.encode()) % importance.BUCKETS for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


def plain_resampling(docs, target, percent=25, min_words=20):
    s, t = collections.Counter(), collections.Counter()
    for text in docs:
        s.update(plain_features(text[1])[1])
    for text in target:
        t.update(plain_features(text)[1])
    n_s, n_t, width = sum(s.values()), sum(t.values()), importance.BUCKETS
    out = []
    for key, text in docs:
        words, buckets = plain_features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + width) / ((s[b] + 1) * (n_t + width)))) for b in buckets]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([key, len(words), len(buckets), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = place + 1
    return sorted(map(tuple, out), key=repr)


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_importance_equals_sql(spark):
    verdict, rows, _ = compare(spark, connect(FOLDER), FOLDER, Registered("op11_importance"))
    assert verdict.startswith("ok") and rows


@pytest.mark.parametrize("percent, least", [(25, 20), (100, 1), (60, 0)])
def test_importance_equals_plain_version_on_odd_rows(spark, odd, percent, least):
    target = ["one two Words", None, "", "é漢字 x many words"]
    frame = spark.createDataFrame([(t, "x") for t in target], "text string, doc_id string")
    got = importance.ranked(odd, frame, percent=percent, min_words=least).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert collected(got) == plain_resampling(docs, target, percent, least)


def test_importance_of_empty_tables(spark, odd, empty):
    none = spark.createDataFrame([], "text string")
    assert importance.ranked(empty, none).count() == 0
    assert importance.ranked(odd, none).count() == odd.count()


def test_resample_keeps_whole_rows(spark, odd):
    target = spark.createDataFrame([("many words",)], "text string")
    drawn = importance.resample(odd, target, percent=50)
    ranks = importance.ranked(odd, target, percent=50).filter("rank IS NOT NULL")
    assert drawn.columns == odd.columns
    assert {r[0] for r in drawn.select("doc_id").collect()} == {r[0] for r in ranks.select("doc_id").collect()}


@pytest.mark.parametrize("digit_bits", [3, 12])
def test_radix_ranks_hot_scores_and_wide_ids(spark, digit_bits):
    r = np.random.default_rng(5)
    ids = [None, *map(int, r.choice(2**40, 400, replace=False) - 2**39)]
    scores = [int(s) for s in np.where(r.random(len(ids)) < 0.4, 17, r.integers(-3000, 9000, len(ids)))]
    rows = spark.createDataFrame([(a, b, k) for k, (a, b) in enumerate(zip(ids, scores))], "doc_id bigint, score bigint, _place bigint")
    got = [x[0] for x in importance.radix_ranks(rows, "doc_id", digit_bits).orderBy("rank").select("doc_id").collect()]
    assert got == [k for _, _, k in sorted((-s, (k is None, k or 0), k) for k, s in zip(ids, scores))]


def test_radix_passes_keep_no_class_in_one_task(spark):
    """The sort's only global window is over digit totals; rows are dealt by digit and block."""
    rows = spark.createDataFrame([(k, 5, k) for k in range(100)], "doc_id bigint, score bigint, _place bigint")
    placed = importance.places_in_class(rows, rows["score"], "_place", 3, "_own")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "_kind" in plan and "_block" in plan
    assert sorted(r["_own"] for r in placed.collect()) == list(range(100))


# --- whitening


def plain_whitening(vectors, components=16):
    good = [(k, v) for k, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    values, basis = np.linalg.eigh(c.T @ c / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    trace = (c * c).sum() / n
    with np.errstate(all="ignore"):
        return [k for k, _ in good], n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ basis / np.sqrt(values), values / trace


def check_whitening(got, vectors):
    ids, n, deviation, whitened, explained = plain_whitening(vectors)
    k = whitened.shape[1]
    rows = collections.defaultdict(list)
    for r in got.collect():
        rows[r["vec_id"]].append(r)
    assert collections.Counter(ids) == {i: len(v) // k for i, v in rows.items()}
    sign = {}
    for at, i in enumerate(ids):
        for r in rows[i]:
            j = r["component"] - 1
            assert r["n"] == n and r["identity_error"] < 1e-9
            assert abs(r["explained"] - explained[j]) <= 1e-9 * explained[j]
            if list(ids).count(i) == 1:
                assert r["deviation"] == deviation[at]
                if abs(whitened[at, j]) > 1e-3:
                    sign.setdefault(j, np.sign(whitened[at, j] * r["whitened"]))
                assert abs(r["whitened"] * sign.get(j, 1.0) - whitened[at, j]) < 1e-6


def test_whitening_equals_eigh(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    check_whitening(QUERIES["op12_whitening"](spark, FOLDER), [(r["vec_id"], r["embedding"]) for r in table.collect()])


VECTORS = "vec_id bigint, embedding array<float>, whitened string, _v string, n string, component string"


def vectors_of(spark, vectors):
    return spark.createDataFrame([(k, v, *["clash"] * 4) for k, v in vectors], VECTORS)


def test_whitening_of_odd_rows(spark):
    r = np.random.default_rng(2)
    base = [[float(np.float32(c)) for c in v] for v in r.standard_normal((40, 3))]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None, 2.0], [nan, 0.0, 0.0], [inf, 0.0, 0.0], [-inf, 0.0, 0.0], [1e30, 0.0, 0.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]
    vectors = [*enumerate(base), *((100 + k, v) for k, v in enumerate(odd)), (7, base[7]), (200, base[8]), (201, base[8]), (None, base[9])]
    got = whitening.whiten(vectors_of(spark, vectors))
    kept = [(k, v) for k, v in vectors if v and len(v) == 3 and 1e30 not in v]
    check_whitening(got, kept)
    assert got.first()["n"] == 40


def test_whitening_without_variance_and_without_rows(spark):
    same = whitening.whiten(vectors_of(spark, [(k, [1.0, 2.0]) for k in range(3)])).collect()
    assert len(same) == 6 and all(r["whitened"] is None and r["identity_error"] is None and r["n"] == 1 and r["deviation"] == 0 for r in same)
    line = whitening.whiten(vectors_of(spark, [(k, [float(k), 1.0]) for k in range(5)])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    assert whitening.whiten(vectors_of(spark, [])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, None)])).count() == 0


def test_deviations_beyond_machine_numbers():
    m = whitening.Whitening(3, np.array([2**61, 0]), np.eye(2), np.ones(2), 2.0)
    assert m.deviations(np.array([[2**61, 0]])) == [None]
    m = whitening.Whitening(3, np.array([2**40, 5]), np.eye(2), np.ones(2), 2.0)
    assert m.deviations(np.array([[2**39, 1]])) == [None] and m.deviations(np.array([[2**40 // 3, 1]])) == [(3 * (2**40 // 3) - 2**40) ** 2 + 4]


@any_of(st.integers(1, 12), st.integers(0, 2**32 - 1), st.sampled_from(["plain", "copies", "falling", "rank"]))
@settings(max_examples=60, deadline=None)
def test_spectral_divide_equals_eigh(d, seed, kind):
    r = np.random.default_rng(seed)
    q, _ = np.linalg.qr(r.standard_normal((d, d)))
    values = {"plain": r.random(d), "copies": r.integers(0, 3, d).astype(float), "falling": 4.0 ** -np.arange(d), "rank": (np.arange(d) < d // 2) * 1.0}[kind]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    v = whitening.spectral_divide(a)
    scale = max(np.abs(values).max(), 1e-300)
    assert np.abs(v.T @ v - np.eye(d)).max() < 1e-13
    inner = v.T @ a @ v
    assert np.abs(inner - np.diag(np.diag(inner))).max() < 1e-13 * scale
    assert np.abs(np.sort(np.diag(inner)) - np.sort(values)).max() < 1e-13 * scale


# --- packing


def plain_pieces(docs, capacity=packing.CAPACITY):
    t = Tokenizer.from_file(packing.default_tokenizer())
    out = []
    for key, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((key, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=repr)


def check_packing(got, docs, capacity=packing.CAPACITY):
    rows = got.collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=repr) == plain_pieces(docs, capacity)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def best_fit_decreasing(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        fitting = [g for g in gaps if g >= s]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else capacity) - s)
    return len(gaps)


def test_packing_of_given_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    used = check_packing(QUERIES["op13_best_fit"](spark, FOLDER), docs)
    assert used <= best_fit_decreasing([p[3] for p in plain_pieces(docs)], packing.CAPACITY)


@pytest.mark.parametrize("capacity", [3, 64, 2048])
def test_packing_of_odd_rows(spark, odd, empty, capacity):
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    check_packing(packing.pack(odd, packing.default_tokenizer(), capacity=capacity), docs, capacity)
    assert packing.pack(empty, packing.default_tokenizer(), capacity=capacity).count() == 0


def test_sequences_hold_the_tokens(spark, odd):
    made = packing.sequences(odd, packing.default_tokenizer(), capacity=128).collect()
    t = Tokenizer.from_file(packing.default_tokenizer())
    tokens = collections.Counter()
    for (text,) in odd.select("text").collect():
        tokens.update([*t.encode(text or "", add_special_tokens=False).ids, 0])
    assert collections.Counter(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in made]).tolist()) == tokens
    assert all(len(r["ids"]) <= 4 * 128 for r in made)


@any_of(st.dictionaries(st.integers(1, 30), st.integers(0, 12), max_size=20), st.integers(30, 64))
@settings(max_examples=150, deadline=None)
def test_plan_places_all_and_needs_no_more_than_best_fit(counts, capacity):
    plan = packing.Plan(counts, capacity)
    bins = collections.defaultdict(list)
    for size, n in counts.items():
        for q, o in zip(*plan.find(np.full(n, size), np.arange(n))):
            bins[int(q)].append((int(o), size))
    assert sorted(bins) == list(range(plan.sequences))
    for parts in bins.values():
        assert sum(3 * s > capacity for _, s in parts) <= 2
        assert all(b[0] == a[0] + a[1] for a, b in zip(sorted(parts), sorted(parts)[1:])) and sum(s for _, s in parts) <= capacity
    assert plan.sequences <= best_fit_decreasing([s for s, n in counts.items() for _ in range(n)], capacity)


def test_plan_of_lengths_over_a_third_is_optimal():
    """Two pointers give the least number of sequences where no three lengths fit together."""
    r = np.random.default_rng(1)
    for _ in range(50):
        sizes = sorted(r.integers(22, 64, 41).tolist())
        plan = packing.Plan(dict(collections.Counter(sizes)), 64)
        used, low, high = 0, 0, len(sizes) - 1
        while low <= high:
            low += sizes[low] + sizes[high] <= 64 and low < high
            high -= 1
            used += 1
        assert plan.sequences == used


def test_encoder_equals_the_library_on_the_letters_of_many_scripts():
    with open(packing.default_tokenizer(), encoding="utf-8") as f:
        file = f.read()
    encode, whole = packing._encoder(file), Tokenizer.from_str(file)
    assert json.loads(file)["model"]["type"] == "BPE"
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::61]
    texts = [f"a{chr(c)}b 1{chr(c)} .{chr(c)},  {chr(c)}\n {chr(c)}'s" for c in points]
    assert [encode(t).tolist() for t in texts] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
