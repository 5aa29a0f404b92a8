"""Importance resampling, language identification and vector codes against plain versions, on odd rows and on nothing."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_data import COLUMNS, odd_rows, prose, row

from starlog.llm import language_id, resample, vector_codes

# 11 importance resampling


def plain_features(text, max_n):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def plain_resample(texts, target, max_n, buckets, percent, min_words, seed):
    """Rows (doc_id, n_words, n_features, weight, score, rank) of the (doc_id, text)."""

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    held = [(i, *plain_features(text, max_n)) for i, text in texts]
    s = Counter(bucket(f) for _, _, features in held for f in features)
    t = Counter(bucket(f) for text in target for f in plain_features(text, max_n)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in range(buckets)
    ]
    rows = []
    for i, words, features in held:
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[1:]))
    drawn = able[: percent * len(able) // 100]
    return [(*r, drawn.index(r) + 1 if r in drawn else None) for r in rows]


LINED = [
    (20, "One two\nthree\n\nfour five six\n" * 3),
    (21, "one two\nthree\n\nfour five six"),
    (22, "a\nb\nc\nd\ne\nf"),
    (23, "\n\n - \n"),
    (24, "ÀÉ x1\nÀé y\n" * 40),
    (25, "four five six\n" * 30),
]


@pytest.mark.parametrize("max_n", [1, 2, 4])
def test_resampling_equals_plain_version(spark, max_n):
    rows = [*odd_rows(), *[row(i, text) for i, text in LINED]]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    target = ["One two three four", None, "", "four five six " * 5, prose(2, 30)]
    wanted = spark.createDataFrame([(text,) for text in target], "text string")
    weighed = resample.weigh(docs, wanted, max_n, buckets=97)
    found = resample.resample(weighed, percent=50, min_words=5, seed=7).collect()
    names = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
    want = plain_resample([r[:2] for r in rows], target, max_n, 97, 50, 5, 7)
    # of equal rows any may bear the lower rank
    def order(found):
        return sorted(found, key=str)

    ranks = sorted(r.rank for r in found if r.rank)
    able = sum(r[1] >= 5 for r in want)
    assert ranks == list(range(1, able // 2 + 1))
    assert order([r[n] for n in names[:-1]] for r in found) == order(list(r[:-1]) for r in want)
    by_rank = {r.rank: (r.doc_id, r.score) for r in found if r.rank}
    assert by_rank == {r[-1]: (r[0], r[4]) for r in want if r[-1]} or len(set(want)) < len(want)


def test_resampling_of_nothing(spark, nothing, odd):
    empty = nothing.select("text")
    assert resample.resample(resample.weigh(nothing, odd)).collect() == []
    rows = resample.resample(resample.weigh(odd, empty), min_words=1).collect()
    assert len(rows) == len(odd_rows()) and {r.weight for r in rows if not r.n_features} == {0}


def test_equal_lines_are_counted_once(spark):
    docs = spark.createDataFrame([row(i, "the very same line\n" + f"own {i}") for i in range(200)], COLUMNS)
    lines = resample.distinct_lines(docs, 1, 50)
    assert lines.count() == 201 and lines.where("times = 200").count() == 1


# 12 language identification


def speech(seed, letters, words):
    pick = random.Random(seed)
    return " ".join("".join(pick.choices(letters, k=pick.randint(2, 8))) for _ in range(words))


TONGUES = {"aa": "abcdeé", "bb": "fghijk", "cc": "αβγδεζ"}


def tongues(spark, each=120, first=0):
    rows = [(at * 1000 + i + first, speech(at * 1000 + i + first, letters, 5 + i % 60), lang)
            for at, (lang, letters) in enumerate(TONGUES.items()) for i in range(each)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_subwords():
    points, has_letter = language_id.characters("Ab, é1")
    assert has_letter and points.tolist() == [97, 98, 0, 0, 233, 0]
    plain = ["a", "b", "é", " a", "ab", "b ", " é", "é ", " ab", "ab ", " é ", " ab "]
    wide = np.concatenate(list(language_id.subwords(points, 1 << 40)))
    assert len(set(wide.tolist())) == len(wide) == len(plain)
    chars = language_id.CHARS
    text = speech(1, "abcdefgh", 200)
    points, _ = language_id.characters(text)
    whole = np.sort(np.concatenate(list(language_id.subwords(points, 1 << 15))))
    try:
        language_id.CHARS = 7
        cut = list(language_id.subwords(points, 1 << 15))
    finally:
        language_id.CHARS = chars
    assert len(cut) > 100 and np.array_equal(np.sort(np.concatenate(cut)), whole)


def test_languages_are_told_apart(spark):
    model = language_id.fit(tongues(spark), sample_docs=300)
    assert model.languages == ["aa", "bb", "cc"]
    test = tongues(spark, 40, first=500)
    found = {r.doc_id: r for r in language_id.identify(test, model).collect()}
    truth = {r.doc_id: r.lang for r in test.collect()}
    assert sum(found[i].lang_pred == lang for i, lang in truth.items()) >= 0.98 * len(truth)
    assert all(0 <= r.score <= 1 for r in found.values())
    right = [found[i].score for i, lang in truth.items() if found[i].lang_pred == lang]
    assert np.mean(right) > 0.9
    again = language_id.fit(tongues(spark).repartition(5), sample_docs=300)
    assert np.array_equal(again.embeddings, model.embeddings) and again.scale == model.scale


def test_rejection_threshold_bounds_the_error():
    draw = np.random.default_rng(1)
    model = language_id.Model(["x", "y"])
    # pieces whose only subword has logits of growing size: the greater, the surer
    model.embeddings, model.output, model.bias = np.eye(2, dtype=np.float32), np.eye(2, dtype=np.float32), np.zeros(2, np.float32)
    strength = draw.uniform(0, 5, 4000)
    truth = (draw.random(4000) > 1 / (1 + np.exp(-strength))).astype(int)
    logits = iter(np.column_stack([strength, np.zeros(4000)]))
    model.logits = lambda points: (next(logits), 1)
    language_id.calibrate(model, [np.zeros(1)] * 4000, truth, 0.02)
    chances = language_id.calibrated(np.column_stack([strength, np.zeros(4000)]), np.ones(4000), *model.scale).max(axis=1)
    accepted = chances >= model.threshold
    wrong = truth[accepted].mean()
    assert 0.1 < accepted.mean() < 0.9 and 0.01 < wrong <= 0.02
    assert abs(np.exp(model.scale[0] + model.scale[1] * math.log(2)) - 1) < 0.15  # these logits were calibrated already


def test_languages_of_odd_rows(spark, odd, nothing):
    model = language_id.fit(tongues(spark), sample_docs=100)
    found = language_id.identify(odd, model).collect()
    assert len(found) == len(odd_rows())
    by_id = {r.doc_id: r for r in found}
    assert {(by_id[i].lang_pred, by_id[i].score, by_id[i].accepted) for i in (2, 3, 4)} == {("und", 0.0, False)}
    assert all(r.lang_pred in model.languages for r in found if r.doc_id in (1, 5, 7, 9))
    assert language_id.identify(nothing, model).collect() == []
    unknown = language_id.fit(nothing)
    assert {r.lang_pred for r in language_id.identify(odd, unknown).collect()} == {"und"}
    single = language_id.fit(odd)  # one language, NULLs in every column, repeated rows
    assert {r.lang_pred for r in language_id.identify(odd, single).collect()} == {"en", "und"}
    assert language_id.characters("½² 12 _ . ́")[1] is False and language_id.characters("न")[1] is True


def test_a_frequent_text_is_learned_once(spark):
    rows = [(i, "abc abd", "aa") for i in range(3000)] + [(i, speech(i, "fghijk", 9), "bb") for i in range(3000, 3100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = language_id.sample(docs, {"aa": 3000, "bb": 100}, 200)
    counts = {r["lang"]: r["count"] for r in pieces.groupBy("lang").count().collect()}
    assert counts["aa"] == 6 and counts["bb"] == 600


# 13 vector codes


def plain_codes(rows, parts, entries, rounds):
    """Lloyd rounds with full scans over the (vec_id, ints): codes, errors and codebooks."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1]) // parts
    cut = [[r[1][p * width : (p + 1) * width] for p in range(parts)] for r in rows]
    books = [[list(one[p]) for one in cut[:entries]] for p in range(parts)]

    def assign():
        best = [
            [min((sum((a - b) ** 2 for a, b in zip(one[p], c)), k) for k, c in enumerate(books[p])) for p in range(parts)]
            for one in cut
        ]
        return [[k for _, k in found] for found in best], [sum(d for d, _ in found) for found in best]

    for _ in range(rounds):
        codes, _ = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                held = [one[p] for one, code in zip(cut, codes) if code[p] == k]
                if held:
                    books[p][k] = [sum(column) // len(held) for column in zip(*held)]
    codes, errors = assign()
    return [(r[0], bytes(code), error) for r, code, error in zip(rows, codes, errors)], books


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.integers(1, 3))
def test_active_entries_give_the_full_scan(seed, entries, width):
    draw = np.random.default_rng(seed)
    rows = draw.integers(-3, 4, (40, width))  # few values, so that ties are common
    before = draw.integers(-3, 4, (entries, width))
    after = np.where(draw.random(entries)[:, None] < 0.4, draw.integers(-3, 4, (entries, width)), before)
    codes, away = vector_codes.nearest(rows, before)
    found = vector_codes.reassign(rows, after, (before != after).any(axis=1), codes, away)
    for got, want in zip(found, vector_codes.nearest(rows, after)):
        assert np.array_equal(got, want)


VECTORS = "vec_id long, embedding array<float>, label int, ints string, code string, error string, away int"


def odd_vectors():
    pick = random.Random(3)
    rows = [(i, [pick.choice([-0.5, 0.0, 0.0041, 0.25, 1.0]) for _ in range(8)], i % 3) for i in range(60)]
    rows += [(5, rows[5][1], 2), (5, rows[6][1], 2), (70, rows[7][1], None), (71, rows[8][1], None), (None, rows[9][1], 1)]
    rows += [(-1, None, 0), (-2, [0.5] * 7 + [None], 0), (-3, [float("nan")] + [0.0] * 7, 0), (-4, [0.0] * 7 + [float("inf")], 0)]
    rows += [(-5, [], 0), (80, [0.5] * 4, 0), (-6, [1e30] * 8, 0), (None, None, None)]
    return [(*r, "x", "y", "z", 1) for r in rows]


@pytest.mark.parametrize("entries,rounds", [(4, 0), (4, 1), (16, 3), (200, 2)])
def test_codes_equal_plain_rounds(spark, entries, rounds):
    docs = spark.createDataFrame(odd_vectors(), VECTORS).repartition(4)
    coding = vector_codes.compress(docs, parts=4, entries=entries, rounds=rounds)
    kept = [
        (r[0], [math.floor(256 * x) for x in np.array(r[1], np.float32).astype(float)])
        for r in odd_vectors()
        if r[1] and len(r[1]) == 8 and all(x is not None and abs(x) < 1e5 for x in r[1])
    ]
    want, books = plain_codes(kept, 4, entries, rounds)
    rows = coding.rows.collect()
    assert sorted(((r.vec_id, bytes(r.code), r.error) for r in rows), key=str) == sorted(want, key=str)
    assert coding.codebooks.tolist() == books
    sums = {r.label: r.label_error for r in vector_codes.with_label_error(coding.rows).collect()}
    totals = Counter()
    for r in rows:
        totals[r.label] += r.error
    assert sums == totals and None in sums


def test_codes_of_nothing(spark):
    nothing = spark.createDataFrame([], VECTORS)
    assert vector_codes.with_label_error(vector_codes.compress(nothing).rows).collect() == []
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame(odd_vectors(), VECTORS), parts=3)


def test_codes_do_not_depend_on_partitions(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.normal(size=32)], i % 4) for i in range(500)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    first, second = (vector_codes.compress(docs.repartition(n), entries=32) for n in (1, 7))
    assert first.fingerprint() == second.fingerprint()
    assert sorted(map(tuple, first.rows.collect())) == sorted(map(tuple, second.rows.collect()))
