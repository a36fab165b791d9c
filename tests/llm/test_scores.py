"""Toxicity and language: the method's parts against brute force, and accuracy on rows held out."""

import random

import numpy as np
import pytest

from strandlake.llm import language, toxicity


def brute_segments(scores):
    """All maximal scoring segments by their definition: the best segment, then those left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-9 and (best is None or total > best[2] + 1e-9):
                best = (i, j, total)
    if best is None:
        return []
    i, j, s = best
    right = [(a + j + 1, b + j + 1, x) for a, b, x in brute_segments(scores[j + 1 :])]
    return [*brute_segments(scores[:i]), (i, j, s), *right]


def test_segments():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-1.0, -1.0, -1.0, rng.uniform(0.1, 4), -rng.uniform(0.1, 4)]) for _ in range(rng.randint(0, 40))]
        told = [(i, s) for i, s in enumerate(scores) if s != -1.0]
        got = toxicity.segments([i for i, _ in told], [s for _, s in told], 1.0)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(got, want))


def test_stems():
    found = toxicity.Scores({"idiot": 3.0, "vequ*": 2.0, "vequi*": 2.5})
    assert [found[w] for w in ("idiot", "vequix", "vequ", "veq", "other")] == [3.0, 2.5, 2.0, None, None]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(900)]
    bad = ["zzidiotic", "zzmoron", "zzscum"]
    rows = []
    for i in range(900):
        own = rng.choices(words, k=rng.randint(20, 300))
        if i % 5 == 0:
            for _ in range(rng.randint(2, 5)):
                own.insert(rng.randrange(len(own)), rng.choice(bad))
        rows.append((i, " ".join(own), int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity(labelled):
    rows = toxicity.op7_toxicity(labelled.select("doc_id", "text"), labelled.select("doc_id", "toxic")).join(labelled, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert 150 < len(held) < 300 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.toxic for r in held) > 0.95 * len(held)


def test_learn(labelled):
    """Signed log-odds, lambda, evidence and scores are those of their definitions."""
    import math
    import re
    from collections import Counter

    model, rows = toxicity.learn(labelled), labelled.collect()
    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    seen = {0: Counter(), 1: Counter()}
    for r in rows:
        seen[r.toxic].update({x for w in split(r.text) for x in (w, *([w[:5] + "*"] if len(w) > 4 else []), *([w[:4] + "*"] if len(w) > 3 else []))})
    n = Counter(r.toxic for r in rows)
    want = {}
    for w in seen[0].keys() | seen[1].keys():
        both = seen[0][w] + seen[1][w]
        a, b = (seen[y][w] + 50 * both / len(rows) for y in (1, 0))
        odds = math.log(a / max(n[1] + 50 - a, 1)) - math.log(b / max(n[0] + 50 - b, 1))
        sure = math.copysign(max(0, abs(odds) - math.sqrt(1 / a + 1 / b)), odds)
        if both >= 3 and sure:
            want[w] = sure - 2
    assert model.weights.keys() == want.keys() and all(abs(model.weights[w] - x) < 1e-9 for w, x in want.items())
    assert min(want.values()) < -2 < 0 < max(want.values())  # evidence of both signs

    def score(w):
        return next((want[x] for x in (w, w[:5] + "*", w[:4] + "*") if x in want and (x == w or len(w) >= len(x) - 1)), -2.0)

    clean = [score(w) for r in rows if not r.toxic for w in split(r.text)]
    chance = sum(math.exp(model.lam * s) for s in [*want.values(), -2.0]) / (len(want) + 1)  # the one token more
    assert abs((sum(math.exp(model.lam * s) for s in clean) + chance) / (len(clean) + 1) - 1) < 0.02
    got = {r.key: r.score for r in toxicity.score(labelled.selectExpr("doc_id as key", "text"), model).collect()}
    for r in rows[:40]:
        words = split(r.text)
        e = 0.0
        for _, _, s in brute_segments([score(w) for w in words]):
            e -= math.log(max(1e-300, -math.expm1(-model.k * len(words) * math.exp(-model.lam * s))))
        a, b = model.curve
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-(a * math.log1p(e) + b)))) < 1e-6


def test_passages(labelled):
    model = toxicity.learn(labelled)
    text = "abc def " * 40 + "zzmoron, you zzscum! " + "abc def " * 40
    found = toxicity.passages(labelled.sparkSession.createDataFrame([(1, text), (2, "abc def"), (3, None)], "key long, text string"), model).collect()
    assert [r.key for r in found] and all(r.key == 1 and "zz" in text[r.start : r.end] and r.expectation <= 0.05 for r in found)


def test_nothing_to_learn(spark, docs, tricky, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.op7_toxicity(docs, none).collect()
    assert len(rows) == len(tricky) and {r.score for r in rows} == {0.0}
    one = spark.createDataFrame([(0, 1), (1, 1), (None, 1), (99, 0)], "doc_id long, toxic int")
    assert toxicity.op7_toxicity(docs, one).count() == len(tricky)
    assert toxicity.op7_toxicity(empty, one).count() == 0
    twice = spark.createDataFrame([(0, 1), (0, 1), (14, 0), (15, 0), (16, None)], "doc_id long, toxic int")
    assert toxicity.op7_toxicity(docs, twice).count() == len(tricky)


def test_language(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.op10_language(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)


def test_kernel():
    """Scores by batches are those of the kernel's definition."""
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcde ", k=60)) for _ in range(12)] + ["".join(rng.choices("vwxyz ", k=60)) for _ in range(12)]
    places = [language.presence(t) for t in texts]
    model = language.Model.fit(places, ["a"] * 12 + ["z"] * 12, landmarks=8)
    kernel = lambda p, q: len(np.intersect1d(p, q)) / np.sqrt(len(p) * len(q))
    chosen = [places[i] for pair in zip(range(4), range(12, 16)) for i in pair]
    by_hand = np.array([[kernel(p, q) for q in chosen] for p in places]) @ model.weights
    langs, scores = model.score(places)
    assert langs == [model.langs[k] for k in by_hand.argmax(1)] == ["a"] * 12 + ["z"] * 12
    assert all(0.5 < s <= 1 for s in scores)


def test_exact_kernel(spark):
    """Against the kernel on exact n-gram sets, with every row as a landmark and the ridge problem solved whole."""
    import re

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in df.collect() if r.text and re.search(r"[^\W\d_]", r.text)]

    def grams(text):
        b = (" " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " ").encode()
        return {b[i : i + n] for n in (1, 2, 3, 4) for i in range(len(b) - n + 1)}

    import zlib

    learned = [r for r in rows if r.lang and zlib.crc32(str(r.doc_id).encode()) % 5]
    sets, own = [grams(r.text) for r in rows], [grams(r.text) for r in learned]
    kernel = lambda xs, ys: np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in ys] for x in xs])
    langs = sorted({r.lang for r in learned})
    y = np.array([[1.0 if r.lang == a else -1.0 for a in langs] for r in learned])
    alpha = np.linalg.solve(kernel(own, own) + 1e-2 * np.eye(len(own)), y)
    want = {r.doc_id: langs[k] for r, k in zip(rows, (kernel(sets, own) @ alpha).argmax(1))}
    got = {r.doc_id: r.lang_pred for r in language.op10_language(df).collect()}
    assert sum(got[i] == lang for i, lang in want.items()) >= 0.97 * len(want)


def invented(seed, letters="abcdefghijklmnopqrstuvwxyz"):
    """A language of its own words over the same letters as others."""
    rng = random.Random(seed)
    first = {a: rng.sample(letters, 8) for a in letters}

    def word():
        out = [rng.choice(letters)]
        while len(out) < rng.randint(2, 9):
            out.append(rng.choice(first[out[-1]]))
        return "".join(out)

    return lambda n, r: " ".join(word() if r.random() < 0.3 else w for w in r.choices(vocabulary, k=n)) if (vocabulary := [word() for _ in range(400)]) else ""


@pytest.mark.parametrize("words", [300, 10_000, 50_000])
def test_long_texts(spark, words):
    """Languages over one alphabet, learned from short texts, are told on long ones."""
    rng = random.Random(words)
    speak = {f"l{k}": invented(k) for k in range(2)}
    learned = [(i, speak[f"l{i % 2}"](300, rng), f"l{i % 2}") for i in range(200)]
    model = language.learn(spark.createDataFrame(learned, "key long, text string, lang string"), landmarks=64)
    n = 40 if words < 50_000 else 12
    asked = [(i, speak[f"l{i % 2}"](words, rng)) for i in range(n)]
    got = language.identify(spark.createDataFrame(asked, "key long, text string").repartition(4), model).collect()
    assert len(got) == n and sum(r.lang_pred == f"l{r.key % 2}" for r in got) >= 0.97 * n


def test_a_text_of_a_million_words(spark):
    """By all its parts, and in the time that its length takes."""
    rng = random.Random(1)
    speak = {f"l{k}": invented(k) for k in range(2)}
    learned = [(i, speak[f"l{i % 2}"](300, rng), f"l{i % 2}") for i in range(100)]
    model = language.learn(spark.createDataFrame(learned, "key long, text string, lang string"), landmarks=64)
    # the first tenth is in the other language: a prefix would be told wrong
    text = {k: speak[f"l{1 - k}"](100_000, rng) + " " + speak[f"l{k}"](900_000, rng) for k in range(2)}
    got = {r.key: r.lang_pred for r in language.identify(spark.createDataFrame(list(text.items()), "key long, text string"), model).collect()}
    assert got == {0: "l0", 1: "l1"}


def test_parts_are_a_mean_of_kernels():
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefgh ", k=20_000))
    own = language.parts(text)
    assert len(own) == 5 and len(language.parts("short one")) == 1 and language.parts("1 2 !") is None
    other = language.presence("".join(rng.choices("abcdefgh ", k=500)))
    kernel = lambda p, q: len(np.intersect1d(p, q)) / np.sqrt(len(p) * len(q))
    rows = language._rows([own, other])
    assert rows[0] @ rows[1] == pytest.approx(np.mean([kernel(p, other) for p in own]), rel=1e-4)
    assert np.array_equal(language._rows([[other]]), language._rows([other]))


def test_many_languages(spark):
    """Every language is learned, however many there are."""
    rng = random.Random(4)
    rows = []
    for k in range(450):
        letters = [chr(0x4E00 + 40 * k + j) for j in range(12)]
        rows += [(len(rows), "".join(rng.choices(letters, k=60)), f"l{k}") for _ in range(6)]
    rows = [(i, t, lang) for i, (_, t, lang) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(df.selectExpr("doc_id as key", "text", "lang"), landmarks=600)
    assert len(model.langs) == 450
    got = language.identify(df.selectExpr("doc_id as key", "text"), model).collect()
    assert sum(r.lang_pred == rows[r.key][2] for r in got) > 0.9 * len(rows)


def test_language_edges(spark, docs, tricky, empty):
    rows = language.op10_language(docs).collect()
    assert len(rows) == len(tricky) and {r.lang_pred for r in rows} == {"und"}
    one = spark.createDataFrame([(i, t, "xx") for i, t in tricky], "doc_id long, text string, lang string")
    got = language.op10_language(one).collect()
    none = [t for _, t in tricky if t is None or not any(c.isalpha() for c in t)]
    assert sum(r.lang_pred == "und" for r in got) == len(none) and {r.lang_pred for r in got} == {"und", "xx"}
    assert language.op10_language(empty).count() == 0
