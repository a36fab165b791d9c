"""Toxicity by maximum-scoring segments over token log-odds, with extreme-value calibration.

Fit, on labelled rows (at most about ``FIT_DOCS``, dealt by a hash of the id): the log-odds
of toxic against clean rows to have a token, both with an informative Dirichlet prior
that follows the token's frequency in all rows. Log-odds keep their sign; each is drawn towards
zero by ``SHRINK`` standard errors, so that chance says little. Words also count by their first
letters, for forms that weren't seen. A token scores its log-odds less a common penalty: the sum
over a clean text drifts down, so that high segments are rare events.

Score: a linear scan (Ruzzo and Tompa) finds all maximal scoring segments of a text.
Their scores are calibrated as extreme values: lambda solves
E[exp(lambda s)] = 1 for token scores s in clean rows (counted on a fixed grid of ``GRID`` steps a
unit), K is read from the clean rows' highest segments, and a segment of score S in n tokens has
expectation E = K n exp(-lambda S). A text's evidence adds up over its segments. A
logistic curve, fitted on the labelled rows, turns the evidence into a probability. The driver
gets two numbers a labelled row, never its tokens.

Only the fit uses a bounded sample; every text is scored, in full. Labels, language,
source and id are never inputs of a score.

Defined results: a null or empty text has the score of no evidence; with no toxic or no clean
row to learn from, every text gets the labelled rows' share of toxic ones (0 without rows);
a document that is labelled more than once counts once for each label; labels that are
null or belong to no document are ignored; rows with the same id are scored apart; very long texts
are scanned whole, in linear time; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import crc_mod, materialise, ship_code, slices

#: Labelled rows that a fit uses, at most (about).
FIT_DOCS = 40_000
PRIOR = 50.0
SHRINK = 1.0
#: Rows that a token of the vocabulary is in, at least, and tokens in it, at most: those in most rows.
MIN_TEXTS = 3
VOCABULARY = 500_000
PENALTY = 2.0
#: Steps of the grid of token scores, to a unit, and its ends.
GRID = 64
ENDS = 40
SIGNIFICANT = 0.05
THRESHOLD = 0.3

#: A word that has no score of its own takes that of its beginning, of so many letters.
STEMS = (5, 4)

_token = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    return _token.findall(text.lower())


def stems(word: str) -> list[str]:
    """What a word counts as besides itself."""
    return [word[:n] + "*" for n in STEMS if len(word) >= n]


class Scores(dict):
    """Word -> score, None: the penalty alone. Words met before are remembered, within a bound."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float | None:
        found = next((self.weights[x] for x in (word, *stems(word)) if x in self.weights), None)
        if len(self) > 500_000:
            self.clear()
        self[word] = found
        return found


def segments(places: list[int], scores: list[float], penalty: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), by Ruzzo and Tompa's linear scan.

    ``places`` and ``scores`` are the tokens that don't cost just ``penalty``, in order.
    """
    held: list[list[float]] = []  # first, last, sum before it, sum up to its end
    left: list[int] = []  # for each of them the nearest one before with a smaller sum before
    total, at = 0.0, 0
    for p, s in zip(places, scores):
        total -= penalty * (p - at)
        at = p + 1
        before, total = total, total + s
        if s <= 0:
            continue
        new = [p, p, before, total]
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= new[2]:
                j = left[j]
            if j < 0 or held[j][3] >= new[3]:
                held.append(new)
                left.append(j)
                break
            new = [held[j][0], p, held[j][2], total]
            k = left[j]
            del held[j:], left[j:]
            j = k
    return [(int(a), int(b), e - s) for a, b, s, e in held]


class Model:
    """Token scores and the calibration of segments and texts."""

    def __init__(self, weights: dict[str, float], penalty: float = PENALTY):
        self.weights, self.penalty = weights, penalty
        self.scores = Scores(weights)
        self.share, self.lam, self.k = 0.0, 1.0, 1.0
        self.curve = None

    def __reduce__(self):
        return _model, (self.weights, self.penalty, self.share, self.lam, self.k, self.curve)

    def scored(self, words: list[str]) -> list[tuple[int, float]]:
        """The places of tokens that don't cost just the penalty, and their scores."""
        return [(i, s) for i, s in enumerate(map(self.scores.__getitem__, words)) if s is not None]

    def passages(self, found: list[tuple[int, float]], n: int) -> list[tuple[int, int, float, float]]:
        """Each segment's first and last token, score and expectation in n tokens of a clean text."""
        if not found:
            return []
        runs = segments([i for i, _ in found], [s for _, s in found], self.penalty)
        return [(a, b, s, self.k * n * math.exp(-min(self.lam * s, 700.0))) for a, b, s in runs]

    def evidence(self, found: list[tuple[int, float]], n: int) -> float:
        """The sum of -ln p over segments, p being one of that score or more in a clean text so long."""
        out = 0.0
        for _, _, _, e in self.passages(found, n):
            p = -math.expm1(-e) if e > 1e-12 else e
            out -= math.log(max(p, 1e-300))
        return out

    def probability(self, words: list[str]) -> float:
        if self.curve is None:
            return self.share
        a, b = self.curve
        x = a * math.log1p(self.evidence(self.scored(words), len(words))) + b
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))

    def solve(self, scores: np.ndarray, counts: np.ndarray) -> None:
        """Lambda, the positive root of E[exp(lambda s)] = 1, from how often clean rows' tokens have each score."""
        # one more token than was seen, shared by all scores: clean rows may have none of the high ones
        all_ = np.array([*self.weights.values(), -self.penalty])
        s, c = np.concatenate([scores, all_]), np.concatenate([counts, np.full(len(all_), 1 / len(all_))])
        if s.max() <= 0 or (s * c).sum() >= 0:
            return
        lo, hi = 1e-6, 50.0
        for _ in range(100):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if (c * np.exp(np.clip(mid * s, -700, 700))).sum() > c.sum() else (mid, hi)
        self.lam = (lo + hi) / 2

    def scale(self, tops: list[float], size: int) -> None:
        """K, so that segments as high as the median of clean texts' highest are expected as often as found."""
        high = sorted(t for t in tops if t > 0)
        if high:
            level = high[len(high) // 2]
            self.k = max(1e-12, sum(t >= level for t in high) / max(1, size) * math.exp(min(self.lam * level, 600.0)))


def _model(weights, penalty, share, lam, k, curve) -> Model:
    out = Model(weights, penalty)
    out.share, out.lam, out.k, out.curve = share, lam, k, curve
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps on a slightly regularised logistic regression of one variable."""
    design, w = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        grad = design.T @ (p - y) + 1e-2 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each token and stem the toxic and the clean rows that have it, summed within a batch."""
    for batch in slices(batches, 2000):
        rows = (Counter(), Counter())
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = set(tokens(text or ""))
            rows[y].update(own.union(*map(stems, own)))
        names = list(rows[0].keys() | rows[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([rows[y][w] for w in names], pa.int64()) for y in (1, 0))], ["token", "toxic", "clean"])


def _measured(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """For each labelled text its tokens, its highest segment and how often it has each score, on the grid."""
    own = model.value
    for batch in slices(batches):
        rows: tuple[list, ...] = ([], [], [], [])
        for text in batch.column(0).to_pylist():
            words = tokens(text or "")
            found = own.scored(words)
            places = np.round(np.clip([s for _, s in found], -ENDS, ENDS) * GRID).astype(np.int64) if found else np.zeros(0, np.int64)
            bins, sizes = np.unique(places, return_counts=True)
            top = max((x[2] for x in segments([i for i, _ in found], [s for _, s in found], own.penalty)), default=0.0)
            for column, x in zip(rows, (len(words), top, bins.tolist(), sizes.tolist())):
                column.append(x)
        kinds = (pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(x, t) for x, t in zip(rows, kinds))], ["toxic", "n", "top", "bins", "sizes"])


def _evidence(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    own = model.value
    for batch in slices(batches):
        words = [tokens(t or "") for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([own.evidence(own.scored(w), len(w)) for w in words], pa.float64())], ["toxic", "evidence"])


def learn(rows: DataFrame, *, prior: float = PRIOR, shrink: float = SHRINK, min_texts: int = MIN_TEXTS, penalty: float = PENALTY, vocabulary: int = VOCABULARY) -> Model:
    """Fits a model to rows of (text, toxic), which should be a bounded sample."""
    spark = rows.sparkSession
    ship_code(spark)
    rows = materialise(rows.select("text", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)"), "toxic-rows")
    own = {r["toxic"]: float(r["count"]) for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = own.get(1, 0.0), own.get(0, 0.0)
    model = Model({}, penalty)
    model.share = n1 / max(1.0, n1 + n0)
    if not n1 or not n0:
        return model
    counts = rows.mapInArrow(_counted, "token string, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    seen = F.col("toxic") + F.col("clean")
    alpha = F.lit(prior) * seen / (n1 + n0)
    a, b = F.col("toxic") + alpha, F.col("clean") + alpha
    # a token in nearly all rows would leave nothing outside it
    odds = F.log(a / F.greatest(n1 + prior - a, F.lit(1.0))) - F.log(b / F.greatest(n0 + prior - b, F.lit(1.0)))
    sure = F.signum(odds) * F.greatest(F.abs(odds) - shrink * F.sqrt(1 / a + 1 / b), F.lit(0.0))
    told = counts.where(seen >= min_texts).select("token", seen.alias("seen"), sure.alias("odds")).where("odds <> 0")
    got = told.orderBy(F.desc("seen"), "token").limit(vocabulary).select("token", "odds").toArrow()
    model = Model({w: x - penalty for w, x in zip(got.column("token").to_pylist(), got.column("odds").to_pylist())}, penalty)
    model.share = n1 / (n1 + n0)
    measured = materialise(rows.mapInArrow(partial(_measured, model=spark.sparkContext.broadcast(model)), "toxic int, n long, top double, bins array<long>, sizes array<long>"), "toxic-scores")
    clean = measured.where("toxic = 0")
    grid = clean.select(F.explode(F.arrays_zip("bins", "sizes")).alias("x")).groupBy("x.bins").agg(F.sum("x.sizes").alias("c")).toArrow()
    scores, seen_ = grid.column("bins").to_numpy() / GRID, grid.column("c").to_numpy().astype(float)
    size = clean.agg(F.sum("n")).first()[0] or 0
    model.solve(np.append(scores, -penalty), np.append(seen_, size - seen_.sum()))
    model.scale(clean.select("top").toArrow().column("top").to_pylist(), size)
    final = rows.mapInArrow(partial(_evidence, model=spark.sparkContext.broadcast(model)), "toxic int, evidence double").toArrow()
    model.curve = _logistic(np.log1p(final.column("evidence").to_numpy()), final.column("toxic").to_numpy().astype(float))
    return model


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    own = model.value
    for batch in slices(batches):
        got = [own.probability(tokens(t or "")) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], ["key", "score"])


def score(texts: DataFrame, model: Model) -> DataFrame:
    """Rows of (key, text): key and score."""
    ship_code(texts.sparkSession)
    sent = texts.sparkSession.sparkContext.broadcast(model)
    key = texts.schema["key"].dataType.simpleString()
    return texts.select("key", "text").mapInArrow(partial(_predict, model=sent), f"key {key}, score double")


def _found(batches: Iterator[pa.RecordBatch], model, significant: float) -> Iterator[pa.RecordBatch]:
    own = model.value
    for batch in batches:
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            at = [m.span() for m in _token.finditer(text or "")]
            words = [text[a:b].lower() for a, b in at]
            for a, b, s, e in own.passages(own.scored(words), len(words)):
                if e <= significant:
                    rows.append((key, at[a][0], at[b][1], s, e))
        kinds = (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["key", "start", "end", "segment_score", "expectation"])


def passages(texts: DataFrame, model: Model, *, significant: float = SIGNIFICANT) -> DataFrame:
    """Every significant segment of rows (key, text): its code points, score and expectation."""
    ship_code(texts.sparkSession)
    sent = texts.sparkSession.sparkContext.broadcast(model)
    key = texts.schema["key"].dataType.simpleString()
    return texts.select("key", "text").mapInArrow(partial(_found, model=sent, significant=significant), f"key {key}, start long, end long, segment_score double, expectation double")


def op7_toxicity(docs: DataFrame, labels: DataFrame, *, fit_docs: int = FIT_DOCS) -> DataFrame:
    """Learns from rows whose crc32 of the id, modulo 4, isn't 2, and scores all documents."""
    ship_code(docs.sparkSession)
    told = labels.where(F.col("toxic").isNotNull() & (crc_mod("doc_id", 4) != 2)).select("doc_id", "toxic").distinct()
    n = told.count()
    if n > fit_docs:
        told = told.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(n)) < fit_docs)
    # two labels an id and fit_docs ids, about: what is broadcast is bounded
    rows = docs.select("doc_id", "text").join(F.broadcast(told), "doc_id")
    found = score(docs.select(F.col("doc_id").alias("key"), "text"), learn(rows))
    return found.select(F.col("key").alias("doc_id"), F.coalesce(crc_mod("key", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
