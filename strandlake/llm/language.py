"""Language identification with a string kernel, Nyström landmarks and kernel ridge regression.

The blended-spectrum presence kernel of two texts is the cosine of their sets of byte
n-grams (n = 1 to 4, over letters, with one mark for everything between words), the
n-grams hashed to ``DIMS`` places. A long text is cut into equal parts of about ``PART`` bytes, and its kernel with another is the
mean of its parts' kernels: the set of all n-grams of a very long text would be nearly all there are. Of the labelled rows about ``FIT_ROWS`` a language and, with many
languages, about ``FIT_TOTAL`` in all are used, ``LEAST_ROWS`` a language at least, dealt by a hash of the id; no
language is left out. Of these rows ``LANDMARKS`` in all are landmarks.
With K the kernel between landmarks, a text's features are its kernel values with the
landmarks times K^(-1/2) (Nyström); a ridge regression for each language, one against the rest,
is solved on them. Scoring multiplies batches: presence rows times the landmark
matrix, then times the weights.

Only the fit uses a bounded sample, of each text at most ``FIT_PARTS`` parts, evenly spaced; every text is scored by all its parts. ``lang``, ``source``
and the id are never inputs of a prediction.

Defined results: a null text, or one without a letter, is ``und`` with score 0; rows
without an id aren't learned from; with no row to learn from, all are ``und``; with a single
language, it is always predicted; rows with the same id are labelled apart; very long texts are taken
whole, part by part; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import crc_mod, ship_code

DIMS = 1 << 14
ORDERS = (1, 2, 3, 4)
#: Bytes of a part of a long text; parts of a text that are learned from.
PART = 4096
FIT_PARTS = 4
#: Bounds of the fit: rows a language, rows in all, rows a language however many there are, and landmarks.
FIT_ROWS = 1500
FIT_TOTAL = 24_000
LEAST_ROWS = 8
LANDMARKS = 256
RIDGE = 1e-2
#: Languages whose counts are broadcast, at most.
SENT = 100_000
BATCH = 256

_between = re.compile(r"[\W\d_]+")


def _clean(text: str) -> np.ndarray | None:
    """The text's letters with one mark between words; None: no letter."""
    clean = _between.sub(" ", text.lower()).strip()
    return np.frombuffer((" " + clean + " ").encode("utf-8", "replace"), np.uint8).astype(np.uint32) if clean else None


def _places(b: np.ndarray) -> np.ndarray:
    """The places of the n-grams, each once."""
    seen = np.zeros(DIMS, dtype=bool)
    code = np.zeros(len(b), dtype=np.uint32)
    for n in ORDERS:
        if len(b) < n:
            break
        code = code[: len(b) - n + 1] * np.uint32(257) + b[n - 1 :] + np.uint32(1)
        seen[(code * np.uint32(2654435761)) >> np.uint32(18)] = True
    return np.flatnonzero(seen)


def presence(text: str) -> np.ndarray | None:
    """The places of the whole text's n-grams; None: no letter."""
    b = _clean(text)
    return None if b is None else _places(b)


def parts(text: str) -> list[np.ndarray] | None:
    """The places of the n-grams of each part of the text; None: no letter."""
    b = _clean(text)
    return None if b is None else [_places(x) for x in np.array_split(b, max(1, round(len(b) / PART)))]


def _rows(texts: list) -> np.ndarray:
    """A row a text: its presence row of unit length, or the mean of its parts'."""
    x = np.zeros((len(texts), DIMS), dtype=np.float32)
    for i, own in enumerate(texts):
        own = [own] if isinstance(own, np.ndarray) else own
        for p in own:
            x[i, p] += 1 / np.sqrt(len(p)) / len(own)
    return x


class Model:
    """Landmark matrix and weights of the one-versus-rest regressions."""

    def __init__(self, langs: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.langs, self.landmarks, self.weights = langs, landmarks, weights

    @classmethod
    def fit(cls, places: list, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> "Model":
        langs = sorted(set(labels))
        number = {a: k for k, a in enumerate(langs)}
        own = np.array([number[a] for a in labels])
        # landmarks: the same number from each language, in the order that the rows came
        rank: dict[str, int] = {}
        order = []
        for i, lang in enumerate(labels):
            rank[lang] = rank.get(lang, -1) + 1
            order.append((rank[lang], i))
        chosen = _rows([places[i] for _, i in sorted(order)[:landmarks]])
        k = chosen @ chosen.T
        value, vector = np.linalg.eigh(k.astype(np.float64))
        keep = value > 1e-6 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])
        gram, right = np.zeros((keep.sum(), keep.sum())), np.zeros((keep.sum(), len(langs)))
        weight = 1 / np.bincount(own)
        for lo in range(0, len(places), BATCH):
            f = (_rows(places[lo : lo + BATCH]) @ chosen.T) @ root
            part = own[lo : lo + BATCH]
            weighed = f * weight[part][:, None]
            gram += f.T @ weighed
            right -= weighed.sum(0)[:, None]  # against the rest: -1, and 1 for the own language
            np.add.at(right.T, part, 2 * weighed)
        solved = np.linalg.solve(gram + ridge * np.trace(gram) / len(gram) * np.eye(len(gram)), right)
        return cls(langs, np.ascontiguousarray(chosen.T), (root @ solved).astype(np.float32))

    def score(self, places: list) -> tuple[list[str], list[float]]:
        out = (_rows(places) @ self.landmarks) @ self.weights
        best = out.argmax(1)
        margin = np.exp(4 * (out - out.max(1, keepdims=True)))
        return [self.langs[i] for i in best], (1 / margin.sum(1)).astype(float).tolist()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [parts(t or "") for t in batch.column(1).to_pylist()]
        few = [None if p is None else [p[k] for k in sorted({i * len(p) // FIT_PARTS for i in range(FIT_PARTS)})] for p in got]
        bits = [None if p is None else [np.packbits(np.isin(np.arange(DIMS), x)).tobytes() for x in p] for p in few]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bits, pa.list_(pa.binary()))], ["lang", "order", "bits"])


def learn(labelled: DataFrame, *, fit_rows: int = FIT_ROWS, fit_total: int = FIT_TOTAL, landmarks: int = LANDMARKS) -> Model | None:
    """Fits a model to rows of (key, text, lang), a bounded number of them by a hash of the key."""
    ship_code(labelled.sparkSession)
    rows = labelled.where("key is not null and lang is not null")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    langs = counts.count()
    if not langs:
        return None
    quota = max(LEAST_ROWS, min(fit_rows, fit_total // langs))
    named = F.broadcast if langs <= SENT else lambda df: df
    order = F.xxhash64("key", F.lit(11))
    share = counts.select("lang", F.least(F.lit(1.0), quota / F.col("n")).alias("share"))
    dealt = rows.withColumn("order", order).join(named(share), "lang").where(F.pmod("order", F.lit(1 << 30)) < F.col("share") * float(1 << 30))
    got = dealt.select("lang", "text", "order").mapInArrow(_features, "lang string, order long, bits array<binary>").where("bits is not null").collect()
    got.sort(key=lambda r: (r["order"], r["lang"], r["bits"]))
    if not got:
        return None
    places = [[np.flatnonzero(np.unpackbits(np.frombuffer(x, np.uint8))) for x in r["bits"]] for r in got]
    return Model.fit(places, [r["lang"] for r in got], landmarks)


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    own = model.value
    for batch in batches:
        for lo in range(0, batch.num_rows, BATCH):
            part = batch.slice(lo, BATCH)
            got = [parts(t or "") for t in part.column(1).to_pylist()]
            langs, scores = ["und"] * len(got), [0.0] * len(got)
            known = [i for i, p in enumerate(got) if p is not None]
            if known and own is not None:
                for i, lang, s in zip(known, *own.score([got[i] for i in known])):
                    langs[i], scores[i] = lang, s
            columns = [c for i, c in enumerate(part.columns) if i != 1]
            names = [n for i, n in enumerate(part.schema.names) if i != 1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(langs), pa.array(scores, pa.float64())], [*names, "lang_pred", "score"])


def identify(texts: DataFrame, model: Model | None) -> DataFrame:
    """Rows of (key, text): key, lang_pred and score."""
    ship_code(texts.sparkSession)
    sent = texts.sparkSession.sparkContext.broadcast(model)
    key = texts.select("key").schema[0].dataType.simpleString()
    return texts.select("key", "text").mapInArrow(partial(_predict, model=sent), f"key {key}, lang_pred string, score double")


def op10_language(docs: DataFrame) -> DataFrame:
    """Learns from documents whose crc32 of the id, modulo 5, isn't 0, and labels all documents."""
    ship_code(docs.sparkSession)
    model = learn(docs.where(crc_mod("doc_id", 5) != 0).select(F.col("doc_id").alias("key"), "text", "lang"))
    found = identify(docs.select(F.col("doc_id").alias("key"), "text"), model)
    return found.select(F.col("key").alias("doc_id"), F.coalesce(crc_mod("key", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
