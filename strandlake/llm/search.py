"""Ranked lexical search over a tiered index.

Documents are dealt into blocks, each indexed where it is read, without a shuffle. A term's postings in a block are sorted by
impact and cut into tiers, those of highest impact first; a tier keeps with each term its residual bound: the largest impact left in
lower tiers. A search reads the first tier of all blocks. It scores documents by the postings seen and bounds each
by the residuals of the terms not seen in it. The k-th best score seen anywhere is a lower bound of the last
place; an item is settled in a block if no document there whose score isn't proven exact can reach it. Items
lacking that proof fall through, in the blocks where they lack it, to the next tier; at the last tier nothing is left over and all is exact.

Blocks are bounded in documents and postings, so scoring one takes bounded memory; what goes on from a block to the
ranking is at most k documents an item. Items are dealt into groups, and the postings of a block meet a group's terms by a
join, so neither items nor index pass through the driver.

Scores are whole numbers: a term's weight is floor(1000 * ln((2N + 2) / (2df + 1))) and its impact in a document
10^9 tf div (1000 tf + 12 m), with m = 75 + 25 n N div L.

Defined results: a null text has no terms, and a document without terms isn't counted; an item without terms, or whose terms are nowhere, has no
rows; each row of the items is an item, also if its id is repeated or null; rows with the same id are
documents of their own, and rows without an id come last among equals; very long texts are indexed whole; empty tables give
no rows; other columns are ignored. A document's id has to be a number or a text that is one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandlake.llm.runtime import NULL_ID, doc_key, materialise, scratch_path, ship_code

TOP = 20
#: A block ends at so many documents (their numbers take 16 bits) or postings.
BLOCK_DOCS = 1 << 16
BLOCK_POSTINGS = 1 << 20
#: Shares of a term's postings in the first tiers, and how many a list's first tier has at least.
TIERS = (1 / 16, 1 / 4)
LEAST = 32
#: Items that are scored together in a block.
GROUP = 1024

#: ASCII letters in lower case, digits and all bytes of other letters stay; the rest parts terms.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
POSTINGS = "block long, term string, tier int, df int, docs binary, impacts binary, rest long"


@dataclass
class Index:
    """Where the postings are, the documents with a term and all their terms."""

    path: str
    n_docs: int
    n_terms: int


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = terms = 0
        for lo in range(0, batch.num_rows, 200):
            for text in batch.slice(lo, 200).column("text").cast(pa.binary()).to_pylist():
                n = len(text.translate(WORDS).split()) if text else 0
                docs, terms = docs + (n > 0), terms + n
        yield pa.record_batch({"docs": [docs], "terms": [terms]})


def _block(number: int, ids: list[int], lengths: list[int], known: dict[bytes, int], terms: list[np.ndarray], counts: list[np.ndarray], n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
    """A block's postings by tier and term; the row of the empty term holds the ids of its documents."""
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    place = np.empty(len(ids), np.int32)
    place[order] = np.arange(len(ids))
    sizes = [len(x) for x in terms]
    doc, m = np.repeat(place, sizes), np.repeat(np.array([75 + 25 * n * n_docs // n_terms for n in lengths], np.int64), sizes)
    term, tf = np.concatenate(terms), np.concatenate(counts).astype(np.int64)
    terms.clear()
    counts.clear()
    m *= 12
    m += 1000 * tf
    impact = (1_000_000_000 * tf // m).astype(np.int32)
    del m, tf
    by = np.lexsort((doc, -impact, term))
    term, doc, impact = term[by], doc[by], impact[by]
    df = np.bincount(term, minlength=len(known))
    first = np.cumsum(df) - df
    at = np.arange(len(term)) - first[term]
    cuts = np.array([np.minimum(df, np.maximum(LEAST, np.ceil(df * s))) for s in TIERS] + [df], np.int64)
    tier = sum((at >= c[term]).astype(np.int8) for c in cuts[:-1])
    del at
    rest = np.array([np.where(c < df, impact[np.minimum(first + c, len(impact) - 1)], 0) for c in cuts], np.int64)
    by = np.lexsort((doc, term, tier))
    term, doc, impact, tier = term[by], doc[by].astype(np.uint16), impact[by], tier[by]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(term) != 0) | (np.diff(tier) != 0))))
    ends = np.concatenate((new, [len(term)]))
    binary = lambda x: pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(x)])
    names = pa.array(list(known), pa.binary()).cast(pa.string()).take(pa.array(term[new]))
    lists = pa.record_batch({"block": np.full(len(new), number), "term": names, "tier": tier[new].astype(np.int32), "df": df[term[new]].astype(np.int32), "docs": binary(doc), "impacts": binary(impact), "rest": rest[tier[new], term[new]]})
    held = pa.record_batch([[number], [""], pa.array([0], pa.int32()), pa.array([len(ids)], pa.int32()), [np.array(ids, np.int64)[order].tobytes()], [b""], [0]], schema=lists.schema)
    yield held
    for lo in range(0, lists.num_rows, 5000):
        yield lists.slice(lo, 5000)


def _indexed(batches: Iterator[pa.RecordBatch], *, n_docs: int, n_terms: int, block_docs: int, block_postings: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids, lengths, known, terms, counts, size = [], [], {}, [], [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            cut = batch.slice(lo, 200)
            for doc, text in zip(cut.column("doc").to_pylist(), cut.column("text").cast(pa.binary()).to_pylist()):
                seen = Counter(text.translate(WORDS).split()) if text else None
                if not seen:
                    continue
                ids.append(doc)
                lengths.append(seen.total())
                terms.append(np.fromiter((known.setdefault(t, len(known)) for t in seen), np.int32, len(seen)))
                counts.append(np.fromiter(seen.values(), np.int32, len(seen)))
                size += len(seen)
                if len(ids) >= block_docs or size >= block_postings:
                    yield from _block(number, ids, lengths, known, terms, counts, n_docs, n_terms)
                    number += 1
                    ids, lengths, known, terms, counts, size = [], [], {}, [], [], 0
    if ids:
        yield from _block(number, ids, lengths, known, terms, counts, n_docs, n_terms)


def build_index(docs: DataFrame, path: str | None = None, *, block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Write the postings of all documents, a folder for each tier; without a path to the shared folder."""
    spark = docs.sparkSession
    ship_code(spark)
    rows = docs.select(doc_key(id_col).alias("doc"), F.col(text_col).alias("text"))
    sums = rows.select("text").mapInArrow(_lengths, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = sums[0] or 0, sums[1] or 0
    path = path or scratch_path(spark, "search-index")
    postings = rows.mapInArrow(partial(_indexed, n_docs=n_docs, n_terms=n_terms, block_docs=block_docs, block_postings=block_postings), POSTINGS)
    postings.write.partitionBy("tier").parquet(path)
    return Index(path, n_docs, n_terms)


def postings(spark: SparkSession, index: Index) -> DataFrame:
    return spark.read.schema(POSTINGS).parquet(index.path)


def _scored(table: pa.Table, *, top: int) -> pa.Table:
    """A block's documents for a group of items: the best scores seen, the best exact ones, and the bound of the others."""
    lists: dict[str, list] = {}
    items: dict[int, list[tuple[str, int]]] = {}
    ids = np.zeros(0, np.int64)
    asked = table.column("asked").to_pylist()[0]
    wanted = None if asked is None else set(asked)
    for term, docs, impacts, rest, tier, weights in zip(*(table.column(c).to_pylist() for c in ("term", "docs", "impacts", "rest", "tier", "weights"))):
        if term == "":
            ids = np.frombuffer(docs, np.int64)
            continue
        lists.setdefault(term, []).append((tier, np.frombuffer(docs, np.uint16), np.frombuffer(impacts, np.int32).astype(np.int64), rest))
        if tier == 0:
            for w in weights:
                if wanted is None or w["item"] in wanted:
                    items.setdefault(w["item"], []).append((term, w["weight"]))
    held = {t: (np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts]), max(parts, key=lambda x: x[0])[3]) for t, parts in lists.items()}
    out = []
    for item, terms in items.items():
        score, unseen = np.zeros(len(ids), np.int64), np.full(len(ids), sum(w * held[t][2] for t, w in terms), np.int64)
        for t, w in terms:
            docs, impacts, rest = held[t]
            score[docs] += w * impacts
            if rest:
                unseen[docs] -= w * rest
        open_ = unseen > 0
        bound = int((score + unseen)[open_].max()) if open_.any() else 0
        some = np.flatnonzero(score > 0)
        seen = score[some]
        lower = np.sort(np.partition(seen, len(seen) - top)[-top:] if len(seen) > top else seen)[::-1]
        exact = some[~open_[some]]
        if len(exact) > top:
            least = np.partition(score[exact], len(exact) - top)[len(exact) - top]
            over, ties = exact[score[exact] > least], exact[score[exact] == least]
            exact = np.concatenate((over, ties[: top - len(over)]))  # numbered by id, so the smallest ids of equals
        out.append((item, lower.tolist(), bound, [{"doc": d, "score": s} for d, s in zip(ids[exact].tolist(), score[exact].tolist())]))
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.struct([("doc", pa.int64()), ("score", pa.int64())]))]
    columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
    key = lambda c: pa.array([table.column(c)[0].as_py()] * len(out), pa.int64())
    return pa.table([key("grp"), key("block"), *columns], ["grp", "block", "item", "lower", "bound", "found"])


STATE = "grp long, block long, item long, lower array<long>, bound long, found array<struct<doc:long,score:long>>"


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, n) of rows (item, text)."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return items.select("item", F.explode(F.regexp_extract_all(lower, F.lit(PATTERN), F.lit(0))).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("n"))


def search(index: Index, items: DataFrame, *, top: int = TOP, group: int = GROUP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score, tiers): the best documents of each item and how many tiers the item was read down to."""
    spark = items.sparkSession
    ship_code(spark)
    lists = postings(spark, index)
    asked = materialise(items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"), F.col(text_col).alias("text")), "items")
    groups = -(-asked.count() // group) or 1
    terms = item_terms(asked)
    dfs = lists.where("tier = 0").select("term", "df").join(terms.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2 * index.n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = terms.join(dfs, "term").select(F.pmod(F.xxhash64("item"), F.lit(groups)).alias("grp"), "item", "term", (F.col("n") * weight).alias("weight")).where("weight > 0")
    wanted = materialise(weighed.groupBy("grp", "term").agg(F.collect_list(F.struct("item", "weight")).alias("weights")), "item-terms")
    none = F.array().cast(wanted.schema["weights"].dataType)
    wanted = wanted.unionByName(wanted.select("grp").distinct().select("grp", F.lit("").alias("term"), none.alias("weights")))

    def score(table: pa.Table) -> pa.Table:
        return _scored(table, top=top)

    settled, pending = None, None
    for tier in range(len(TIERS) + 1):
        hits = lists.where(F.col("tier") <= tier).join(wanted, "term")
        if pending is None:
            hits = hits.withColumn("asked", F.lit(None).cast("array<long>"))
        else:
            pairs = pending.groupBy("grp", "block").agg(F.collect_list("item").alias("asked"))
            hits = hits.join(pairs, ["grp", "block"]).where((F.col("term") == "") | F.exists("weights", lambda w: F.array_contains("asked", w["item"])))
        scored = hits.select("grp", "block", "term", "tier", "docs", "impacts", "rest", "weights", "asked").groupBy("grp", "block").applyInArrow(score, STATE)
        state = materialise(scored.withColumn("tiers", F.lit(tier + 1)), "scored")
        best = state if settled is None else settled.unionByName(state)
        if tier == len(TIERS):
            settled = best
            break
        ranked = best.select("item", F.explode("lower").alias("score")).withColumn("k", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("k") <= top)
        last = ranked.where(F.col("k") == top).select("item", F.col("score").alias("last"))
        judged = state.join(last, "item", "left").withColumn("open", (F.col("bound") > 0) & (F.col("bound") >= F.coalesce("last", F.lit(0)))).drop("last")
        pending = judged.where("open").select("grp", "block", "item")
        closed = judged.where("not open").drop("open")
        settled = closed if settled is None else settled.unionByName(closed)
        if pending.isEmpty():
            break
    found = settled.select("item", "tiers", F.explode("found").alias("x")).select("item", "tiers", "x.*")
    place = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    depth = settled.groupBy("item").agg(F.max("tiers").alias("tiers"))
    ranked = found.drop("tiers").withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).join(depth, "item")
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc") != F.lit(NULL_ID), F.col("doc")).alias("doc_id"), "score", "tiers")


def op11_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): the 20 best documents of each item."""
    return search(build_index(docs), items).drop("tiers")
