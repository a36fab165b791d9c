"""Benchmark decontamination with an Aho-Corasick automaton over normalised windows.

A text is normalised to its words: A-Z lower-cased, words are runs of ASCII letters,
digits and non-ASCII characters, one space between them. The automaton holds every
window of ``window`` consecutive words of a benchmark item, as a sequence of the words' numbers;
an item with fewer words is one window. A document's normalised text is scanned once;
matches are mapped back to offsets in the original.

There is one automaton, built in each Python worker. Over word numbers it has one node a word
of a window, about a sixth of one over characters, so that ``BLOCK_WORDS`` words of a benchmark fit
in a worker. Only a benchmark beyond that is searched for in several scans, whose hits are
united by document, so no size is cut off.

Defined results: a null or empty text has no words; items without words match nothing;
very long texts are scanned whole; equal items all count; items without an id are searched for like others, count together as
one in n_items and have no part in items_sha256; rows with the same id are scanned apart; empty tables give no
rows or no hits; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import materialise, ship_code, slices, utf8

WINDOW = 10
#: Benchmark words in one automaton at most.
BLOCK_WORDS = 1_000_000

_letters = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_fold = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_built: dict[str, tuple] = {}


def words_of(raw: bytes) -> list[bytes]:
    """The normalised words of UTF-8 text."""
    return raw.translate(_fold).split()


def automaton(items: list[tuple[str | None, bytes]], window: int):
    """The automaton, None if nothing is to be found, the items of each window and the words' numbers."""
    import ahocorasick

    where: dict[tuple[int, ...], set[int]] = {}
    number: dict[bytes, int] = {}
    for k, (_, raw) in enumerate(items):
        words = tuple(number.setdefault(w, len(number) + 1) for w in words_of(raw))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            where.setdefault(words[i : i + window], set()).add(k)
    made = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for n, w in enumerate(where):
        made.add_word(w, (n, len(w)))
    if where:
        made.make_automaton()
    return (made if where else None), [sorted(x) for x in where.values()], number


def _automaton_of(items: list[tuple[str | None, bytes]], window: int):
    """The last one built in this worker, or a new one."""
    tag = hashlib.sha256(repr((items, window)).encode()).hexdigest()
    if tag not in _built:
        _built.clear()
        _built[tag] = automaton(items, window)
    return _built[tag]


def _scan(batches: Iterator[pa.RecordBatch], items: list[tuple[str | None, bytes]], window: int) -> Iterator[pa.RecordBatch]:
    found, of_window, number = _automaton_of(items, window)
    names = [i for i, _ in items]
    for batch in slices(batches):
        rows: dict[str, list] = {"n_words": [], "first": [], "last": [], "start": [], "end": [], "items": []}
        for raw in utf8(batch.column(1)):
            words = words_of(raw)
            spans, got = [], set()
            if found is not None and words:
                for end, (n, size) in found.iter(tuple(map(number.get, words, repeat(0)))):
                    got.add(n)
                    begin = end - size + 1
                    # spans of words, last exclusive; they come by their ends
                    while spans and begin <= spans[-1][1] and begin < spans[-1][0]:
                        begin = min(begin, spans.pop()[0])
                    if spans and begin <= spans[-1][1] - 1:
                        spans[-1][1] = end + 1
                    else:
                        spans.append([begin, end + 1])
            first, last, start, stop = [], [], [], []
            if spans:
                places = [m.span() for m in _letters.finditer(raw)]
                points = np.cumsum([0] + [(c & 0xC0) != 0x80 for c in raw]) if not raw.isascii() else None
                for i, j in spans:
                    first.append(i)
                    last.append(j)
                    x, y = places[i][0], places[j - 1][1]
                    start.append(x if points is None else int(points[x]))
                    stop.append(y if points is None else int(points[y]))
            rows["n_words"].append(len(words))
            for k, v in (("first", first), ("last", last), ("start", start), ("end", stop)):
                rows[k].append(v)
            rows["items"].append(sorted({names[k] for n in got for k in of_window[n]}, key=lambda x: (x is None, x or "")))
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows["n_words"], pa.int64()), *(pa.array(rows[k], longs) for k in ("first", "last", "start", "end")), pa.array(rows["items"], pa.list_(pa.string()))], ["doc_id", *rows])


def _blocks(items: DataFrame, block_words: int) -> list[list[tuple[str | None, bytes]]]:
    """The items by blocks of bounded size: one, or as many as it takes."""
    sized = items.select("item", "text", F.length("text").alias("n"))
    total = sized.agg(F.sum("n")).first()[0] or 0
    if total <= 4 * block_words:
        return [[(r["item"], r["text"].encode()) for r in sized.collect()]]
    n = -(-total // (2 * block_words))
    cut = sized.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    return [[(r["item"], r["text"].encode()) for r in cut.where(F.col("block") == b).collect()] for b in range(n)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each document's n_words, hit spans as words (first, last exclusive) and as code points
    of the original text (start, end exclusive), and the ids of the items that occur."""
    ship_code(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(item_text_col, F.lit("")).alias("text"))
    schema = f"doc_id {own.schema[0].dataType.simpleString()}, n_words long, first array<long>, last array<long>, start array<long>, end array<long>, items array<string>"
    blocks = _blocks(items, block_words)
    if len(blocks) == 1:
        return own.mapInArrow(partial(_scan, items=blocks[0], window=window), schema)
    # several automata: rows get a number so that equal ids stay apart, and their spans are united
    # written first, so that every scan has the same numbers
    own = materialise(own.withColumn("doc_id", F.struct("doc_id", F.monotonically_increasing_id().alias("row"))), "numbered")
    wide = schema.replace(schema.split(",")[0], f"doc_id {own.schema['doc_id'].dataType.simpleString()}")
    all_ = None
    for b in blocks:
        part = own.mapInArrow(partial(_scan, items=b, window=window), wide)
        all_ = part if all_ is None else all_.unionByName(part)
    hits = all_.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list(F.arrays_zip("first", "last", "start", "end"))).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    join = F.expr("""aggregate(array_sort(s), cast(array() as array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>), (a, x) -> case when size(a) > 0 and x.first < element_at(a, -1).last
        then concat(slice(a, 1, size(a) - 1), array(named_struct('first', element_at(a, -1).first, 'last', greatest(element_at(a, -1).last, x.last), 'start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end))))
        else concat(a, array(x)) end)""")
    united = hits.withColumn("s", join)
    return united.select(F.col("doc_id.doc_id").alias("doc_id"), "n_words", *(F.col(f"s.{k}").alias(k) for k in ("first", "last", "start", "end")), "items")


def op6_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    n_hit = F.expr("aggregate(zip_with(first, last, (a, b) -> b - a), 0L, (s, x) -> s + x)")
    found = find_contamination(docs, benchmark)
    ids = F.array_sort("items")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _clean(batches: Iterator[pa.RecordBatch], text_at: int, items: list[tuple[str | None, bytes]], window: int) -> Iterator[pa.RecordBatch]:
    found, _, number = _automaton_of(items, window)
    for batch in slices(batches):
        if found is not None:
            texts = (tuple(map(number.get, words_of(raw), repeat(0))) for raw in utf8(batch.column(text_at)))
            batch = batch.filter(pa.array([not t or next(found.iter(t), None) is None for t in texts], pa.bool_()))
        yield batch


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents in which no window of an item occurs, all their columns, without a shuffle."""
    ship_code(docs.sparkSession)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(item_text_col, F.lit("")).alias("text"))
    for block in _blocks(items, block_words):
        docs = docs.mapInArrow(partial(_clean, text_at=docs.columns.index(text_col), items=block, window=window), docs.schema)
    return docs
