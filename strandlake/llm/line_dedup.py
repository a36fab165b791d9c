"""Reversible line dedup: sharded cuckoo filters over exact reference-count tables.

The index is a folder in shared storage with three tables, a new version for each change:

    postings  (h1, h2, doc): each document's distinct line keys, as 128-bit hashes
    refs      (h1, h2, refs, first, last): documents that hold a key, exactly
    filters   (data, shard): cuckoo filters of the keys in two documents or more

A line goes if its key is in two documents or more and the document isn't the first
(smallest id). The filters settle most lines without the reference counts: what they
lack is in one document only. What they may hold is looked up exactly, so their false
positives change nothing. Insertions add to the counts, deletions of documents take
from them, keys that become shared or unshared enter or leave the filters, and a line
comes back to the next document when its first holder is deleted.

Filters go to the executors as a broadcast while their measured size is below
``FILTER_BYTES``; beyond it, postings are dealt out by shard (a shard's by a hash of the document too, so that
a hot line's are split) and each task reads the filters of its own shards from the folder.

Each version ends with a manifest; an index is opened again by its folder, at its latest whole version. The
number of shards grows with the shared keys.

Defined results: a null or empty text is one empty line; rows without an id are one
document that comes last; rows with the same id are one document, and a line only they
share stays, and they count as one reference; an empty table gives an empty index and no rows; very long
texts are taken whole. Of other columns nothing is used; ``apply`` passes them on, whatever their names, but its own
result columns replace any of the same name. The id has to be a number or a text that is one.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import cuckoo
from strandlake.llm.runtime import doc_key, scratch_path, ship_code, slices, utf8

#: What a strip removes from both ends of a line.
BLANKS = b" \t\n\x0b\x0c\r"
MIN_POINTS = 10
#: Keys in a filter shard, about; bytes of filters that are broadcast, at most.
SHARD_KEYS = 1 << 17
FILTER_BYTES = 64 << 20

KEY = ["h1", "h2"]


def line_keys(lines: list[bytes], min_points: int = MIN_POINTS) -> list[bytes | None]:
    """The 128-bit hash of each line's key; None: the key is too short to count."""
    out: list[bytes | None] = []
    digest = xxhash.xxh3_128_digest
    for line in lines:
        k = line.strip(BLANKS)
        n = len(k)
        if n < min_points or n < 4 * min_points and not k.isascii() and len(k.decode("utf-8", "replace")) < min_points:
            out.append(None)
        else:
            out.append(digest(k.lower()))  # bytes.lower() changes A-Z only
    return out


def _postings(batches: Iterator[pa.RecordBatch], min_points: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found, docs, counts = [], batch.column(0).to_numpy(), []
        for text in utf8(batch.column(1)):
            keys = {k for k in line_keys(text.split(b"\n"), min_points) if k}
            found.extend(keys)
            counts.append(len(keys))
        h = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(np.repeat(docs, counts))], [*KEY, "doc"])


def _build_filter(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "data": [cuckoo.build(pdf["h1"].to_numpy().view(np.uint64)).dumps()]})


def _change_filter(key, old: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
    """The shard's filter without the keys that left and with those that entered; no data: it is full."""
    has = cuckoo.CuckooFilter.loads(old["data"].iloc[0]) if len(old) else cuckoo.CuckooFilter(4)
    entered = change["entered"].to_numpy(dtype=bool)
    h = change["h1"].to_numpy(dtype=np.int64).view(np.uint64)
    has.remove(h[~entered])
    return pd.DataFrame({"shard": [int(key[0])], "data": [has.dumps() if has.add(h[entered]) else None]})


def _shard(n: int):
    return F.pmod(F.xxhash64("h2"), F.lit(n))


def _probe(batches: Iterator[pa.RecordBatch], filters, shards: int) -> Iterator[pa.RecordBatch]:
    """Only postings whose key may be shared."""
    loaded = {s: cuckoo.CuckooFilter.loads(d) for s, d in filters.value.items()}
    for batch in batches:
        shard = batch.column(3).to_numpy()
        h = batch.column(0).to_numpy().view(np.uint64)
        keep = np.zeros(len(h), dtype=bool)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            at = order[cuts[s] : cuts[s + 1]]
            if len(at) and s in loaded:
                keep[at] = loaded[s].probe(h[at])
        yield batch.filter(pa.array(keep)).select([0, 1, 2])


def _probe_stored(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """The same for postings that come sorted by shard, with one filter at a time, read from its folder."""
    from pyarrow import fs
    from pyarrow import parquet as pq

    store, root = fs.FileSystem.from_uri(folder)
    now, held = None, None
    for batch in batches:
        shard = batch.column(3).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi == lo:
                continue
            if shard[lo] != now:
                now, held = shard[lo], None
                for f in store.get_file_info(fs.FileSelector(f"{root}/shard={now}", allow_not_found=True)):
                    if f.path.endswith(".parquet"):
                        for data in pq.read_table(f.path, filesystem=store, partitioning=None).column("data").to_pylist():
                            held = cuckoo.CuckooFilter.loads(data)
            if held is not None:
                part = batch.slice(lo, hi - lo)
                yield part.filter(pa.array(held.probe(part.column(0).to_numpy().view(np.uint64)))).select([0, 1, 2])


def _drop(batches: Iterator[pa.RecordBatch], text_at: int, keys_at: int, min_points: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            total, dropped, kept = [], [], []
            for text, gone in zip(utf8(part.column(text_at)), part.column(keys_at).to_pylist()):
                if gone is None:
                    total.append(text.count(b"\n") + 1)
                    dropped.append(0)
                    kept.append(text)
                else:
                    lines = text.split(b"\n")
                    gone = {struct.pack("<qq", k["h1"], k["h2"]) for k in gone}
                    stay = [x for x, k in zip(lines, line_keys(lines, min_points)) if k not in gone]
                    total.append(len(lines))
                    dropped.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay))
            columns = [c for i, c in enumerate(part.columns) if i != keys_at]
            sha = [hashlib.sha256(x).hexdigest() for x in kept]
            kept = pa.array(kept, pa.binary()).cast(pa.string())
            names = [n for i, n in enumerate(part.schema.names) if i != keys_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), kept, pa.array(sha)], [*names, "n_lines", "n_dropped", "kept_text", "kept_sha256"])


class LineIndex:
    """The index in a folder; each change writes a new version and leaves the old one as it was."""

    def __init__(self, spark: SparkSession, folder: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", min_points: int = MIN_POINTS):
        ship_code(spark)
        self.spark, self.folder = spark, folder or scratch_path(spark, "lines")
        self.id_col, self.text_col, self.min_points = id_col, text_col, min_points
        self.version, self.shards = self._latest()

    def _latest(self) -> tuple[int, int]:
        """The last version with a manifest, and its shards."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.folder)
        store = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(where):
            return 0, 1
        names = [s.getPath().getName() for s in store.listStatus(where)]
        for n in sorted((int(x[1:]) for x in names if x[:1] == "v" and x[1:].isdigit()), reverse=True):
            if store.exists(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/v{n}/manifest/_SUCCESS")):
                return n, self.spark.read.schema("shards long").json(f"{self.folder}/v{n}/manifest").first()["shards"]
        return 0, 1

    def _done(self) -> None:
        """The version that was written is whole."""
        self.version += 1
        self.spark.range(1).select(F.lit(self.shards).cast("long").alias("shards")).write.mode("overwrite").json(f"{self.folder}/v{self.version}/manifest")

    def _table(self, name: str, schema: str, version: int | None = None) -> DataFrame:
        version = self.version if version is None else version
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/v{version}/{name}")

    @property
    def postings(self) -> DataFrame:
        return self._table("postings", "h1 long, h2 long, doc long")

    @property
    def refs(self) -> DataFrame:
        return self._table("refs", "h1 long, h2 long, refs long, first long, last long")

    @property
    def filters(self) -> DataFrame:
        return self._table("filters", "data binary, shard long").select("shard", "data")

    def _keys_of(self, docs: DataFrame) -> DataFrame:
        own = docs.select(doc_key(self.id_col).alias("doc"), F.col(self.text_col).alias("text"))
        keys = lambda df: df.select("doc", "text").mapInArrow(partial(_postings, min_points=self.min_points), "h1 long, h2 long, doc long")
        again = own.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc")
        if again.isEmpty():
            return keys(own)
        # documents of several rows count once for a key
        return keys(own.join(again, "doc", "left_anti")).unionByName(keys(own.join(again, "doc", "left_semi")).distinct())

    def _fit(self, shared: int) -> bool:
        """Whether there have to be more shards for so many shared keys."""
        want = max(16, 1 << max(0, shared // SHARD_KEYS).bit_length())
        grown, self.shards = want > self.shards, max(want, self.shards)
        return grown

    def _build(self, refs: DataFrame, to: str) -> None:
        shared = refs.where("first < last").select("h1", _shard(self.shards).alias("shard"))
        self._put(shared.groupBy("shard").applyInPandas(_build_filter, "shard long, data binary"), to)

    @staticmethod
    def _put(filters: DataFrame, to: str) -> None:
        filters.write.mode("overwrite").partitionBy("shard").parquet(f"{to}/filters")

    @staticmethod
    def _counted(postings: DataFrame) -> DataFrame:
        return postings.groupBy(*KEY).agg(F.count(F.lit(1)).alias("refs"), F.min("doc").alias("first"), F.max("doc").alias("last"))

    def insert(self, docs: DataFrame) -> None:
        """Adds documents that aren't in the index."""
        to = f"{self.folder}/v{self.version + 1}"
        if not self.version:
            self._keys_of(docs).write.mode("overwrite").parquet(f"{to}/postings")
            added = self._table("postings", "h1 long, h2 long, doc long", 1)
            self._counted(added).write.mode("overwrite").parquet(f"{to}/refs")
            refs = self._table("refs", "h1 long, h2 long, refs long, first long, last long", 1)
            self._fit(refs.where("first < last").count())
            self._build(refs, to)
            self._done()
            return
        self._keys_of(docs).write.mode("overwrite").parquet(f"{to}/added")
        added = self._table("added", "h1 long, h2 long, doc long", self.version + 1)
        old, new = self.refs, self._counted(added).toDF(*KEY, "n", "a", "b")
        merged = old.join(new, KEY, "full").select(
            *KEY, (F.coalesce("refs", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("refs"), F.least("first", "a").alias("first"), F.greatest("last", "b").alias("last"),
            F.coalesce(F.col("first") < F.col("last"), F.lit(False)).alias("was"), F.col("n").isNotNull().alias("touched"),
        )
        self._change(self.postings.unionByName(added), merged, to)

    def delete(self, ids: DataFrame) -> None:
        """Takes documents out, given by id (a table with the id column)."""
        to = f"{self.folder}/v{self.version + 1}"
        gone = ids.select(doc_key(self.id_col).alias("doc")).distinct()
        left, taken = self.postings.join(gone, "doc", "left_anti"), self.postings.join(gone, "doc", "left_semi")
        touched = self._counted(taken).select(*KEY, F.col("refs").alias("n"))
        again = self._counted(left.join(touched.select(*KEY), KEY, "left_semi")).toDF(*KEY, "left", "a", "b")
        old = self.refs.join(touched, KEY, "left").join(again, KEY, "left")
        hit = F.col("n").isNotNull()
        merged = old.select(
            *KEY, (F.col("refs") - F.coalesce("n", F.lit(0))).alias("refs"), F.when(hit, F.col("a")).otherwise(F.col("first")).alias("first"), F.when(hit, F.col("b")).otherwise(F.col("last")).alias("last"),
            (F.col("first") < F.col("last")).alias("was"), hit.alias("touched"),
        )
        self._change(left.select("h1", "h2", "doc"), merged, to)

    def _change(self, postings: DataFrame, merged: DataFrame, to: str) -> None:
        merged.write.mode("overwrite").parquet(f"{to}/merged")
        merged = self.spark.read.schema(merged.schema).parquet(f"{to}/merged")
        postings.write.mode("overwrite").parquet(f"{to}/postings")
        merged.where("refs > 0").select(*KEY, "refs", "first", "last").write.mode("overwrite").parquet(f"{to}/refs")
        refs = self._table("refs", "h1 long, h2 long, refs long, first long, last long", self.version + 1)
        if self._fit(refs.where("first < last").count()):
            self._build(refs, to)
            self._done()
            return
        now = F.coalesce(F.col("first") < F.col("last"), F.lit(False)) & (F.col("refs") > 0)
        change = merged.where("touched").where(now != F.col("was")).select("h1", _shard(self.shards).alias("shard"), now.alias("entered"))
        self.filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(_change_filter, "shard long, data binary").write.mode("overwrite").parquet(f"{to}/changed")
        changed = self._table("changed", "shard long, data binary", self.version + 1)
        full = changed.where("data is null").select("shard")
        shared = refs.where("first < last").select("h1", _shard(self.shards).alias("shard"))
        built = shared.join(full, "shard", "left_semi").groupBy("shard").applyInPandas(_build_filter, "shard long, data binary")
        self._put(changed.where("data is not null").unionByName(built), to)
        self._done()

    def drops(self, filter_bytes: int = FILTER_BYTES) -> DataFrame:
        """(doc, keys): documents that lose lines and the hashes of the keys they lose."""
        shared = self.refs.where("first < last").select(*KEY, "first")
        sharded = self.postings.withColumn("shard", _shard(self.shards))
        size = self.filters.agg(F.sum(F.length("data"))).first()[0] or 0
        if size <= filter_bytes:
            held = {r["shard"]: bytes(r["data"]) for r in self.filters.collect()}
            sent = self.spark.sparkContext.broadcast(held)
            postings = sharded.mapInArrow(partial(_probe, filters=sent, shards=self.shards), "h1 long, h2 long, doc long")
        else:
            salt = F.pmod(F.xxhash64("doc"), F.lit(max(16, self.spark.sparkContext.defaultParallelism)))
            dealt = sharded.repartition("shard", salt).sortWithinPartitions("shard")
            postings = dealt.mapInArrow(partial(_probe_stored, folder=f"{self.folder}/v{self.version}/filters"), "h1 long, h2 long, doc long")
        gone = postings.join(shared, KEY).where(F.col("doc") > F.col("first"))
        return gone.groupBy("doc").agg(F.collect_set(F.struct(*KEY)).alias("keys"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """The documents with n_lines, n_dropped, kept_text and kept_sha256."""
        own = {"n_lines", "n_dropped", "kept_text", "kept_sha256"}
        passed = docs.select([F.col(f"`{c}`") for c in docs.columns if c not in own])
        drops = self.drops().select(F.col("doc").alias("doc"), F.col("keys").alias("keys"))
        held = passed.select(F.struct("*").alias("row"), doc_key(self.id_col).alias("doc"))
        flat = [F.col("row")[c].alias(c) for c in passed.columns]
        joined = held.join(drops, "doc", "left").select(*flat, F.col("keys").alias(_free("keys", passed.columns)))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in passed.schema.fields)
        return joined.mapInArrow(partial(_drop, text_at=passed.columns.index(self.text_col), keys_at=len(passed.columns), min_points=self.min_points), f"{schema}, n_lines long, n_dropped long, kept_text string, kept_sha256 string")


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """Indexes the documents and drops repeated lines from them."""
    index = LineIndex(docs.sparkSession, **options)
    index.insert(docs)
    return index.apply(docs)


def op3_line_dedup(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
