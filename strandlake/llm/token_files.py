"""Token ids in binary files: blocks of ids as compressed byte planes, with a chunk index.

A shard file holds the ids of consecutive documents, in ascending id order:

    magic "SLBP0001"
    chunks: each the planes of up to CHUNK_IDS ids, one zstandard frame a plane
    documents: zstandard frames of ids (int64), known flags (uint8), lengths (int64)
    footer: JSON with the chunk index and the places of the above
    footer length (uint32) and the magic again

Plane p of a chunk is byte p of every id (``bits=False``) or bit p of every id, eight
ids to a byte (``bits=True``). Planes without a set bit take no room but an index entry.
A shard is written under a name of its own and then renamed, so that a lost executor
leaves no half-written shard behind; a second attempt writes the same bytes.

Defined results: a null or empty text is the end id alone; rows without an id come
first; rows with the same id stay neighbours, ordered by a hash of their text; an empty
table gives no files; very long texts are encoded whole; columns besides the id and the text are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
from array import array
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.llm.runtime import scratch_path, ship_code
from strandlake.llm.tokens import encoder

MAGIC = b"SLBP0001"
CHUNK_IDS = 1 << 16
#: Documents that a task reads from a shard at a time.
READ_DOCS = 4096


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of 32-bit ids, lowest first, each compressed; empty: no set bit there."""
    cells = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    planes = [cells[:, p] for p in range(4)]
    if bits:
        planes = [np.packbits((c >> b) & 1) for c in planes for b in range(8)]
    zip_ = zstandard.ZstdCompressor(level=1)
    return [zip_.compress(np.ascontiguousarray(p).tobytes()) if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """The inverse of :func:`to_planes`."""
    unzip = zstandard.ZstdDecompressor()
    cells = np.zeros((n, 4), dtype=np.uint8)
    for p, data in enumerate(planes):
        if data:
            plane = np.frombuffer(unzip.decompress(data), np.uint8)
            if bits:
                cells[:, p // 8] |= np.unpackbits(plane, count=n) << (p % 8)
            else:
                cells[:, p] = plane
    return cells.reshape(-1).view("<u4")


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


class ShardWriter:
    """Takes documents' ids and writes one shard."""

    def __init__(self, folder: str, name: str, bits: bool):
        self.store, root = _open(folder)
        self.final = f"{root}/{name}"
        self.own = f"{root}/_{uuid.uuid4().hex}-{name}"
        self.bits, self.name = bits, name
        self.out = self.store.open_output_stream(self.own)
        self.out.write(MAGIC)
        self.at, self.chunks = len(MAGIC), []
        self.held, self.n_held = [], 0
        self.docs, self.known, self.lengths = array("q"), array("B"), array("q")

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= 16 * CHUNK_IDS:
            self._flush(False)

    def _put(self, data: bytes) -> list[int]:
        self.out.write(data)
        self.at += len(data)
        return [self.at - len(data), len(data)]

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u2")
        n = len(ids) if last else len(ids) // CHUNK_IDS * CHUNK_IDS
        for lo in range(0, n, CHUNK_IDS):
            block = ids[lo : min(lo + CHUNK_IDS, n)]
            planes = to_planes(block, self.bits)
            self.chunks.append([len(block), self.at, *map(len, planes)])
            self._put(b"".join(planes))
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> dict:
        """Ends the file and puts it in its place."""
        self._flush(True)
        z = zstandard.ZstdCompressor(level=1)
        tables = {k: self._put(z.compress(getattr(self, k).tobytes())) for k in ("docs", "known", "lengths")}
        n_ids = sum(self.lengths)
        foot = json.dumps({"bits": self.bits, "chunk_ids": CHUNK_IDS, "n_docs": len(self.docs), "n_ids": n_ids, "chunks": self.chunks, **tables}).encode()
        self.out.write(foot + struct.pack("<I", len(foot)) + MAGIC)
        self.out.close()
        try:
            self.store.move(self.own, self.final)
        except OSError:  # another attempt was first, with the same bytes
            if self.store.get_file_info(self.final).type.name != "File":
                raise
            self.store.delete_file(self.own)
        return {"n_docs": len(self.docs), "n_ids": n_ids}


class ShardReader:
    """Random access to a shard by its chunk index."""

    def __init__(self, folder: str, name: str):
        store, root = _open(folder)
        self.file = store.open_input_file(f"{root}/{name}")
        size = self.file.size()
        tail = self._read(size - 12, 12)
        if tail[4:] != MAGIC or self._read(0, 8) != MAGIC:
            raise ValueError(f"{name} isn't a shard")
        n = struct.unpack("<I", tail[:4])[0]
        self.foot = json.loads(self._read(size - 12 - n, n))
        unzip = zstandard.ZstdDecompressor()
        part = lambda k, kind: np.frombuffer(unzip.decompress(self._read(*self.foot[k])), kind)
        self.docs, self.known, self.lengths = part("docs", "<i8"), part("known", "u1"), part("lengths", "<i8")
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def _read(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def chunk(self, k: int) -> np.ndarray:
        n, at, *sizes = self.foot["chunks"][k]
        data, ends = self._read(at, sum(sizes)), [0, *accumulate(sizes)]
        return from_planes([data[a:b] for a, b in zip(ends, ends[1:])], n, self.foot["bits"])

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids from first up to last, by their place in the shard."""
        if last <= first:
            return np.zeros(0, "<u4")
        k = first // self.foot["chunk_ids"]
        got = np.concatenate([self.chunk(i) for i in range(k, (last - 1) // self.foot["chunk_ids"] + 1)])
        return got[first - k * self.foot["chunk_ids"] : last - k * self.foot["chunk_ids"]]


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, leading_space: bool, end_id: int, bits: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    writer, shard = None, TaskContext.get().partitionId()
    encode = encoder(tokenizer, leading_space)
    end = array("H", [end_id]).tobytes()
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            writer = writer or ShardWriter(folder, f"shard-{shard:08d}.slbp", bits)
            for doc_id, ids in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()])):
                writer.add(doc_id, np.frombuffer(ids + end, "<u2"))
    if writer:
        said = writer.close()
        yield pa.RecordBatch.from_pylist([{"shard": shard, "name": writer.name, "n_docs": said["n_docs"], "n_ids": said["n_ids"]}], schema=pa.schema([("shard", pa.int64()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))


def write_ids(docs: DataFrame, folder: str, tokenizer: str, *, leading_space: bool = True, end_id: int = 0, bits: bool = False, id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Writes the shards; returns the manifest: shard, name, n_docs, n_ids and start, in order.

    The manifest has a row for each shard, not for each document.
    """
    spark = docs.sparkSession
    ship_code(spark)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    dealt = own.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    wrote = dealt.mapInArrow(partial(_write, folder=folder, tokenizer=tokenizer, leading_space=leading_space, end_id=end_id, bits=bits), "shard long, name string, n_docs long, n_ids long")
    shards = sorted((r.asDict() for r in wrote.collect()), key=lambda r: r["shard"])
    start = 0
    for r in shards:
        r["start"] = start
        start += r["n_ids"]
    return shards


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = ShardReader(folder, row["name"])
            lo = row["first_doc"]
            hi = min(lo + row["docs"], len(shard.docs))
            while lo < hi:  # a bounded number of ids at a time
                to = max(lo + 1, min(hi, int(np.searchsorted(shard.starts, shard.starts[lo] + 32 * CHUNK_IDS))))
                ids = shard.ids(int(shard.starts[lo]), int(shard.starts[to]))
                cut = (shard.starts[lo : to + 1] - shard.starts[lo]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.docs[lo:to], pa.int64(), mask=shard.known[lo:to] == 0),
                        pa.array(shard.starts[lo:to] + row["start"], pa.int64()),
                        pa.array(shard.lengths[lo:to], pa.int64()),
                        pa.array([ids[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )
                lo = to


def read_ids(spark: SparkSession, folder: str, shards: list[dict], *, read_docs: int = READ_DOCS) -> DataFrame:
    """Documents from shards: doc_id, start (ids of all documents before it), n_tokens and ids
    (little-endian unsigned 32-bit). A task opens a shard and decodes only its own chunks."""
    ship_code(spark)
    rows = [(r["name"], r["start"], r["n_docs"]) for r in shards if r["n_docs"]]
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("start", T.LongType()), T.StructField("n_docs", T.LongType())])
    plan = spark.createDataFrame(rows, schema).select("name", "start", F.explode(F.expr(f"sequence(0L, n_docs - 1, {read_docs}L)")).alias("first_doc"), F.lit(read_docs).cast("long").alias("docs"))
    if rows:
        plan = plan.repartition(min(sum(-(-r[2] // read_docs) for r in rows), 8 * spark.sparkContext.defaultParallelism))
    return plan.mapInArrow(partial(_read, folder=folder), "doc_id long, start long, n_tokens long, ids binary")


def op2_token_ids(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes all documents' ids, reads the files back and digests what they hold."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "ids")
    shards = write_ids(docs, folder, tokenizer)
    return read_ids(spark, folder, shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
