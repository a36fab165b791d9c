"""BAM files as a Spark source and sink.

A file is read in splits. A split begins at the first compressed block after its first byte, and there at the first place from which
several whole records follow each other; it has the records that begin in its blocks, and reads on to the end of the last one. So splits
need no index. Where a file has an index, a region's blocks alone are read: the region's chunks and the linear index
tell the compressed bytes, which are split in turn.

The sink writes a file for each task, or for each value of a column in it. In coordinate order (:func:`write_sorted`) tasks hold ranges of places, and
each file has its index, and the table of files and ranges tells which files a region needs.

Places count from 1, as in the text form; the index has them from 0. Files are opened through Arrow's file systems.
"""

from __future__ import annotations

import json
import struct
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, InputPartition, WriterCommitMessage

#: The module goes to the workers by value, whatever folder the driver was started in.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "read_id string, flag int, contig string, pos long, mapq int, cigar string, seq string, qual string, CB string, UB string"
TAGS = ("CB", "UB")
#: Fixed values of the format: the codes of bases and of CIGAR operations, the last block of a file.
BASES = "=ACMGRSVTWYHKDBN"
OPERATIONS = "MIDNSHP=X"
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Bytes of a block before compression, of a window of the linear index, and of a split.
BLOCK, WINDOW, SPLIT = 65280, 1 << 14, 32 << 20
#: Records that have to follow each other at a place for it to be taken for a record's.
CHAIN = 5
BATCH = 5000


# -- blocks


def open_file(path: str, mode: str = "r"):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    system, inner = fs.FileSystem.from_uri(path)
    if mode == "w":
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        return system.open_output_stream(inner, compression=None)
    return system.open_input_file(inner)


def block_size(head: bytes) -> int | None:
    """The size that a block's first 18 bytes tell, if they are such."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04" or head[12:16] != b"BC\x02\x00":
        return None
    return struct.unpack_from("<H", head, 16)[0] + 1


def first_block(file, start: int, size: int) -> int:
    """Where the first block from ``start`` on begins; the file's size if none does."""
    if start == 0:
        return 0
    file.seek(start)
    held = file.read(2 * 65536 + 18)
    at = held.find(b"\x1f\x8b\x08\x04")
    while at >= 0:
        n = block_size(held[at : at + 18])
        if n and (start + at + n == size or block_size(held[at + n : at + n + 18])):
            return start + at
        at = held.find(b"\x1f\x8b\x08\x04", at + 1)
    return size


def blocks(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of the blocks from ``at`` on, decompressed."""
    while at < size:
        file.seek(at)
        n = block_size(file.read(18))
        if not n:
            raise ValueError(f"no block at byte {at}")
        file.seek(at)
        raw = file.read(n)
        yield at, zlib.decompress(raw[18:-8], -15)
        at += n


class Stream:
    """Bytes from a block on, read as they are needed; ``own`` are those of blocks before ``end``."""

    def __init__(self, file, at: int, end: int, size: int):
        self.blocks, self.end, self.data, self.done, self.own, self.read = blocks(file, at, size), end, b"", 0, 0, 0

    def more(self) -> bool:
        for at, data in self.blocks:
            self.read += 1
            self.data += data
            self.own += len(data) if at < self.end else 0
            return True
        return False

    def need(self, n: int) -> bool:
        """Whether ``n`` bytes from the current place are there."""
        while len(self.data) - self.done < n:
            if self.done > 1 << 20:
                self.data, self.own, self.done = self.data[self.done :], self.own - self.done, 0
            if not self.more():
                return False
        return True


# -- records


def header(file, size: int) -> tuple[str, list[tuple[str, int]], tuple[int, int]]:
    """The header's text, the contigs with their lengths, and the block and place in it of the first record."""
    stream, starts = Stream(file, 0, size, size), []
    parts = []
    for at, data in stream.blocks:
        starts.append((at, sum(map(len, parts))))
        parts.append(data)
        whole = b"".join(parts)
        try:
            if whole[:4] != b"BAM\1":
                raise ValueError("not a BAM file")
            n = struct.unpack_from("<i", whole, 4)[0]
            text, place = whole[8 : 8 + n].decode().rstrip("\0"), 12 + n
            contigs = []
            for _ in range(struct.unpack_from("<i", whole, 8 + n)[0]):
                k = struct.unpack_from("<i", whole, place)[0]
                contigs.append((whole[place + 4 : place + 3 + k].decode(), struct.unpack_from("<i", whole, place + 4 + k)[0]))
                place += 8 + k
            if place <= len(whole):
                block, before = [(b, s) for b, s in starts if s <= place][-1]
                return text, contigs, (block, place - before)
        except struct.error:
            continue
    raise ValueError("a BAM file without a whole header")


def plausible(data: bytes, at: int, n_contigs: int) -> int | None:
    """The size of what may be a record at this place; None if it can't be one, 0 if more bytes are needed to tell."""
    if at + 36 > len(data):
        return 0
    size, ref, pos, n_name, _, _, n_cigar, _, n_seq, next_ref, next_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (32 <= size < 1 << 29 and -1 <= ref < n_contigs and -1 <= next_ref < n_contigs and pos >= -1 and next_pos >= -1 and n_name >= 1 and n_seq >= 0):
        return None
    if 32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq > size:
        return None
    if at + 36 + n_name > len(data):
        return 0
    name = data[at + 36 : at + 36 + n_name]
    return 4 + size if name[-1] == 0 and all(33 <= c <= 126 for c in name[:-1]) else None


def first_record(stream: Stream, n_contigs: int) -> bool:
    """Moves the stream to the first place from which records follow each other; False if none begins in its own blocks."""
    if not stream.need(1):
        return False
    at = 0
    while at < stream.own:
        place, found = at, 0
        while found < CHAIN:
            n = plausible(stream.data, place, n_contigs)
            if n == 0 or (n and place + n > len(stream.data)):
                if stream.more():
                    continue
                n = None if n == 0 and place < len(stream.data) else 0
            if n is None:
                break
            if n == 0:  # the file ends here
                found = CHAIN if place == len(stream.data) and found else -1
                break
            place, found = place + n, found + 1
        if found >= CHAIN:
            stream.done = at
            return True
        at += 1
        if at >= stream.own and not (stream.more() and at < stream.own):
            return False
    return False


PAIRS = [BASES[b >> 4] + BASES[b & 15] for b in range(256)]
SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
PHRED = bytes(min(b + 33, 126) for b in range(256))


def tag_values(data: bytes, at: int, end: int, wanted: tuple[str, ...]) -> dict[str, str]:
    found = {}
    while at + 3 <= end:
        name, kind = data[at : at + 2].decode("latin-1"), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            stop = data.index(0, at, end)
            if name in wanted:
                found[name] = data[at:stop].decode()
            at = stop + 1
        elif kind == "B":
            at += 5 + SIZES[chr(data[at])] * struct.unpack_from("<i", data, at + 1)[0]
        else:
            if name in wanted:
                found[name] = chr(data[at]) if kind == "A" else str(struct.unpack_from("<" + {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}[kind], data, at)[0])
            at += SIZES[kind]
    return found


def decode(data: bytes, at: int, contigs: list[tuple[str, int]]) -> tuple:
    size, ref, pos, n_name, mapq, _, n_cigar, flag, n_seq, _, _, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    end, p = at + 4 + size, at + 36
    name = data[p : p + n_name - 1].decode()
    p += n_name
    cigar = "".join(f"{c >> 4}{OPERATIONS[c & 15]}" for c in struct.unpack_from(f"<{n_cigar}I", data, p)) or "*"
    p += 4 * n_cigar
    seq = "".join(map(PAIRS.__getitem__, data[p : p + (n_seq + 1) // 2]))[:n_seq] or "*"
    p += (n_seq + 1) // 2
    raw = data[p : p + n_seq]
    qual = "*" if not raw or raw[0] == 255 else raw.translate(PHRED).decode()
    tags = tag_values(data, p + n_seq, end, TAGS)
    return name, flag, contigs[ref][0] if ref >= 0 else None, pos + 1 if pos >= 0 else None, mapq, cigar, seq, qual, tags.get("CB"), tags.get("UB")


def bin_of(start: int, end: int) -> int:
    """The bin of the index that holds places from ``start`` to ``end`` (exclusive, from 0): the smallest of the sizes 2^14, 2^17, ... 2^29."""
    for level, shift in ((4681, 14), (585, 17), (73, 20), (9, 23), (1, 26)):
        if start >> shift == (end - 1) >> shift:
            return level + (start >> shift)
    return 0


def span(cigar: str) -> int:
    """Places of the contig that an alignment covers, one at least."""
    n = total = 0
    for c in cigar:
        if c.isdigit():
            n = 10 * n + int(c)
        else:
            total, n = total + (n if c in "MDN=X" else 0), 0
    return max(total, 1)


#: Each base as a hexadecimal digit, N for what isn't one, and back; qualities without their offset.
DIGITS = bytes(ord(f"{BASES.find(chr(b)) if chr(b) in BASES else 15:x}") for b in range(256))
SCORES = bytes(max(b - 33, 0) for b in range(256))


def encode(row: dict, numbers: dict[str, int]) -> bytes:
    name, seq = row["read_id"].encode() + b"\0", "" if row["seq"] in (None, "*") else row["seq"]
    cigar, pos = row["cigar"] or "*", (row["pos"] or 0) - 1
    ops, n = [], ""
    for c in "" if cigar == "*" else cigar:
        if c.isdigit():
            n += c
        else:
            ops.append(int(n) << 4 | OPERATIONS.index(c))
            n = ""
    codes = seq.encode("ascii", "replace").translate(DIGITS).decode() + "0" * (len(seq) % 2)
    qual = b"\xff" * len(seq) if row["qual"] in (None, "*") else row["qual"].encode("latin-1")
    if qual[:1] != b"\xff":
        if qual and min(qual) < 33:
            raise ValueError(f"not a quality: {row['qual']!r}")
        qual = qual.translate(SCORES)
    tags = b"".join(t.encode() + b"Z" + row[t].encode() + b"\0" for t in TAGS if row[t] is not None)
    ref = numbers[row["contig"]] if row["contig"] is not None else -1
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), row["mapq"] or 0, bin_of(max(pos, 0), max(pos, 0) + span(cigar)), len(ops), row["flag"], len(seq), -1, -1, 0)
    body += name + struct.pack(f"<{len(ops)}I", *ops) + bytes.fromhex(codes) + qual + tags
    return struct.pack("<i", len(body)) + body


# -- index


def read_index(data: bytes) -> list[tuple[dict[int, list[tuple[int, int]]], list[int]]]:
    """For each contig the chunks (first and last virtual place) of its bins, and the linear index."""
    if data[:4] != b"BAI\1":
        raise ValueError("not an index")
    at, out = 8, []
    for _ in range(struct.unpack_from("<i", data, 4)[0]):
        bins = {}
        n, at = struct.unpack_from("<i", data, at)[0], at + 4
        for _ in range(n):
            number, k = struct.unpack_from("<Ii", data, at)
            v = struct.unpack_from(f"<{2 * k}Q", data, at + 8)
            bins[number] = list(zip(v[::2], v[1::2]))
            at += 8 + 16 * k
        n, at = struct.unpack_from("<i", data, at)[0], at + 4
        out.append((bins, list(struct.unpack_from(f"<{n}Q", data, at))))
        at += 8 * n
    return out


def region_range(index: tuple[dict, list], start: int, end: int) -> tuple[int, int] | None:
    """Virtual places between which all records of the region (from 0, exclusive) lie."""
    bins, linear = index
    wanted = {0} | {level + k for level, shift in ((1, 26), (9, 23), (73, 20), (585, 17), (4681, 14)) for k in range(start >> shift, ((end - 1) >> shift) + 1)} if end - start < 1 << 26 else {b for b in bins if b != 37450}
    least = linear[min(start // WINDOW, len(linear) - 1)] if linear else 0
    chunks = [(max(a, least), b) for number in wanted for a, b in bins.get(number, ()) if b > least]
    return (min(a for a, _ in chunks), max(b for _, b in chunks)) if chunks else None


class Sink:
    """Writes a file's header, records and, if they come in order, its index."""

    def __init__(self, path: str, contigs: list[tuple[str, int]], ordered: bool):
        self.path, self.contigs, self.ordered, self.file = path, contigs, ordered, open_file(path, "w")
        self.numbers = {c: k for k, (c, _) in enumerate(contigs)}
        self.held, self.at, self.n = [], 0, 0
        self.index = [({}, []) for _ in contigs]
        text = "".join([f"@HD\tVN:1.6\tSO:{'coordinate' if ordered else 'unsorted'}\n", *(f"@SQ\tSN:{c}\tLN:{n}\n" for c, n in contigs)]).encode()
        self.put(b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(contigs)) + b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in contigs))
        self.flush()

    def flush(self) -> None:
        data = b"".join(self.held)
        for lo in range(0, len(data), BLOCK):
            part = data[lo : lo + BLOCK]
            packer = zlib.compressobj(6, zlib.DEFLATED, -15)
            packed = packer.compress(part) + packer.flush()
            self.file.write(struct.pack("<4sIBBH4sH", b"\x1f\x8b\x08\x04", 0, 0, 255, 6, b"BC\x02\x00", len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(part), len(part)))
            self.at += len(packed) + 26
        self.held, self.n = [], 0

    def put(self, data: bytes) -> tuple[int, int]:
        """Where the bytes begin and end, as virtual places."""
        if self.n and self.n + len(data) > BLOCK:
            self.flush()
        start = self.at << 16 | self.n
        self.held.append(data)
        self.n += len(data)
        if self.n >= BLOCK:
            self.flush()
        return start, self.at << 16 | self.n

    def write(self, row: dict) -> None:
        start, end = self.put(encode(row, self.numbers))
        if self.ordered and row["contig"] is not None:
            bins, linear = self.index[self.numbers[row["contig"]]]
            first = max((row["pos"] or 1) - 1, 0)
            last = first + span(row["cigar"] or "*")
            chunks = bins.setdefault(bin_of(first, last), [])
            if chunks and chunks[-1][1] >> 16 == start >> 16:
                chunks[-1] = (chunks[-1][0], end)
            else:
                chunks.append((start, end))
            for w in range(len(linear), (last - 1) // WINDOW + 1):
                linear.append(start)

    def close(self) -> None:
        self.flush()
        self.file.write(END)
        self.file.close()
        if self.ordered:
            out = [b"BAI\1", struct.pack("<i", len(self.index))]
            for bins, linear in self.index:
                out.append(struct.pack("<i", len(bins)))
                out += [struct.pack("<Ii", b, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks) for b, chunks in sorted(bins.items())]
                out += [struct.pack("<i", len(linear)), struct.pack(f"<{len(linear)}Q", *linear)]
            with open_file(self.path + ".bai", "w") as f:
                f.write(b"".join(out))


# -- Spark


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int
    size: int
    #: Where the first record is, if that is known; where reading ends.
    first: tuple[int, int] | None
    last: int
    region: tuple[str, int, int] | None


class Reader(DataSourceReader):
    def __init__(self, files: list[list], region: tuple[str, int, int] | None, split: int):
        self.files, self.region, self.split = files, region, split

    def partitions(self) -> list[Split]:
        out = []
        for path, size, index in self.files:
            with open_file(path) as f:
                _, contigs, (block, place) = header(f, size)
            start, end, first, last = block, size, (block, place), size
            if self.region:
                number = next((k for k, (c, _) in enumerate(contigs) if c == self.region[0]), None)
                if number is None:
                    continue
                if index:
                    with open_file(index) as f:
                        found = region_range(read_index(f.read())[number], self.region[1], self.region[2])
                    if found is None:
                        continue
                    start, first, last = found[0] >> 16, (found[0] >> 16, found[0] & 65535), (found[1] >> 16) + 1
                    end = min(size, last)
            cuts = [*range(start, end, self.split), end]
            out += [Split(path, a, b, size, first if a == start else None, last, self.region) for a, b in zip(cuts, cuts[1:])]
        return out

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        if not isinstance(split, Split):  # what Spark reads if there is no split
            return
        schema = pa.schema([("read_id", pa.string()), ("flag", pa.int32()), ("contig", pa.string()), ("pos", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()), ("seq", pa.string()), ("qual", pa.string()), ("CB", pa.string()), ("UB", pa.string())])
        with open_file(split.path) as f:
            _, contigs, _ = header(f, split.size)
            number = next((k for k, (c, _) in enumerate(contigs) if split.region and c == split.region[0]), None)
            at = split.first[0] if split.first else first_block(f, split.start, split.size)
            if at >= split.end:
                return
            stream = Stream(f, at, split.end, split.size)
            if split.first:
                stream.need(split.first[1])
                stream.done = split.first[1]
            elif not first_record(stream, len(contigs)):
                return
            rows = []
            while stream.need(4) and stream.done < stream.own:
                n = 4 + struct.unpack_from("<i", stream.data, stream.done)[0]
                if not stream.need(n):
                    raise ValueError(f"{split.path} ends within a record")
                place = stream.done
                stream.done += n
                if number is not None:
                    ref, pos = struct.unpack_from("<ii", stream.data, place + 4)
                    if ref != number or pos >= split.region[2]:
                        continue
                row = decode(stream.data, place, contigs)
                if number is not None and row[3] - 1 + span(row[5]) <= split.region[1]:
                    continue
                rows.append(row)
                if len(rows) == BATCH:
                    yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


class FilteredReader(Reader):
    """Where Spark offers filters to Python sources: a contig asked for is a region."""

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("contig",) and self.region is None:
                self.region = (f.value, 0, 1 << 29)
            yield f  # the index tells blocks, not records: Spark filters these


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple]


class Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, contigs: list, by: str | None, ordered: bool):
        self.folder, self.contigs, self.by, self.ordered = folder, [tuple(c) for c in contigs], by, ordered

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Rows of a file come together: sorted by the column that names files, and within it by place if they have to be."""
        from pyspark import TaskContext

        task = TaskContext.get()
        tag, sink, key, files = f"{task.partitionId():05d}-{task.taskAttemptId()}", None, None, []
        for batch in iterator:
            for row in batch.to_pylist():
                value = None if self.by is None else str(row[self.by])
                if sink is None or value != key:
                    if sink:
                        sink.close()
                    key, name = value, f"part-{tag}.bam" if value is None else f"{value}/part-{tag}.bam"
                    sink = Sink(f"{self.folder}/{name}", self.contigs, self.ordered)
                    files.append([name, value, row["contig"], row["pos"], row["contig"], row["pos"], 0])
                sink.write(row)
                files[-1][4:] = [row["contig"], row["pos"], files[-1][6] + 1]
        if sink:
            sink.close()
        return Written([tuple(x) for x in files])

    def commit(self, messages: list[Written | None]) -> None:
        """Only files that this list names count; others are left by tasks that failed."""
        with open_file(f"{self.folder}/_files.json", "w") as f:
            f.write(json.dumps([x for m in messages if m for x in m.files]).encode())


class Bam(DataSource):
    """Options: files (JSON of path, size, path of the index or null), region (JSON of contig, first, last), split, filters; for writing path, contigs, by, ordered."""

    @classmethod
    def name(cls) -> str:
        return "strandlake_bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        region = json.loads(self.options.get("region", "null"))
        kind = FilteredReader if self.options.get("filters") == "true" else Reader
        return kind(json.loads(self.options["files"]), tuple(region) if region else None, int(self.options.get("split", SPLIT)))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], json.loads(self.options["contigs"]), self.options.get("by"), self.options.get("ordered") == "true")


def _listed(spark: SparkSession, paths: str | list[str]) -> list[list]:
    """Path, size and index of the BAM files that paths or patterns name; of a folder of the sink those that its list names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for pattern in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or []:
            inner = status.getPath().toString()
            if status.isDirectory():
                out += _listed(spark, [f"{inner}/{x[0]}" for x in written_files(inner)])
            else:
                index = next((i for i in (inner + ".bai", inner.removesuffix(".bam") + ".bai") if fs.exists(jvm.org.apache.hadoop.fs.Path(i))), None)
                out.append([inner, status.getLen(), index])
    return out


def written_files(folder: str) -> list[list]:
    """(name, value of the column, first contig and place, last contig and place, records) of the sink's files."""
    with open_file(folder + "/_files.json") as f:
        return json.loads(f.read())


#: Spark's setting by which Python sources are offered filters.
FILTERS = "spark.sql.python.filterPushdown.enabled"


def read_bam(spark: SparkSession, paths: str | list[str], *, region: tuple[str, int, int] | str | None = None, split: int = SPLIT) -> DataFrame:
    """Records of BAM files; those that overlap a region (contig, or contig with first and last place, from 1) if one is given.

    With :data:`FILTERS` on, a filter on the contig reads that contig's blocks only, too.
    """
    spark.dataSource.register(Bam)
    files = _listed(spark, paths)
    if not files:
        raise FileNotFoundError(f"no BAM files in {paths}")
    where = (region, 1, 1 << 29) if isinstance(region, str) else region
    asked = "null" if where is None else json.dumps([where[0], where[1] - 1, where[2]])
    return spark.read.format("strandlake_bam").option("files", json.dumps(files)).option("region", asked).option("split", split).option("filters", spark.conf.get(FILTERS, "false")).load()


def write_bam(df: DataFrame, folder: str, contigs: list[tuple[str, int]], *, by: str | None = None) -> None:
    """Files of the table's records, for each value of ``by`` in folders of their own."""
    df.sparkSession.dataSource.register(Bam)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    rows = df.select(*names, *([by] if by else []))
    rows = rows.repartition(by).sortWithinPartitions(by) if by else rows
    rows.write.format("strandlake_bam").mode("append").option("path", _uri(df, folder)).option("contigs", json.dumps(contigs)).options(**({"by": by} if by else {})).save()


def write_sorted(df: DataFrame, folder: str, contigs: list[tuple[str, int]], *, files: int | None = None) -> None:
    """Files in coordinate order, each with its index: contigs as listed, then places; reads without one come last."""
    df.sparkSession.dataSource.register(Bam)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    order = F.create_map(*(F.lit(x) for k, (c, _) in enumerate(contigs) for x in (c, k)))
    keyed = df.select(*names, F.coalesce(F.try_element_at(order, F.col("contig")), F.lit(len(contigs))).alias("__contig"))
    keys = ["__contig", "pos", "read_id", "flag"]
    ranged = keyed.repartitionByRange(files, *keys) if files else keyed.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.format("strandlake_bam").mode("append").option("path", _uri(df, folder)).option("contigs", json.dumps(contigs)).option("ordered", "true").save()


def read_region(spark: SparkSession, folder: str, contigs: list[tuple[str, int]], region: tuple[str, int, int]) -> DataFrame:
    """A region of files in coordinate order: only those that may hold a record of it are opened."""
    order = {c: k for k, (c, _) in enumerate(contigs)}
    place = lambda c, p: (order.get(c, len(order)), p or 0)
    contig, start, end = region
    # a file may begin with a record that reaches into the region from before it: the one ahead of it is asked for too
    needed = [f"{folder}/{x[0]}" for x in written_files(folder) if place(x[2], x[3]) <= place(contig, end) and place(x[4], 0) >= place(contig, 0) and not (x[4] == contig and x[5] + MAX_SPAN < start)]
    if not needed:
        return spark.createDataFrame([], SCHEMA)
    return read_bam(spark, needed, region=region)


#: Places that an alignment covers at most, for files whose last record begins before a region.
MAX_SPAN = 1 << 20


def _uri(df: DataFrame, folder: str) -> str:
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(conf).makeQualified(path).toString()
