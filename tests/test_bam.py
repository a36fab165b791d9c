"""BAM files: records found in any split, regions by index, files by task, value and place."""

import random
import struct

import pytest

from strandlake.sources import bam

CONTIGS = [("chrM", 400_000), ("lenti", 300_000_000), ("empty", 1000)]
NAMES = [c.split()[0] for c in bam.SCHEMA.split(", ")]


def records(n, seed, length=90):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = rng.randint(0, length)
        contig = rng.choice(["chrM", "lenti", "lenti", None])
        pos = None if contig is None else rng.randint(1, 390_000 if rng.random() < 0.9 else 3000)
        cigar = "*" if contig is None or k < 9 else f"3S{k - 8}M2D{5}M" if k % 2 else f"{k}M"
        seq, qual = "".join(rng.choices("ACGTN", k=k)) or "*", "".join(chr(33 + rng.randint(0, 60)) for _ in range(k)) or "*"
        out.append((f"r{i}", 4 if contig is None else rng.choice([0, 16, 1024]), contig, pos, rng.randint(0, 60), cigar, seq, qual, rng.choice([None, "-", "ACGTACGT"]), rng.choice([None, "TTTT"])))
    return out


def told(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    return records(6000, 1)


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, bam.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def ordered(spark, table, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bam") / "sorted")
    bam.write_sorted(table, folder, CONTIGS, files=4)
    return folder


def test_round_trip_at_any_split(spark, table, rows, tmp_path):
    bam.write_bam(table, str(tmp_path / "x"), CONTIGS)
    for split in (3000, 70_000, 1 << 25):
        assert told(bam.read_bam(spark, str(tmp_path / "x"), split=split)) == sorted(rows, key=str)
    assert told(bam.read_bam(spark, str(tmp_path / "x/*.bam"))) == sorted(rows, key=str)


def test_records_longer_than_a_block(spark, tmp_path):
    rows = records(40, 2, 150_000)
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA).repartition(1), str(tmp_path / "x"), CONTIGS)
    assert told(bam.read_bam(spark, str(tmp_path / "x"), split=50_000)) == sorted(rows, key=str)


def test_a_file_a_value(spark, table, rows, tmp_path):
    named = table.withColumn("chunk", bam.F.coalesce("CB", bam.F.lit("none")))
    bam.write_bam(named, str(tmp_path / "x"), CONTIGS, by="chunk")
    for value in ("none", "-", "ACGTACGT"):
        assert told(bam.read_bam(spark, str(tmp_path / f"x/{value}/*.bam"))) == sorted((r for r in rows if (r[8] or "none") == value), key=str)


def overlaps(r, contig, start, end):
    return r[2] == contig and r[3] <= end and r[3] + bam.span(r[5]) - 1 >= start


def test_order_and_index(spark, ordered, rows):
    files = bam.written_files(ordered)
    key = lambda c, p: ([x for x, _ in CONTIGS].index(c) if c else 9, p or 0)
    assert len(files) == 4 and sum(f[6] for f in files) == len(rows)
    spans = sorted((key(f[2], f[3]), key(f[4], f[5])) for f in files)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    for f in files:
        got = bam.read_bam(spark, f"{ordered}/{f[0]}").collect()
        assert [key(r.contig, r.pos) for r in got] == sorted(key(r.contig, r.pos) for r in got)
    assert told(bam.read_bam(spark, ordered)) == sorted(rows, key=str)


@pytest.mark.parametrize("region", [("chrM", 1, 300), ("lenti", 100_000, 100_500), ("lenti", 1, 1 << 29), ("lenti", 389_000, 400_000), ("empty", 1, 1000), ("other", 1, 10)])
def test_region(spark, ordered, rows, region):
    want = sorted((r for r in rows if overlaps(r, *region)), key=str)
    assert told(bam.read_bam(spark, ordered, region=region, split=5000)) == want
    assert told(bam.read_region(spark, ordered, CONTIGS, region)) == want


def test_a_region_reads_few_blocks_of_few_files(spark, ordered):
    files = bam._listed(spark, ordered)
    whole = bam.Reader(files, None, 1 << 25).partitions()
    few = bam.Reader(files, ("lenti", 100_000, 101_000), 1 << 25).partitions()
    assert len(whole) == 4 and 1 <= len(few) <= 2
    assert 5 * sum(s.end - s.start for s in few) < sum(s.end - s.start for s in whole)

    class Is(bam.EqualTo):
        pass

    reader = bam.FilteredReader(files, None, 1 << 25)
    kept = list(reader.pushFilters([Is(("contig",), "chrM")]))
    assert len(kept) == 1 and reader.region == ("chrM", 0, 1 << 29)
    assert sum(s.end - s.start for s in reader.partitions()) < sum(s.end - s.start for s in whole)


def test_a_filter_on_the_contig_is_pushed(spark, ordered, rows):
    spark.conf.set(bam.FILTERS, "true")
    try:
        assert told(bam.read_bam(spark, ordered).where("contig = 'chrM' and pos > 100000")) == sorted((r for r in rows if r[2] == "chrM" and r[3] > 100_000), key=str)
    finally:
        spark.conf.set(bam.FILTERS, "false")


def test_other_tags_are_passed_by(spark):
    data = b"NHCx" + b"ASs\1\2" + b"XBBi\2\0\0\0\1\0\0\0\2\0\0\0" + b"CBZACGT\0" + b"XFf\0\0\0\0" + b"UBAQ"
    data = data.replace(b"NHCx", b"NHC\5")
    assert bam.tag_values(data, 0, len(data), ("CB", "UB", "NH")) == {"CB": "ACGT", "UB": "Q", "NH": "5"}


def test_what_is_no_record():
    row = dict(zip(NAMES, ("name", 0, "chrM", 5, 9, "4M", "ACGT", "IIII", None, None)))
    data = bam.encode(row, {"chrM": 0})
    assert bam.plausible(data, 0, 1) == len(data) and bam.decode(data, 0, CONTIGS) == ("name", 0, "chrM", 5, 9, "4M", "ACGT", "IIII", None, None)
    assert bam.plausible(data, 0, 0) is None and bam.plausible(data[:20], 0, 1) == 0
    assert all(bam.plausible(data + data, k, 1) in (None, 0) for k in range(1, len(data) - 36))
    assert bam.plausible(struct.pack("<i", 1 << 30) + data[4:], 0, 1) is None


def test_bins():
    assert bam.bin_of(0, 1) == 4681 and bam.bin_of(16383, 16385) == 585 and bam.bin_of(0, 1 << 29) == 0 and bam.bin_of(1 << 26, (1 << 26) + 1) == 4681 + (1 << 12)


def test_nothing_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        bam.read_bam(spark, str(tmp_path / "none*.bam"))
    bam.write_bam(spark.createDataFrame([], bam.SCHEMA), str(tmp_path / "e"), CONTIGS)


def test_encoded_bases_and_qualities():
    from strandlake.sources.bam import encode

    row = dict(read_id="r", seq="ACGTNx=", qual="!5I~#FF", cigar="7M", pos=1, mapq=60, flag=0, contig="c", CB=None, UB=None)
    assert encode(row, {"c": 0})[-11:] == bytes([0x12, 0x48, 0xFF, 0x00]) + bytes(ord(c) - 33 for c in row["qual"])
    with pytest.raises(ValueError):
        encode(row | {"qual": "!5I ~FF"}, {"c": 0})
