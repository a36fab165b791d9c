"""What the text operators share: shared storage, code shipping, column helpers."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import tokens
from strandlake.storage import drop, materialise, scratch_path, shared_dir

__all__ = ["NULL_ID", "crc_mod", "doc_key", "drop", "materialise", "mix64", "scratch_path", "shared_dir", "ship_code", "slices", "utf8"]

#: Sorts after every other document: the place of rows without an id.
NULL_ID = (1 << 63) - 1

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors' Python this package, whatever folder the driver was started in."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="strandlake-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def doc_key(id_col: str = "doc_id") -> Column:
    """The id under which a row takes part; rows without id count as one last document."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id as text, modulo m."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(m))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that a worker holds few texts as Python objects at a time.

    What an encoder has left in the worker is freed first.
    """
    tokens.forget()
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix64(values: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit mix of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

