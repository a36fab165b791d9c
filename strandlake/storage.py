"""Tables in shared storage: how iterative plans cut their lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_written: dict[int, tuple[DataFrame, str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir.

    Only where that setting is missing and the master is local (tests on one machine) a
    temporary folder is set instead; on a cluster it has to be set.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if sc.applicationId not in _own:
            _own[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="strandlake-shared-")
            sc.setCheckpointDir(_own[sc.applicationId])
        base = _own[sc.applicationId]
    elif "://" not in base and base.startswith("/"):
        path = sc._jvm.org.apache.hadoop.fs.Path(base)
        base = path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder; it is removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/strandlake-{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def drop(df: DataFrame) -> None:
    """Remove a table of :func:`materialise` that nothing reads any more, before the driver ends."""
    path = _written.pop(id(df), (None, None))[1]
    if path:
        _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended before
        pass


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    _written[id(read)] = (read, path)  # the table is kept with its id, so that no other gets it
    return read
