"""Intermediate tables in the folder that the whole cluster shares.

Iterative operators cut their lineage by writing a table there and reading it
back, so that a lost executor costs a task and not the run.  The folder is the
one named by ``spark.checkpoint.dir``; only where that is unset on a local
master, as in tests, a temporary one is made.  Tables are deleted when nothing
reads them any more: by the operator itself, or at the end of a scratch().
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_scratch: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder for this application's intermediate tables."""
    app = spark.sparkContext.applicationId
    if app not in _own:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            base = "file://" + tempfile.mkdtemp(prefix="bitloom-")
        _own[app] = f"{base.rstrip('/')}/bitloom-{app}"
        atexit.register(_clear, spark, _own[app])
    return _own[app]


def _clear(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # the session may be gone already
        pass


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fresh_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back."""
    return stored(df, tag)[0]


def stored(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """materialise(), and where the table lies, for who deletes it."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are made inside are deleted at the end; what was written elsewhere from them stays."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            delete(spark, path)


def tune(spark: SparkSession) -> None:
    """Bound what one Arrow batch can hold; rows here can be whole long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def row_key(*cols: str):
    """Two 64-bit hashes of whole rows, to join a row's results back to it.

    Rows that are equal in ``cols`` share a key, and have equal results.  A null
    differs from every value.
    """
    parts = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(1), *parts).alias("_k1"), F.xxhash64(F.lit(2), *parts).alias("_k2")
