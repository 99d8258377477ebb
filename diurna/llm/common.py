"""Helpers that several training-data operators share."""

from __future__ import annotations

import atexit
import logging
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows and bytes of a batch that goes to a Python worker at most, where the session has Spark's own defaults
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20

_stashed: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, local runs take one of their own; a cluster has none that all see, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that driver and executors share (master {master})")
        found = "file://" + tempfile.mkdtemp(prefix="diurna-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stash(df: DataFrame, what: str = "step") -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: lineage ends there and a lost executor costs nothing.

    The files are removed when the driver's Python ends, or by release().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/diurna/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _stashed:
        atexit.register(_clean)
    _stashed.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._stash = path
    return out


def release(df: DataFrame) -> None:
    """Remove the files of a stashed frame that nothing reads any more."""
    path = getattr(df, "_stash", None)
    for entry in [e for e in _stashed if e[1] == path]:
        _stashed.remove(entry)
        _delete(*entry)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception as error:  # noqa: BLE001  the session may be gone already; the other folders are still tried
        log.debug("%s is left: %s", path, error)


def _clean() -> None:
    while _stashed:
        _delete(*_stashed.pop())


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that Python workers get by rows and bytes: texts may be very long. A session's own settings hold."""
    for key, default, most in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", "67108864b", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, str(most))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    # lower() maps A-Z alone where the text has no other than one-byte characters, and is many times faster
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, UPPER.lower()))


def is_training_row(doc_id: Column) -> Column:
    """Rows whose labels may be used: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string")) % 3 != 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
