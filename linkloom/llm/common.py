"""Helpers the training-data operators share: the shared folder, written tables, text slices."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Folders written by this thread's operators and not yet removed, oldest first.
_own = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Where it is unset, a temporary one that goes with the process, but only if driver and executors are one
    machine and process (tests, benchmarks); on a cluster that would be another folder on every machine.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        local = tempfile.mkdtemp(prefix="linkloom-")
        atexit.register(shutil.rmtree, local, True)
        at = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def folders() -> list[str]:
    if not hasattr(_own, "folders"):
        _own.folders = []
    return _own.folders


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    top = f"{shared_dir(spark)}/linkloom-{uuid.uuid4().hex}"
    folders().append(top)
    return f"{top}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here and the work is done once."""
    at = fresh_dir(df.sparkSession, name)
    df.write.parquet(at)
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    out.folder = at.rsplit("/", 1)[0]
    return out


def _remove(spark: SparkSession, gone: list[str]) -> None:
    for top in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(top)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        if top in folders():
            folders().remove(top)


def drop(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made and nothing reads any more."""
    for table in tables:
        _remove(table.sparkSession, [table.folder])


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside are removed at the end (also after an error), but for those given to the function that this yields."""
    kept, before = set(), len(folders())

    def keep(table: DataFrame) -> DataFrame:
        kept.add(table.folder)
        return table

    try:
        yield keep
    finally:
        _remove(spark, [f for f in folders()[before:] if f not in kept])


def release(spark: SparkSession) -> None:
    """Remove all that this thread's operators have written; results still read lazily from it must be stored first."""
    _remove(spark, list(folders()))


def trim() -> None:
    """Give back what a Python worker has freed: Arrow's pool, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that ``column`` holds about ``most`` bytes at a time (one row at least)."""
    for batch in batches:
        trim()
        texts = batch.column(batch.schema.get_field_index(column))
        if texts.nbytes <= most:
            if batch.num_rows:
                yield batch
            continue
        at = taken = 0
        for i, n in enumerate(pa.compute.binary_length(texts).fill_null(0).to_pylist()):
            if taken and taken + n > most:
                yield batch.slice(at, i - at)
                at, taken = i, 0
            taken += n
        yield batch.slice(at)
        del batch, texts
    trim()
