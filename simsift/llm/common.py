"""Helpers shared by the corpus operators: table reads, shared storage, Arrow text buffers."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import time
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """One of the given parquet tables, reduced to ``cols`` (all when none are named)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A private temporary folder is used only when the setting is absent and the
    master is local, so that driver and tasks share one machine; on a cluster
    an absent setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="simsift-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_bucket(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``mod``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string (or binary) column; NULL reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    binary = col.cast(pa.large_binary()) if col.type != pa.large_binary() else col
    if binary.null_count:
        binary = pc.fill_null(binary, b"")
    n = len(binary)
    _, off, data = binary.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, binary.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return memory that this Python worker has freed to the system; Spark reuses workers for later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # of the GNU C library
    if trim is not None:
        trim(0)


MEMO = "simsift_worker_memo"


def worker_memo() -> types.ModuleType:
    """What a step keeps in this Python worker between its tasks.

    It is a module of its own, as functions of this package reach a worker by value.
    """
    return sys.modules.setdefault(MEMO, types.ModuleType(MEMO))


def trimmed(run, keeps: str | None = None):
    """The Arrow function ``run``, which gives back what it freed when its task ends.

    The worker's memo belongs to one step at a time, named by ``keeps``; what
    another step left there goes before the task begins.
    """
    def wrapped(batches):
        if getattr(sys.modules.get(MEMO), "owner", None) != keeps:
            sys.modules.pop(MEMO, None)
            give_back()
            if keeps:
                worker_memo().owner = keeps
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def slices(offsets: np.ndarray, budget: int):
    """Row ranges ``(a, b)`` holding about ``budget`` bytes each (at least one row)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + budget, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps now.

    The cleaner acts when the driver's garbage is collected, which otherwise
    happens every ``spark.cleaner.periodicGC.interval``. The last query's plan is
    let go a moment after it ends, hence the second call.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


BROADCAST_BYTES = 64 << 20


def sized_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its counted rows fit ``limit``; otherwise as it is (a shuffle join).

    The join's result is the same either way. ``df`` should be cheap to count.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
