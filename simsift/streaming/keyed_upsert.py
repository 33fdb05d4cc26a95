"""Keyed upsert decided in state (STR-1): every id holds its winning ``seq``.

The stream keeps, for each id and without expiry, the ``seq`` and a hash of the row that
wins so far. A row wins when its ``seq`` is greater; late rows and replayed ones lose
against the state and write nothing, and a different row with the winning ``seq`` fails
the stream. Only winners leave the state, and each micro-batch writes them to a
folder of its own, so a batch that runs again after a failure replaces what it had
written, and a load moves new rows only. :func:`current` reads the winners: a later winner
of an id always has a greater ``seq``.

Within a partition rows that cannot win are left out before the shuffle, so a hot id
sends a few rows a task. Rows with a NULL ``seq`` never win; NULL ids are one id.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

# the processor runs in Python workers and travels by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"


def _contenders(id_at: int, seq_at: int):
    """Arrow function: the rows of a batch that hold the greatest ``seq`` of their id."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for rb in batches:
            if not rb.num_rows:
                continue
            code = rb.column(id_at).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) + 1
            seq = rb.column(seq_at).to_numpy(zero_copy_only=False)
            best = np.full(code.max() + 1, np.iinfo(np.int64).min)
            np.maximum.at(best, code, seq)
            yield rb.filter(pa.array(seq == best[code]))

    return run


class Latest(StatefulProcessor):
    """Keeps the winning ``(seq, hash)`` of an id and lets its new winner through."""

    def __init__(self, seq_col: str):
        self.seq_col = seq_col

    def init(self, handle) -> None:
        self.winner = handle.getValueState("winner", T.StructType([T.StructField("seq", T.LongType()), T.StructField("h", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        held = tuple(self.winner.get()) if self.winner.exists() else None
        before, row = held, None
        for r in rows:
            seq, h = r[self.seq_col], r["_h"]
            if held is None or seq > held[0]:
                held, row = (seq, h), r
            elif seq == held[0] and h != held[1]:
                raise ValueError(f"different rows with id {key[0]!r} and {self.seq_col} {seq}")
        if held != before:
            self.winner.update(held)
            yield row

    def close(self) -> None:
        pass


def upsert_stream_stateful(spark: SparkSession, source: str, schema: T.StructType, path: str, *, checkpoint: str,
                           id_col: str = "id", seq_col: str = "seq", max_files_per_trigger: int | None = None) -> None:
    """Load all files that ``source`` has now and ``checkpoint`` does not know yet; winners go below ``path``.

    ``source`` is a folder or one file: its last letter goes in as a pattern, which the stream takes for either.
    """
    source = source.rstrip("/")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    names = [f.name for f in schema.fields]
    rows = (reader.parquet(f"{source[:-1]}[{source[-1]}]").where(F.col(seq_col).isNotNull())
            .withColumn(seq_col, F.col(seq_col).cast("long")).withColumn("_h", F.xxhash64(*names)))
    out = rows.mapInArrow(_contenders(names.index(id_col), names.index(seq_col)), rows.schema)
    winners = out.groupBy(id_col).transformWithState(Latest(seq_col), rows.schema, "Update", "None")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.drop("_h").write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={epoch}")

    old = spark.conf.get(_PROVIDER_KEY, None)
    spark.conf.set(_PROVIDER_KEY, PROVIDER)
    try:
        query = (winners.writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        if old is None:
            spark.conf.unset(_PROVIDER_KEY)
        else:
            spark.conf.set(_PROVIDER_KEY, old)


def current(spark: SparkSession, path: str, schema: T.StructType, *, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """The winning row of every id written so far, with the columns of ``schema``."""
    rows = spark.read.schema(schema).parquet(path)
    whole = F.max_by(F.struct(*[f.name for f in schema.fields]), F.col(seq_col)).alias("r")
    return rows.groupBy(F.col(id_col).alias("_id")).agg(whole).select("r.*")
