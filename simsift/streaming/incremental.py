"""STR-1: incremental load of arriving point files, upserted by id.

``readStream`` over a folder of Parquet files -> ``foreachBatch`` upsert into a
point table (new version per micro-batch, see ``sources.store.commit``), with a
checkpoint so a restarted job resumes after the last committed batch. ``seq``
comes from the data, not from arrival order, so replaying a batch after a
failure between the table switch and the checkpoint commit changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from simsift.sources import store


def upsert_stream(spark: SparkSession, source_dir: str, schema: T.StructType, table: str, *,
                  checkpoint: str, seq_col: str = "seq", max_files_per_trigger: int | None = None,
                  available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery`` (already finished when ``available_now``)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_dir)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        store.upsert_into(batch.sparkSession, table, batch, seq_col=seq_col)

    w = src.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
