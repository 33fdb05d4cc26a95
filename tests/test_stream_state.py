"""Streamed upsert with the winner in state equals the batch upsert."""

import pytest
from pyspark.errors import StreamingQueryException

from simsift.operators import ingest
from simsift.streaming import keyed_upsert

SCHEMA = "id bigint, seq bigint, name string, v array<float>"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def told(df):
    return sorted((str(r.id), r.seq, r.name, str(r.v)) for r in df.select("id", "seq", "name", "v").collect())


def load(spark, base, schema):
    keyed_upsert.upsert_stream_stateful(spark, f"{base}/in", schema, f"{base}/table", checkpoint=f"{base}/state",
                                        max_files_per_trigger=1)
    return keyed_upsert.current(spark, f"{base}/table", schema)


def test_late_and_replayed_rows_lose(spark, scratch):
    first = [(1, 5, "a", [1.0]), (1, 3, "old", None), (2, 1, "b", []), (None, 2, "n", None), (9, None, "never", None)]
    first += [(7, i, f"hot {i}", [0.5]) for i in range(500)]
    write(spark, f"{scratch}/in", first)
    schema = spark.read.parquet(f"{scratch}/in").schema
    got = told(load(spark, scratch, schema))
    assert got == sorted([("1", 5, "a", "[1.0]"), ("2", 1, "b", "[]"), ("None", 2, "n", "None"), ("7", 499, "hot 499", "[0.5]")])
    files = spark.read.parquet(f"{scratch}/table").count()
    second = [(1, 4, "late", None), (1, 5, "a", [1.0]), (2, 8, "newer", None), (3, 0, "new", None)]
    write(spark, f"{scratch}/in", second)
    third = [(2, 7, "late too", None), (3, 0, "new", None)]
    write(spark, f"{scratch}/in", third)
    got = load(spark, scratch, schema)
    everything = spark.createDataFrame([r for r in first + second + third if r[0] is not None and r[1] is not None], SCHEMA)
    assert told(got.where("id IS NOT NULL")) == told(ingest.upsert(None, everything, id_col="id", seq_col="seq", check="lazy"))
    assert spark.read.parquet(f"{scratch}/table").count() == files + 2          # two winners moved, nothing else
    assert told(load(spark, scratch, schema)) == told(got)                      # nothing new: nothing changes


def test_conflicting_rows_fail(spark, scratch):
    write(spark, f"{scratch}/in", [(1, 5, "a", None)])
    schema = spark.read.parquet(f"{scratch}/in").schema
    load(spark, scratch, schema)
    write(spark, f"{scratch}/in", [(1, 5, "another", None)])
    with pytest.raises(StreamingQueryException):
        load(spark, scratch, schema)
