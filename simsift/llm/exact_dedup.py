"""Exact deduplication with stateful streaming.

A streaming aggregate keeps, per content digest, the row that stays (the
largest id), a locator of its content (the file that holds it) and the number
of rows seen. The state is keyed, lives on disk (RocksDB state store) and never
expires: there is no watermark, so a copy is recognised however late it comes.
Later runs with the same checkpoint go on from the stored state.

A digest seen more than once is a hit, and hits are checked on full bytes: the
normalised texts themselves are the grouping key of a second aggregate over the
hit rows only, so two different texts under one digest would be told apart and
become two groups. As long as the digests of the hits fit a broadcast, other texts
are left out where they are read and copies collapse in each task before that
shuffle, which keeps a hot text from meeting in one task; beyond that every
text is shuffled once to be compared with them.

Everything is DataFrame functions; the state is read back as a table.

Defined results: NULL text equals the empty text; only A-Z are folded; rows that
repeat the kept id are all kept; NULL ids lose against any other id; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.llm.common import cut, fresh_path, sized_broadcast

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DIGEST_BYTES = 420              # of one digest in a broadcast table, as Spark counts it
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalise(text: Column) -> Column:
    """Fold A-Z only; NULL is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def sha256(normal: Column) -> Column:
    return F.sha2(normal.cast("binary"), 256)


def read_stream(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """Parquet files of ``path`` (a folder or one file) as a stream, with the schema of what is there.

    The last letter goes in as a one-letter pattern: the stream source takes a
    plain path for a folder, and a pattern for either.
    """
    path = path.rstrip("/")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def update_state(stream: DataFrame, checkpoint: str, text: str = "text", key: str = "doc_id",
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Feed everything available into the keyed state; returns it as (digest, keep_id, location, group_size)."""
    spark = stream.sparkSession
    seen = stream.select(digest(normalise(F.col(text))).alias("digest"), F.col(key).cast("bigint").alias("doc_id"),
                         F.col("_metadata.file_path").alias("location"))
    state = seen.groupBy("digest").agg(F.max(F.struct("doc_id", "location")).alias("kept"),
                                       F.count(F.lit(1)).alias("group_size"))
    # a finished run leaves no store open on the executors, whose local files would stay
    settings = {"spark.sql.streaming.stateStore.providerClass": PROVIDER,
                "spark.sql.streaming.stateStore.unloadOnCommit": "true"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        query = (state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    stored = spark.read.format("statestore").load(checkpoint)
    kept, size = [f"value.`{f.name}`" for f in stored.schema["value"].dataType.fields]
    return stored.select(F.col("key.digest").alias("digest"), F.col(f"{kept}.doc_id").alias("keep_id"),
                         F.col(f"{kept}.location").alias("location"), F.col(size).alias("group_size"))


def hit_texts(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """(digest, normal, keep_id, group_size): the distinct texts of ``docs`` (doc_id, normal, digest) under the digests of ``hits``."""
    digests = sized_broadcast(hits.distinct(), DIGEST_BYTES)
    return (docs.join(digests, "digest", "left_semi")
            .groupBy("digest", "normal").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))


def exact_dedup(spark: SparkSession, path: str, checkpoint: str | None = None, text: str = "text", key: str = "doc_id",
                digest: Callable[[Column], Column] = sha256, max_bytes: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for every row below ``path``."""
    checkpoint = checkpoint or fresh_path(spark, "dedup-state")
    state = update_state(read_stream(spark, path, max_bytes), checkpoint, text, key, digest)
    docs = spark.read.parquet(path).select(F.col(key).cast("bigint").alias("doc_id"), normalise(F.col(text)).alias("normal"))
    rows = docs.select("doc_id", digest(F.col("normal")).alias("digest"), sha256(F.col("normal")).alias("text_sha256"))
    tagged = cut(rows.join(state.select("digest", "keep_id", "group_size"), "digest"))

    hits = tagged.where(F.col("group_size") > 1)
    verified = cut(hit_texts(docs.select("doc_id", "normal", digest(F.col("normal")).alias("digest")), hits.select("digest"))
                   .select("digest", sha256(F.col("normal")).alias("text_sha256"), "keep_id", "group_size",
                           F.count(F.lit(1)).over(_by_digest()).alias("texts")))
    single = tagged.where(F.col("group_size") == 1)
    one_text = verified.where(F.col("texts") == 1).select("digest", "keep_id", "group_size")
    many = verified.where(F.col("texts") > 1).select("digest", "text_sha256", "keep_id", "group_size")
    plain = hits.drop("keep_id", "group_size")
    out = (single.unionByName(plain.join(one_text, "digest"))
           .unionByName(plain.join(many, ["digest", "text_sha256"])))
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _by_digest():
    from pyspark.sql import Window

    return Window.partitionBy("digest")
