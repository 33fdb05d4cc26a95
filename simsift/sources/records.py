"""Nested records with a menu array (SRC-2 shape) derived from the test tables.

A record is a document with an optional menu: the part whose key equals the
document id contributes ``menu_items = [p_name, p_type]`` (one bounded array per
row; documents without such a part get NULL, i.e. no menu).

``read_records`` is the schema'd JSON reader for record files (FAILFAST, then a
required-column check), the Spark form of loading a record file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsift.sources import tables

RECORD_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("cuisine", T.StringType()),
    T.StructField("menu_items", T.ArrayType(T.StringType())),
    T.StructField("rating", T.DoubleType()),
    T.StructField("description", T.StringType()),
])
REQUIRED = ("id", "name", "cuisine", "description")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read_table(spark, sf_dir, "documents")
    part = tables.read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("doc_id"),
        F.array_compact(F.array("p_name", "p_type")).alias("menu_items"))
    return (docs.join(part, "doc_id", "left")
                .select(F.col("doc_id").alias("id"), F.col("source").alias("name"),
                        F.col("lang").alias("cuisine"), "menu_items",
                        F.col("n_chars").cast("double").alias("rating"),
                        F.col("text").alias("description")))


class RecordFileError(ValueError):
    pass


def read_records(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """SRC-2: read JSON-lines records; fail clearly if missing, unreadable or misshapen."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import AnalysisException, PySparkException

    try:
        df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        raise RecordFileError(f"record file not found or unreadable: {path} ({e})") from e
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise RecordFileError(f"record file {path} lacks required fields {missing}")
    # One pass over every field (FAILFAST raises on a malformed line or a field of
    # another type only where the field is read) that also looks for missing values.
    lacking = " OR ".join(f"{c} IS NULL" for c in REQUIRED)
    try:
        seen = df.agg(F.count_if(F.expr(lacking)).alias("bad"), F.max(F.xxhash64(*df.columns)).alias("all")).collect()[0]
    except (Py4JJavaError, PySparkException) as e:
        raise RecordFileError(f"record file {path} is malformed: {str(e)[:300]}") from e
    bad = seen["bad"]
    if bad:
        raise RecordFileError(f"record file {path} has rows without {list(REQUIRED)}")
    return df
