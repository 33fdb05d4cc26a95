"""Schema'd readers for the test tables and the point tables derived from them.

The driver test data maps onto the point model as ``embeddings`` (vector) and
``documents`` (optional payload, ``vec_id = doc_id``), two tables that searches
keep apart: payload is fetched for the hits after ranking (see
``operators.search.join_payload``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS = {
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]),
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]),
    "part": T.StructType([
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()),
        T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]),
    "events": T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]),
}

PAYLOAD_COLS = ("lang", "source", "n_chars")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC-1: read with an explicit schema (no inference) when one is known."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector: ``(id, vector)``."""
    return read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def payload(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Payload keyed by ``id``; a vector without a document simply has none."""
    return read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), *(cols or PAYLOAD_COLS))


def doc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide payload ``(id, text)``, joined only after a top-k."""
    return read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def vector_of(df: DataFrame, id_value, *, id_col: str = "id", vector: str = "vector") -> list[float]:
    """Fetch one vector by id (a query parameter: exactly one row of ``dim`` floats)."""
    rows = df.where(F.col(id_col) == F.lit(id_value)).select(vector).limit(2).collect()
    if len(rows) != 1 or rows[0][0] is None:
        raise ValueError(f"expected exactly one vector for {id_col}={id_value!r}, got {len(rows)}")
    return [float(x) for x in rows[0][0]]


def dataset_report(df: DataFrame, order_by: str) -> dict:
    """SRC-4: size, schema, column names and the first row by ``order_by``.

    Two small actions (a count and a top-1), nothing else reaches the driver.
    """
    first = df.orderBy(order_by).limit(1).collect()
    return {"rows": df.count(), "columns": df.columns, "schema": df.schema.simpleString(),
            "first": first[0].asDict() if first else None}


def literal_points(spark: SparkSession, rows, schema) -> DataFrame:
    """SRC-3: a small inline point list (e.g. a handful of hand-written points)."""
    return spark.createDataFrame(rows, schema)
