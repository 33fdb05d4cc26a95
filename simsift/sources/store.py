"""Point tables in the Spark catalog (SNK-1..4, SNK-6, SNK-9 config).

A point table is a plain Parquet catalog table. Its vector config (size and
metric per named dense vector, names of sparse vectors) and build parameters
are table properties, so they can be read back and compared.

Writes never overwrite the files being read: every commit writes a new version
folder under the table root and then switches the table's LOCATION to it (one
metastore update). A reader holding the old version keeps a consistent view; a
failed write leaves the current version untouched.

Every write checks the declared vector sizes and fails on a row that breaks
them; ``split_valid`` parts such rows off beforehand. Updating a huge table in
place (``MERGE``) is the business of a table format, not of this module.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsift.functions.vectors import COSINE, METRICS

PROP_VECTORS = "simsift.vectors"
PROP_SPARSE = "simsift.sparse"
PROP_BUILD = "simsift.build"
PROP_ID = "simsift.id_type"


@dataclass(frozen=True)
class VectorParams:
    size: int
    metric: str = COSINE

    def __post_init__(self):
        if self.size <= 0:
            raise ValueError("vector size must be positive")
        if self.metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}")


@dataclass
class TableInfo:
    name: str
    location: str
    vectors: dict[str, VectorParams]
    sparse: list[str]
    build: dict = field(default_factory=dict)
    created: bool = False
    id_type: str = "long"


SPARSE_TYPE = T.StructType([T.StructField("indices", T.ArrayType(T.LongType())),
                            T.StructField("values", T.ArrayType(T.FloatType()))])


def vector_column(name: str) -> str:
    """Column of a named vector: ``vector`` for the unnamed one, else ``vec_<name>``."""
    return "vector" if name == "" else f"vec_{name}"


def sparse_column(name: str) -> str:
    return "sp_" + name.replace("-", "_")


def point_schema(vectors: dict[str, VectorParams], sparse: list[str], id_type: str = "long",
                 payload: T.StructType | None = None) -> T.StructType:
    fields = [T.StructField("id", T.LongType() if id_type == "long" else T.StringType(), False)]
    fields += [T.StructField(vector_column(n), T.ArrayType(T.FloatType())) for n in vectors]
    fields += [T.StructField(sparse_column(n), SPARSE_TYPE) for n in sparse]
    fields += [T.StructField("seq", T.LongType())]
    if payload is not None:
        fields += list(payload.fields)
    return T.StructType(fields)


def _props(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    for r in rows:
        if r["col_name"] == "Location":
            return r["data_type"]
    raise ValueError(f"table {name} has no location")


def describe(spark: SparkSession, name: str) -> TableInfo:
    """SNK-9: read back the vector config of a table."""
    p = _props(spark, name)
    vectors = {k: VectorParams(**v) for k, v in json.loads(p.get(PROP_VECTORS, "{}")).items()}
    return TableInfo(name, _location(spark, name), vectors, json.loads(p.get(PROP_SPARSE, "[]")),
                     json.loads(p.get(PROP_BUILD, "{}")), id_type=p.get(PROP_ID, "long"))


def get_or_create_table(spark: SparkSession, name: str, root: str, *,
                        vectors: VectorParams | dict[str, VectorParams] | None = None,
                        sparse: list[str] | None = None, build: dict | None = None,
                        id_type: str = "long", payload: T.StructType | None = None,
                        rebuild_on_change: bool = False, clean: bool = False) -> TableInfo:
    """SNK-4 (+SNK-6): return the existing table, or create it.

    ``vectors=None`` with ``sparse`` given makes a sparse-only table (no dense
    column); with neither, one unnamed size-4 cosine vector. An existing table
    must carry the declared config (vectors, sparse vectors, id type, and the payload
    columns when given), else ``ValueError``. When only the build
    parameters differ and ``rebuild_on_change`` is set, the table is dropped and
    recreated empty (a clean rebuild). ``clean=True`` always drops and recreates.
    """
    if isinstance(vectors, VectorParams):
        vectors = {"": vectors}
    sparse = list(sparse or [])
    if vectors is None:
        vectors = {} if sparse else {"": VectorParams(4, COSINE)}
    build = dict(build or {})
    if clean and spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {name}")
    if spark.catalog.tableExists(name):
        info = describe(spark, name)
        if info.vectors != vectors or info.sparse != sparse:
            raise ValueError(f"table {name} exists with vectors={info.vectors}, sparse={info.sparse}; "
                             f"asked for vectors={vectors}, sparse={sparse}")
        if info.id_type != id_type:
            raise ValueError(f"table {name} exists with id type {info.id_type}; asked for {id_type}")
        if payload is not None:
            own = {f.name for f in point_schema(vectors, sparse, id_type).fields}
            have = {f.name: f.dataType for f in spark.table(name).schema.fields if f.name not in own}
            want = {f.name: f.dataType for f in payload.fields}
            if have != want:
                raise ValueError(f"table {name} exists with payload {have}; asked for {want}")
        if info.build == build or not build or not rebuild_on_change:
            return info
        spark.sql(f"DROP TABLE {name}")
    schema = point_schema(vectors, sparse, id_type, payload)
    props = {PROP_VECTORS: json.dumps({k: {"size": v.size, "metric": v.metric} for k, v in vectors.items()}),
             PROP_SPARSE: json.dumps(sparse), PROP_BUILD: json.dumps(build, sort_keys=True), PROP_ID: id_type}
    loc = os.path.join(root, name, f"v-{uuid.uuid4().hex}")
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(loc)
    ddl = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet LOCATION '{loc}' TBLPROPERTIES ({ddl})")
    info = describe(spark, name)
    info.created = True
    return info


def _sizes_hold(df: DataFrame, info: TableInfo):
    from simsift.functions.vectors import valid_vector

    cond = F.lit(True)
    for n, p in info.vectors.items():
        c = vector_column(n)
        if c in df.columns:
            cond = cond & (F.col(c).isNull() | valid_vector(c, p.size))
    return cond


def split_valid(df: DataFrame, info: TableInfo) -> tuple[DataFrame, DataFrame]:
    """FLT-7: ``(accepted, quarantined)``: every declared vector is NULL or has exactly the declared size, or not."""
    ok = _sizes_hold(df, info)
    return df.where(ok), df.where(~ok)


def validate(df: DataFrame, info: TableInfo) -> DataFrame:
    """FLT-7: ``df`` itself, failing whatever consumes it on a vector of the wrong size."""
    guarded = F.when(_sizes_hold(df, info), F.col("id")).otherwise(F.raise_error(F.concat(
        F.lit(f"wrong vector size for table {info.name}, id "), F.coalesce(F.col("id").cast("string"), F.lit("NULL")))
    ).cast(df.schema["id"].dataType))
    return df.withColumn("id", guarded)


def commit(spark: SparkSession, name: str, df: DataFrame, *, max_records_per_file: int | None = None) -> dict:
    """Write ``df`` as the next version of table ``name`` and switch to it.

    Returns ``{"rows": n, "location": path}``; the row count comes from an
    ``Observation`` on the write itself (no second pass).
    """
    info = describe(spark, name)
    root = os.path.dirname(info.location.rstrip("/"))
    loc = os.path.join(root, f"v-{uuid.uuid4().hex}")
    target = spark.table(name).schema
    obs = Observation(f"commit_{uuid.uuid4().hex[:8]}")
    df = validate(df, info)
    out = df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns
                      else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields])
    w = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(loc)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{loc}'")
    spark.catalog.refreshTable(name)
    return {"rows": obs.get["rows"], "location": loc}


def upsert_into(spark: SparkSession, name: str, new: DataFrame, *, seq_col: str = "seq") -> dict:
    """SNK-1: merge ``new`` into table ``name`` (latest ``seq`` per id wins) as a new version."""
    from simsift.operators.ingest import upsert

    current = spark.table(name)
    cols = [c for c in new.columns if c in current.columns]
    return commit(spark, name, upsert(current, new.select(*cols), id_col="id", seq_col=seq_col, check="lazy"))


def load_missing_into(spark: SparkSession, name: str, new: DataFrame, *,
                      max_records_per_file: int | None = 10_000) -> dict:
    """SNK-2/3/5: append only the ids the table lacks, one row per id; nothing is added when complete.

    Append-only: the missing rows are written as new files in the current
    version folder (existing files are never rewritten), in files of at most
    ``max_records_per_file`` rows. A crash mid-load leaves whole files of a
    subset; the next run's anti-join loads exactly the rest.
    """
    from simsift.operators.ingest import load_missing, one_row_per_id, upsert

    current, info = spark.table(name), describe(spark, name)
    new = upsert(None, new, seq_col="seq", check="lazy") if "seq" in new.columns else one_row_per_id(new)
    missing = validate(load_missing(new, current), info)
    loc = info.location
    target = current.schema
    obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
    out = missing.select(*[F.col(f.name).cast(f.dataType) if f.name in missing.columns
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields])
    w = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(loc)
    spark.catalog.refreshTable(name)
    rows = obs.get["rows"]
    return {"rows": rows, "location": loc, "skipped": rows == 0}
