"""Layouts change which bytes are read, never the answer (IDX-1/2), plus SRC-4 report."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from simsift.operators import layout, search
from simsift.sources import tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyword_partition_layout_prunes(spark, scratch):
    pts = tables.vectors(spark, SF_SMALL).join(tables.payload(spark, SF_SMALL), "id")
    path = f"{scratch}/kw"
    layout.write_keyword_layout(pts, "lang", path)
    back = spark.read.parquet(path)
    q = [float(x) for x in pts.where(F.col("id") == 0).collect()[0].vector]
    got = search.knn(back, q, k=5, where=F.col("lang") == "en", keep=("lang",))
    plan = _plan(back.where(F.col("lang") == "en"))
    assert "PartitionFilters: [isnotnull(lang" in plan and "(lang#" in plan
    exp = search.knn(pts, q, k=5, where=F.col("lang") == "en", keep=("lang",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_range_layout_pushes_filter(spark, scratch):
    pts = tables.vectors(spark, SF_SMALL).join(tables.payload(spark, SF_SMALL), "id")
    path = f"{scratch}/rng"
    layout.write_range_layout(pts, "n_chars", path, partitions=4)
    back = spark.read.parquet(path)
    plan = _plan(back.where(F.col("n_chars") >= 1000))
    assert "PushedFilters: [IsNotNull(n_chars), GreaterThanOrEqual(n_chars,1000)]" in plan
    # each file holds a disjoint n_chars range
    ranges = (back.withColumn("f", F.input_file_name()).groupBy("f")
                  .agg(F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi")).orderBy("lo").collect())
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))
    assert back.count() == pts.count()


def test_postings_written_sorted(spark, scratch):
    docs = tables.read_table(spark, SF_SMALL, "documents").select(F.col("doc_id").alias("id"), "text")
    path = f"{scratch}/post"
    layout.write_postings(layout.postings(docs, "text"), path, partitions=4)
    back = spark.read.parquet(path)
    plan = _plan(back.where(F.col("token").isin(["the", "of"])))
    assert "PushedFilters: [In(token, [of,the])" in plan or "PushedFilters: [In(token, [the,of])" in plan
    a = {r.id for r in layout.match_ids(back, "the of").collect()}
    b = {r.id for r in layout.match_ids(layout.postings(docs, "text"), "the of").collect()}
    assert a == b and a


def test_dataset_report(spark):
    emb = tables.read_table(spark, SF_SMALL, "embeddings")
    rep = tables.dataset_report(emb, "vec_id")
    assert rep["rows"] == 500 and rep["columns"] == ["vec_id", "embedding", "label"]
    assert rep["first"]["vec_id"] == 0 and len(rep["first"]["embedding"]) == 64
