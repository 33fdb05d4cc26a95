"""Upsert, completeness, catalog tables, versioned commits, streaming (SNK-*, STR-1, PRJ-3)."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsift.operators import ingest
from simsift.operators.ids import sequential_ids
from simsift.sources import records as rec
from simsift.sources import store
from simsift.streaming.incremental import upsert_stream

SCHEMA = "id long, seq long, name string"


def test_upsert_latest_wins_and_replay_is_harmless(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA)
    new = spark.createDataFrame([(1, 2, "a2"), (3, 1, "c"), (2, 0, "stale")], SCHEMA)
    once = ingest.upsert(old, new)
    assert sorted(map(tuple, once.collect())) == [(1, 2, "a2"), (2, 1, "b"), (3, 1, "c")]
    twice = ingest.upsert(once, new)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_identical_repeats_collapse(spark):
    new = spark.createDataFrame([(1, 5, "x"), (1, 5, "x")], SCHEMA)
    assert ingest.upsert(None, new).count() == 1


def test_conflict_rejected(spark):
    new = spark.createDataFrame([(1, 5, "x"), (1, 5, "y")], SCHEMA)
    with pytest.raises(ingest.UpsertConflict):
        ingest.upsert(None, new)
    assert [tuple(r) for r in ingest.conflicts(None, new).collect()] == [(1, 5)]


def test_lazy_conflict_fails_the_consumer(spark, scratch):
    ok = spark.createDataFrame([(1, 5, "x"), (1, 5, "x"), (2, 1, "y")], SCHEMA)
    assert ingest.upsert(None, ok, check="lazy").count() == 2
    bad = spark.createDataFrame([(1, 5, "x"), (1, 5, "y")], SCHEMA)
    with pytest.raises(Exception, match="upsert conflict"):
        ingest.upsert(None, bad, check="lazy").collect()
    store.get_or_create_table(spark, "t_lazy", scratch)
    mk = lambda rows: spark.createDataFrame(rows, "id long, vector array<float>, seq long")
    store.upsert_into(spark, "t_lazy", mk([(1, [1.0, 0.0, 0.0, 0.0], 1)]))
    before = store.describe(spark, "t_lazy").location
    with pytest.raises(Exception, match="upsert conflict"):
        store.upsert_into(spark, "t_lazy", mk([(1, [0.0, 1.0, 0.0, 0.0], 2), (1, [0.0, 0.0, 1.0, 0.0], 2)]))
    assert store.describe(spark, "t_lazy").location == before
    assert [r.seq for r in spark.table("t_lazy").collect()] == [1]


def test_hot_key_upsert(spark):
    rows = [(7, i, f"v{i}") for i in range(3000)] + [(i, 0, "x") for i in range(1, 1000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    out = {r.id: r for r in ingest.upsert(None, df).collect()}
    assert out[7].seq == 2999 and len(out) == 999


def test_load_missing(spark):
    new = spark.createDataFrame([(1, 0, "a"), (2, 0, "b"), (3, 0, "c")], SCHEMA)
    have = spark.createDataFrame([(2, 0, "b")], SCHEMA)
    assert sorted(r.id for r in ingest.load_missing(new, have).collect()) == [1, 3]


def test_vector_profile(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,), ([1.0],)], "v array<float>")
    r = ingest.vector_profile(df, ["v"]).collect()[0]
    assert (r.rows, r.nulls, r.min_dim, r.max_dim, r.zero_norm, r.min_norm, r.max_norm) == (4, 1, 1, 2, 1, 0.0, 5.0)


# ---- catalog tables (the four reference cases + ours) ----

def test_create_when_missing_defaults(spark, scratch):
    info = store.get_or_create_table(spark, "t_new", scratch)
    assert info.created and info.vectors == {"": store.VectorParams(4, "cosine")}
    assert spark.catalog.tableExists("t_new")


def test_existing_not_recreated(spark, scratch):
    store.get_or_create_table(spark, "t_exist", scratch)
    info = store.get_or_create_table(spark, "t_exist", scratch)
    assert not info.created
    assert [t.name for t in spark.catalog.listTables()].count("t_exist") == 1


def test_custom_config_read_back(spark, scratch):
    store.get_or_create_table(spark, "t_custom", scratch, vectors=store.VectorParams(8, "dot"))
    info = store.describe(spark, "t_custom")
    assert info.vectors[""].size == 8 and info.vectors[""].metric == "dot"
    with pytest.raises(ValueError):
        store.get_or_create_table(spark, "t_custom", scratch, vectors=store.VectorParams(4, "dot"))


def test_named_and_sparse_read_back(spark, scratch):
    store.get_or_create_table(spark, "t_named", scratch,
                              vectors={"image": store.VectorParams(4, "dot"), "text": store.VectorParams(5)},
                              sparse=["text-sparse"])
    info = store.describe(spark, "t_named")
    assert "text-sparse" in info.sparse and set(info.vectors) == {"image", "text"}
    cols = spark.table("t_named").columns
    assert {"vec_image", "vec_text", "sp_text_sparse"} <= set(cols)


def test_sparse_only_has_no_dense(spark, scratch):
    store.get_or_create_table(spark, "t_sparse_only", scratch, sparse=["sv"])
    cols = spark.table("t_sparse_only").columns
    assert "vector" not in cols and "sp_sv" in cols


def test_rebuild_on_build_change(spark, scratch):
    store.get_or_create_table(spark, "t_build", scratch, build={"bits": 8})
    store.commit(spark, "t_build", spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0], 1)], "id long, vector array<float>, seq long"))
    assert spark.table("t_build").count() == 1
    info = store.get_or_create_table(spark, "t_build", scratch, build={"bits": 16}, rebuild_on_change=True)
    assert info.created and info.build == {"bits": 16} and spark.table("t_build").count() == 0


def test_commit_versions_and_batches(spark, scratch):
    store.get_or_create_table(spark, "t_load", scratch)
    rows = spark.range(0, 25).select(F.col("id"), F.array(*[F.lit(1.0)] * 4).cast("array<float>").alias("vector"),
                                     F.lit(0).cast("long").alias("seq"))
    first = store.load_missing_into(spark, "t_load", rows, max_records_per_file=10)
    assert first["rows"] == 25 and spark.table("t_load").count() == 25
    assert len(glob.glob(os.path.join(first["location"].removeprefix("file:"), "*.parquet"))) >= 3
    again = store.load_missing_into(spark, "t_load", rows)
    assert again.get("skipped") and spark.table("t_load").count() == 25


def test_upsert_into_table(spark, scratch):
    store.get_or_create_table(spark, "t_up", scratch)
    mk = lambda rows: spark.createDataFrame(rows, "id long, vector array<float>, seq long")
    store.upsert_into(spark, "t_up", mk([(1, [1.0, 0.0, 0.0, 0.0], 1), (2, [0.0, 1.0, 0.0, 0.0], 1)]))
    store.upsert_into(spark, "t_up", mk([(1, [0.0, 0.0, 1.0, 0.0], 2)]))
    got = {r.id: (r.seq, list(r.vector)) for r in spark.table("t_up").collect()}
    assert got == {1: (2, [0.0, 0.0, 1.0, 0.0]), 2: (1, [0.0, 1.0, 0.0, 0.0])}


def test_stream_upsert_equals_batch(spark, scratch):
    src = os.path.join(scratch, "incoming")
    os.makedirs(src)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("vector", T.ArrayType(T.FloatType())),
                           T.StructField("seq", T.LongType())])
    batches = [[(i % 7, [float(i), 0.0, 0.0, 1.0], i) for i in range(b * 10, b * 10 + 10)] for b in range(4)]
    for b, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"b{b}"))
    store.get_or_create_table(spark, "t_stream", scratch)
    upsert_stream(spark, os.path.join(src, "*"), schema, "t_stream",
                  checkpoint=os.path.join(scratch, "ck"), max_files_per_trigger=1)
    streamed = sorted((r.id, r.seq) for r in spark.table("t_stream").collect())
    batch = ingest.upsert(None, spark.createDataFrame([r for b in batches for r in b], schema))
    assert streamed == sorted((r.id, r.seq) for r in batch.collect())
    # re-running finds nothing new and changes nothing
    upsert_stream(spark, os.path.join(src, "*"), schema, "t_stream", checkpoint=os.path.join(scratch, "ck"))
    assert sorted((r.id, r.seq) for r in spark.table("t_stream").collect()) == streamed


def test_sequential_ids(spark):
    df = spark.createDataFrame([(k, j) for k in range(50) for j in range(k % 4)], "a long, b long").repartition(5)
    got = sorted((r.a, r.b, r.row_id) for r in sequential_ids(df, ["a", "b"]).collect())
    exp = [(a, b, i) for i, (a, b) in enumerate(sorted((k, j) for k in range(50) for j in range(k % 4)))]
    assert got == exp


def test_read_records(spark, scratch):
    good = os.path.join(scratch, "good.json")
    with open(good, "w") as f:
        for i in range(3):
            f.write(json.dumps({"id": i, "name": f"n{i}", "cuisine": "c", "menu_items": None if i else ["x"],
                                "rating": 3.5, "description": "Some text."}) + "\n")
    assert rec.read_records(spark, good).count() == 3
    with pytest.raises(rec.RecordFileError):
        rec.read_records(spark, os.path.join(scratch, "missing.json"))
    bad = os.path.join(scratch, "bad.json")
    with open(bad, "w") as f:
        f.write('{"id": 1, "name": "a"\n')
    with pytest.raises(rec.RecordFileError):
        rec.read_records(spark, bad)
    typed = os.path.join(scratch, "typed.json")             # a field that is not required, of the wrong type
    with open(typed, "w") as f:
        f.write(json.dumps({"id": 1, "name": "a", "cuisine": "c", "description": "x", "rating": "high"}) + "\n")
    with pytest.raises(rec.RecordFileError):
        rec.read_records(spark, typed)


def test_load_missing_resolves_and_validates(spark, scratch):
    store.get_or_create_table(spark, "t_lm", scratch, vectors=store.VectorParams(2))
    mk = lambda rows: spark.createDataFrame(rows, "id long, vector array<float>, seq long")
    r = store.load_missing_into(spark, "t_lm", mk([(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 2), (2, [1.0, 1.0], 1),
                                                   (2, [1.0, 1.0], 1)]))
    assert r["rows"] == 2
    assert {x.id: list(x.vector) for x in spark.table("t_lm").collect()} == {1: [0.0, 1.0], 2: [1.0, 1.0]}
    with pytest.raises(Exception, match="wrong vector size"):
        store.load_missing_into(spark, "t_lm", mk([(3, [1.0, 0.0, 0.0], 1)]))
    with pytest.raises(Exception, match="wrong vector size"):
        store.upsert_into(spark, "t_lm", mk([(1, [1.0], 9)]))
    with pytest.raises(Exception, match="upsert conflict"):
        store.load_missing_into(spark, "t_lm", mk([(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1)]))
    assert sorted(x.id for x in spark.table("t_lm").collect()) == [1, 2]


def test_existing_table_must_match_in_full(spark, scratch):
    pay = T.StructType([T.StructField("lang", T.StringType())])
    store.get_or_create_table(spark, "t_full", scratch, payload=pay)
    store.get_or_create_table(spark, "t_full", scratch, payload=pay)
    with pytest.raises(ValueError, match="payload"):
        store.get_or_create_table(spark, "t_full", scratch, payload=T.StructType([T.StructField("lang", T.LongType())]))
    with pytest.raises(ValueError, match="id type"):
        store.get_or_create_table(spark, "t_full", scratch, payload=pay, id_type="string")


def test_one_row_per_id(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, x string")
    assert sorted(map(tuple, ingest.one_row_per_id(df).collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="upsert conflict"):
        ingest.one_row_per_id(df.union(spark.createDataFrame([(2, "c")], df.schema))).collect()


def test_clean_rebuild(spark, scratch):
    store.get_or_create_table(spark, "t_clean", scratch)
    store.commit(spark, "t_clean", spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0], 1)],
                                                         "id long, vector array<float>, seq long"))
    assert spark.table("t_clean").count() == 1
    info = store.get_or_create_table(spark, "t_clean", scratch, clean=True)
    assert info.created and spark.table("t_clean").count() == 0


def test_validate_against_declared_sizes(spark, scratch):
    info = store.get_or_create_table(spark, "t_valid", scratch,
                                     vectors={"a": store.VectorParams(2), "b": store.VectorParams(3, "dot")})
    from simsift.sources.tables import literal_points

    df = literal_points(spark, [(1, [1.0, 0.0], [1.0, 1.0, 1.0]), (2, [1.0], None), (3, None, [1.0, None, 1.0]),
                                (4, None, None)], "id long, vec_a array<float>, vec_b array<float>")
    good, bad = store.split_valid(df, info)
    assert sorted(r.id for r in good.collect()) == [1, 4] and sorted(r.id for r in bad.collect()) == [2, 3]
    assert store.validate(good, info).count() == 2
    with pytest.raises(Exception, match="wrong vector size"):
        store.validate(df, info).collect()
