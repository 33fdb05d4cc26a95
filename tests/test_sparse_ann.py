"""Sparse search paths, postings, LSH parameters and recall (KNN-9/10, IDX-3, ANN-*)."""

import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_SMALL
from simsift.functions import filters as flt
from simsift.operators import ann, layout, search, sparse
from simsift.sources import tables

# Invented sparse points; one index above the int32 range.
SPARSE = [
    (1, [1, 2, 3], [0.25, -0.25, 0.25]),
    (2, [1, 5], [0.5, 0.5]),
    (3, [4_000_000_000, 7], [1.0, 2.0]),
    (4, [9], [1.0]),
]


@pytest.fixture(scope="module")
def sp(spark):
    return spark.createDataFrame(
        [(i, (ix, v)) for i, ix, v in SPARSE],
        "id long, sv struct<indices: array<bigint>, values: array<float>>")


def _brute(qi, qv, k):
    q = dict(zip(qi, qv))
    out = []
    for i, ix, v in SPARSE:
        shared = [(a, b) for a, b in zip(ix, v) if a in q]
        if shared:
            out.append((round(sum(b * q[a] for a, b in shared), 6), i))
    out.sort(key=lambda t: (-t[0], t[1]))
    return [(n + 1, i, s) for n, (s, i) in enumerate(out[:k])]


@pytest.mark.parametrize("qi,qv", [([1, 5], [1.0, 2.0]), ([4_000_000_000, 3], [0.5, 1.0]), ([100], [1.0])])
def test_scan_equals_inverted_equals_brute(sp, qi, qv):
    scan = [(r["rank"], r.id, r.score) for r in sparse.knn_scan(sp, "sv", qi, qv, k=3).collect()]
    inv = [(r["rank"], r.id, r.score) for r in sparse.knn_inverted(sparse.to_long(sp, "sv"), qi, qv, k=3).collect()]
    assert sorted(scan) == sorted(inv) == _brute(qi, qv, 3)


def test_long_query_uses_shuffle_join(sp, monkeypatch):
    monkeypatch.setattr(sparse, "MAX_BROADCAST_TERMS", 1)
    got = [(r["rank"], r.id, r.score) for r in
           sparse.knn_inverted(sparse.to_long(sp, "sv"), [1, 5], [1.0, 2.0], k=3).collect()]
    assert sorted(got) == _brute([1, 5], [1.0, 2.0], 3)


def test_sparse_validation(sp, spark):
    assert sp.where(sparse.validate_sparse("sv")).count() == 4
    bad = spark.createDataFrame([(1, ([1, 1], [0.1, 0.2])), (2, ([-1], [0.1])), (3, ([1], [0.1, 0.2]))],
                                "id long, sv struct<indices: array<bigint>, values: array<float>>")
    assert bad.where(sparse.validate_sparse("sv")).count() == 0
    with pytest.raises(ValueError):
        sparse.knn_scan(sp, "sv", [1, 1], [1.0, 1.0])


def test_inverted_index_written_sorted(spark, sp, scratch):
    path = f"{scratch}/inv"
    sparse.build_inverted(sp, "sv", path)
    long = spark.read.parquet(path)
    got = sparse.knn_inverted(long, [1, 5], [1.0, 2.0], k=3).collect()
    assert [(r.id, r.score) for r in got] == [(x[1], x[2]) for x in _brute([1, 5], [1.0, 2.0], 3)]


def test_lsh_params_checked():
    for bad in [dict(bits=3), dict(bits=33), dict(tables=0), dict(radius=9)]:
        with pytest.raises(ValueError):
            ann.LshParams(**bad)
    assert ann.LshParams().bits == ann.DEFAULT_BITS


@pytest.fixture(scope="module")
def pts(spark):
    return tables.vectors(spark, SF_SMALL).join(tables.payload(spark, SF_SMALL), "id").cache()


def test_query_signature_matches_spark(spark, pts):
    params = ann.LshParams(bits=8, tables=3)
    row = pts.where(F.col("id") == 5).collect()[0]
    sigs = {r.table_no: r.sig for r in ann.signatures(pts.where(F.col("id") == 5), params, 64).collect()}
    assert [sigs[t] for t in range(3)] == ann.query_signatures(list(row.vector), params)


def test_recall_rises_and_reaches_one(spark, pts):
    params = ann.LshParams(bits=8, tables=2, radius=1)
    q = [float(x) for x in pts.where(F.col("id") == 3).collect()[0].vector]
    sigs = ann.signatures(pts, params, 64)
    rec = [r.recall for r in ann.recall_by_radius(pts, sigs, q, params, k=10).orderBy("radius").collect()]
    assert rec == sorted(rec) and rec[-1] == 1.0 and len(rec) == 9


def test_full_radius_ann_equals_exact(spark, pts):
    params = ann.LshParams(bits=6, tables=1, radius=6)
    q = [float(x) for x in pts.where(F.col("id") == 7).collect()[0].vector]
    sigs = ann.signatures(pts, params, 64)
    a = [(r.id, r.score) for r in ann.ann_search(pts, sigs, q, params, k=10).orderBy("rank").collect()]
    e = [(r.id, r.score) for r in search.knn(pts, q, k=10).orderBy("rank").collect()]
    assert a == e


def test_filter_restricts_candidates(spark, pts):
    params = ann.LshParams(bits=4, tables=2, radius=4)
    q = [float(x) for x in pts.where(F.col("id") == 1).collect()[0].vector]
    cond = flt.match_value("lang", "en")
    got = ann.ann_search(pts, ann.signatures(pts, params, 64), q, params, k=50, where=cond, keep=("lang",)).collect()
    assert got and all(r.lang == "en" for r in got)


def test_mode_is_the_callers(spark, pts):
    params = ann.LshParams(bits=8, tables=2, radius=0)
    vec, pay = tables.vectors(spark, SF_SMALL), tables.payload(spark, SF_SMALL)
    q = [float(x) for x in pts.where(F.col("id") == 1).collect()[0].vector]
    exact = ann.search_by_mode(vec, pay, None, q, params, mode="exact", k=5).collect()
    assert [r.id for r in exact] == [r.id for r in search.knn(vec, q, k=5).collect()]
    with pytest.raises(ValueError):
        ann.search_by_mode(vec, pay, None, q, params, mode="auto")


def test_radius_widens_to_k(spark, pts):
    params = ann.LshParams(bits=12, tables=1, radius=0)
    vec, pay = tables.vectors(spark, SF_SMALL), tables.payload(spark, SF_SMALL)
    q = [float(x) for x in pts.where(F.col("id") == 1).collect()[0].vector]
    sigs = ann.signatures(vec, params, 64)
    got = ann.ann_search_split(vec, pay, sigs, q, params, k=20).collect()
    assert len(got) == 20 and got[0].radius > 0
    cond = flt.match_value("lang", "fr")
    some = ann.ann_search_split(vec, pay, sigs, q, params, k=10_000, where=cond, keep=("lang",)).collect()
    assert len(some) == vec.join(pay.where(cond), "id", "left_semi").count() and some[0].radius == 12


def test_postings_equal_text_match(spark):
    docs = tables.read_table(spark, SF_SMALL, "documents").select(F.col("doc_id").alias("id"), "text")
    post = layout.postings(docs, "text")
    for query in ["the", "the of", "and with", "zzqx", ""]:
        a = {r.id for r in layout.text_filter(docs, post, query).collect()}
        b = {r.id for r in docs.where(flt.text_match("text", query)).collect()}
        assert a == b, query


def test_contains_and_match_differ(spark):
    df = spark.createDataFrame([(1, "database systems"), (2, "The data, mostly"), (3, "")], "id long, text string")
    assert {r.id for r in df.where(flt.text_contains("text", "data")).collect()} == {1, 2}
    assert {r.id for r in df.where(flt.text_match("text", "DATA")).collect()} == {2}
    assert df.where(flt.text_match("text", " ,, ")).count() == 0


def test_brute_ranking_helper_sane():
    assert brute.ranking([{"id": 1, "vector": [1.0, 0.0]}], [1.0, 0.0], 5) == [(1, 1, 1.0)]


def test_probe_fallback_equals_broadcast_probes(spark, pts, monkeypatch):
    params = ann.LshParams(bits=8, tables=2, radius=2)
    q = [float(x) for x in pts.where(F.col("id") == 11).collect()[0].vector]
    sigs = ann.signatures(pts, params, 64)
    qs = ann.query_signatures(q, params)
    a = {r.id for r in ann.candidates(sigs, qs, params).collect()}
    monkeypatch.setattr(ann, "MAX_PROBES", 0)
    b = {r.id for r in ann.candidates(sigs, qs, params).collect()}
    assert a == b and a
    assert ann.n_probes(params) == 2 * (1 + 8 + 28)


def test_split_ann_equals_joined(spark, pts):
    params = ann.LshParams(bits=6, tables=3, radius=2)
    vec, pay = tables.vectors(spark, SF_SMALL), tables.payload(spark, SF_SMALL, "lang")
    q = [float(x) for x in pts.where(F.col("id") == 4).collect()[0].vector]
    cond = flt.match_value("lang", "en")
    a = ann.ann_search(pts, ann.signatures(pts, params, 64), q, params, k=10, where=cond, keep=("lang",))
    b = ann.ann_search_split(vec, pay, ann.signatures(vec, params, 64), q, params, k=10, where=cond, keep=("lang",))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_written_signatures_search_equals_in_memory(spark, pts, scratch):
    params = ann.LshParams(bits=6, tables=2, radius=1)
    q = [float(x) for x in pts.where(F.col("id") == 9).collect()[0].vector]
    sigs = ann.signatures(pts, params, 64)
    ann.write_signatures(sigs, f"{scratch}/sigs")
    back = spark.read.parquet(f"{scratch}/sigs")
    a = sorted(map(tuple, ann.ann_search(pts, sigs, q, params, k=10).collect()))
    b = sorted(map(tuple, ann.ann_search(pts, back, q, params, k=10).collect()))
    assert a == b and a


def test_arrow_signatures_equal_native(spark, pts):
    params = ann.LshParams(bits=8, tables=3)
    a = sorted(map(tuple, ann.signatures(pts, params, 64).collect()))
    b = sorted(map(tuple, ann.signatures(pts, params, 64, engine="arrow").collect()))
    assert a == b and len(a) == 3 * pts.count()
