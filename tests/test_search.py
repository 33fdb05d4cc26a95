"""Dense search on small invented fixtures against brute force (KNN-1..8, 11)."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import brute
from simsift.functions import filters as flt
from simsift.functions.vectors import valid_vector
from simsift.operators import search
from simsift.operators.knn_join import knn_join

# Invented catalogue: 8 items, 4-dim vectors, a keyword and a price.
ITEMS = [
    (1, [0.7, 0.2, 0.2, 0.6], "gadgets", 250),
    (2, [0.1, 0.8, 0.7, 0.4], "media", 15),
    (3, [0.6, 0.4, 0.1, 0.8], "gadgets", 95),
    (4, [0.3, 0.7, 0.4, 0.8], "gadgets", 170),
    (5, [0.8, 0.8, 0.6, 0.2], "gadgets", 25),
    (6, [0.8, 0.5, 0.7, 0.2], "home", 30),
    (7, [0.8, 0.2, 0.5, 0.1], "home", 9),
    (8, [0.8, 0.5, 0.6, 0.6], "gadgets", 60),
]
QUERY = [0.75, 0.25, 0.15, 0.85]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "id long, vector array<float>, category string, price int")



def _rows(df):
    return [(r["rank"], r["id"], r["score"]) for r in df.orderBy("rank").collect()]


def _f32(v):
    import numpy as np
    return [float(np.float32(x)) for x in v]


def _pts():
    return [{"id": i, "vector": _f32(v), "category": c, "price": p} for i, v, c, p in ITEMS]


def test_default_limit_returns_all_when_fewer(items):
    got = _rows(search.knn(items, QUERY))
    assert got == brute.ranking(_pts(), QUERY, 10)
    assert len(got) == 8


def test_top1_and_topk(items):
    assert _rows(search.knn(items, QUERY, k=1)) == brute.ranking(_pts(), QUERY, 1)
    assert _rows(search.knn(items, QUERY, k=3)) == brute.ranking(_pts(), QUERY, 3)


def test_filter_before_ranking(items):
    cond = flt.must(flt.match_value("category", "gadgets"))
    got = _rows(search.knn(items, QUERY, k=3, where=cond))
    assert got == brute.ranking(_pts(), QUERY, 3, where=lambda p: p["category"] == "gadgets")
    # filtered top-k == filter of the full ranking
    full = [r for r in brute.ranking(_pts(), QUERY, 10) if r[1] in {1, 3, 4, 5, 8}][:3]
    assert [(x[1], x[2]) for x in got] == [(x[1], x[2]) for x in full]


def test_range_and_keyword(items):
    cond = flt.must(flt.match_value("category", "gadgets"), flt.range_("price", gte=60))
    got = _rows(search.knn(items, QUERY, k=10, where=cond))
    assert {r[1] for r in got} == {1, 3, 4, 8}


def test_no_match_is_empty(items):
    assert search.knn(items, QUERY, where=flt.match_value("category", "none")).count() == 0


def test_dot_metric(items):
    assert _rows(search.knn(items, QUERY, metric="dot", k=4)) == brute.ranking(_pts(), QUERY, 4, metric="dot")


def test_zero_wrong_size_null_vectors_never_hit(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0]), (3, None), (4, [1.0, 1.0])],
                               "id long, vector array<float>")
    got = _rows(search.knn(df, [1.0, 0.5], k=10))
    assert [r[1] for r in got] == [4]
    assert df.where(valid_vector("vector", 2)).count() == 2


def test_ties_break_by_id(spark):
    df = spark.createDataFrame([(9, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [2.0, 0.0])], "id long, vector array<float>")
    assert [r[1] for r in _rows(search.knn(df, [1.0, 0.0], k=2))] == [3, 5]


def test_grouped(spark, items):
    got = search.knn_grouped(items, QUERY, group_by="category", limit=2, group_size=2).collect()
    full = brute.ranking(_pts(), QUERY, 10)
    cat = {i: c for i, _, c, _ in ITEMS}
    best = {}
    for _, pid, s in full:
        best.setdefault(cat[pid], []).append((pid, s))
    order = sorted(best, key=lambda c: (-best[c][0][1], best[c][0][0]))[:2]
    exp = {(gi + 1, c, hi + 1, pid, s) for gi, c in enumerate(order) for hi, (pid, s) in enumerate(best[c][:2])}
    assert {(r.group_rank, r.group_id, r.hit_rank, r.id, r.score) for r in got} == exp


def test_grouped_drops_null_group(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], None), (2, [0.9, 0.1], "a")], "id long, vector array<float>, g string")
    got = search.knn_grouped(df, [1.0, 0.0], group_by="g", limit=5).collect()
    assert [(r.group_id, r.id) for r in got] == [("a", 2)]


def test_named_vector_null_never_enters(spark):
    df = spark.createDataFrame([Row(id=1, vec_a=[1.0, 0.0], vec_b=None), Row(id=2, vec_a=None, vec_b=[1.0, 0.0, 0.0])],
                               "id long, vec_a array<float>, vec_b array<float>")
    got = search.search_and_inspect(df, [1.0, 0.0], "a", k=3).collect()
    assert [(r.id, r.score_text) for r in got] == [(1, "1.0000")]


def test_by_strategy_equals_separate_searches(spark, items):
    long = items.select("id", F.inline(F.array(
        F.struct(F.lit("full").alias("strategy"), F.col("vector").alias("vector")),
        F.struct(F.lit("half").alias("strategy"), F.slice("vector", 1, 2).alias("vector")))))
    qs = {"full": QUERY, "half": QUERY[:2]}
    got = search.knn_by_strategy(long, qs, k=3).collect()
    for s, q in qs.items():
        sub = [r for r in got if r.strategy == s]
        exp = _rows(search.knn(long.where(F.col("strategy") == s), q, k=3))
        assert sorted((r["rank"], r.id, r.score) for r in sub) == exp


def test_knn_join_equals_single_queries(spark, items):
    queries = spark.createDataFrame([(0, QUERY), (1, [0.1, 0.9, 0.8, 0.3]), (2, [0.0, 0.0, 0.0, 0.0])],
                                    "qid long, vector array<double>")
    got = knn_join(items, queries, k=3).collect()
    for qid, q in [(0, QUERY), (1, [0.1, 0.9, 0.8, 0.3])]:
        exp = brute.ranking(_pts(), q, 3)
        assert sorted((r["rank"], r.id, r.score) for r in got if r.qid == qid) == exp
    assert not [r for r in got if r.qid == 2]          # zero query: no hits


def test_knn_join_blocks(spark, items):
    queries = spark.createDataFrame([(i, [float(i % 3), 1.0, 0.5, float(i % 5)]) for i in range(1, 12)],
                                    "qid long, vector array<double>")
    one = sorted(tuple(r) for r in knn_join(items, queries, k=2).collect())
    many = sorted(tuple(r) for r in knn_join(items, queries, k=2, block_rows=3).collect())
    assert one == many and len(one) == 22


def test_score_split_both_plans_equal(spark, items, monkeypatch):
    vec = items.select("id", "vector")
    pay = items.select("id", "category", "price")
    cond = flt.match_value("category", "gadgets")
    a = _rows(search.top_k(search.score_split(vec, pay, QUERY, where=cond, keep=("category",)), 3,
                           keep=("category",)))
    monkeypatch.setattr(search, "MAX_BROADCAST_BYTES", 0)
    b = _rows(search.top_k(search.score_split(vec, pay, QUERY, where=cond, keep=("category",)), 3,
                           keep=("category",)))
    assert a == b == brute.ranking(_pts(), QUERY, 3, where=lambda p: p["category"] == "gadgets")


def test_write_results_json(spark, items, scratch):
    import json

    hits = search.knn(items, QUERY, k=3, keep=("category", "price"))
    search.write_results_json(hits, ["category", "price"], f"{scratch}/out")
    lines = [json.loads(r.value) for r in spark.read.text(f"{scratch}/out").collect()]
    assert [x["id"] for x in lines] == [r[1] for r in brute.ranking(_pts(), QUERY, 3)]
    assert set(lines[0]) == {"id", "score", "payload"} and set(lines[0]["payload"]) == {"category", "price"}


def test_large_k_distributed_ranking_is_exact(spark, items, monkeypatch):
    monkeypatch.setattr(search, "MAX_SINGLE_MERGE_K", 2)
    got = _rows(search.knn(items, QUERY, k=5))
    assert got == brute.ranking(_pts(), QUERY, 5)
    assert _rows(search.knn(items, QUERY, k=50)) == brute.ranking(_pts(), QUERY, 50)


def test_check_query_dimension():
    from simsift.functions.vectors import check_query

    assert check_query([1, 2], 2) == [1.0, 2.0]
    with pytest.raises(ValueError):
        check_query([1, 2, 3], 2)


def test_search_and_inspect_formats(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 3.46), (2, [0.6, 0.8], 4.0)], "id long, vec_a array<float>, rating double")
    for engine in ("native", "arrow"):
        got = search.search_and_inspect(df, [1.0, 0.0], "a", k=3, keep=("rating",), formats={"rating": "%.1f"},
                                        engine=engine)
        rows = sorted((r["rank"], r.score_text, r.rating_text) for r in got.collect())
        assert rows == [(1, "1.0000", "3.5"), (2, "0.6000", "4.0")]


def test_random_vectors_with_ties_and_zeros(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    base = rng.integers(-3, 4, size=(60, 6)).astype(float)
    base[10] = base[3]                     # exact duplicates -> tied scores
    base[11] = base[3]
    base[20] = 0.0                         # zero vector -> never a hit
    rows = [(i, [float(x) for x in v] if i != 30 else None, "g" + str(i % 4)) for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "id long, vector array<float>, g string")
    pts = [{"id": i, "vector": v, "g": g} for i, v, g in rows]
    queries = [list(map(float, base[3])), list(map(float, rng.normal(size=6))), [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]]
    for metric in ("cosine", "dot"):
        for q in queries:
            exp = brute.ranking(pts, q, 12, metric=metric)
            assert _rows(search.knn(df, q, k=12, metric=metric)) == exp
            split = search.score_split(df.select("id", "vector"), df.select("id", "g"), q, metric=metric)
            assert _rows(search.top_k(split, 12)) == exp
    qdf = spark.createDataFrame([(j, q) for j, q in enumerate(queries)], "qid long, vector array<double>")
    got = knn_join(df, qdf, k=12).collect()
    for j, q in enumerate(queries):
        assert sorted((r["rank"], r.id, r.score) for r in got if r.qid == j) == brute.ranking(pts, q, 12)


def test_arrow_scoring_engine_equals_native(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    vecs = rng.normal(size=(80, 48))
    vecs[5] = 0.0
    rows = [(i, [float(x) for x in v] if i != 7 else [1.0, 2.0], f"c{i % 3}") for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "id long, vector array<float>, c string")
    q = [float(x) for x in rng.normal(size=48)]
    for metric in ("cosine", "dot"):
        for where in (None, flt.match_value("c", "c1")):
            a = _rows(search.top_k(search.score_split(df.select("id", "vector"), df.select("id", "c"), q,
                                                      where=where, metric=metric), 15))
            b = _rows(search.top_k(search.score_split(df.select("id", "vector"), df.select("id", "c"), q,
                                                      where=where, metric=metric, engine="arrow"), 15))
            assert a == b and len(a) == 15


def test_knn_arrow_engine_with_payload(items):
    cond = flt.match_value("category", "gadgets")
    a = search.knn(items, QUERY, k=4, where=cond, keep=("category", "price")).collect()
    b = search.knn(items, QUERY, k=4, where=cond, keep=("category", "price"), engine="arrow").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 4


def test_grouped_arrow_engine(items):
    a = search.knn_grouped(items, QUERY, group_by="category", limit=2, group_size=2).collect()
    b = search.knn_grouped(items, QUERY, group_by="category", limit=2, group_size=2, engine="arrow").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and a


def test_payload_is_optional_and_fetched_for_hits_only(spark, items):
    """Every vector is searched; a hit without payload keeps NULLs."""
    pay = items.where("id <> 2").select("id", "category")
    got = {r.id: r.category for r in search.top_k(search.score_split(items.select("id", "vector"), pay, QUERY),
                                                  100, payload=pay).collect()}
    assert set(got) == {r.id for r in items.collect()} and got[2] is None
    kept = search.score_split(items.select("id", "vector"), pay, QUERY, keep=("category",)).collect()
    assert len(kept) == items.count()


def test_knn_join_ties_follow_the_rounded_score(spark):
    """0.4731885 and 0.473189 round to one score, so the smaller id wins, as in a single search."""
    rows = [(1, [0.4731885, 0.0]), (2, [0.473189, 0.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.0])], "qid long, vector array<double>")
    one = search.knn(df, [1.0, 0.0], metric="dot", k=1).collect()[0]
    for block in (1, 100):
        got = knn_join(df, q.union(q.selectExpr("qid + 1", "vector")), k=1, metric="dot", block_rows=block,
                       point_block_rows=1).collect()
        assert [(r.id, r.score) for r in got] == [(one.id, one.score)] * 2


def test_results_json_keeps_null_fields(spark):
    hits = spark.createDataFrame([(1, 5, 0.5, None)], "rank long, id long, score double, lang string")
    assert search.results_as_json(hits, ["lang"]).collect()[0].json == '{"id":5,"score":0.5,"payload":{"lang":null}}'


def test_worker_functions_do_not_need_the_package():
    """What runs on executors loads where this package is not on the path."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from simsift.operators import chunking, knn_join as kj

    for fn in (kj._functions(3, "cosine")[1], chunking._semantic_pass(0.95, 64)):
        code = ("import pickle, sys; from pyspark import cloudpickle; "
                f"f = pickle.loads(bytes.fromhex('{cloudpickle.dumps(fn).hex()}')); "
                "assert not any(m.startswith('simsift') for m in sys.modules); print('loaded')")
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd="/", env={"PATH": ""})
        assert out.stdout.strip() == "loaded", out.stderr
