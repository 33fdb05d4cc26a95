"""Physical-plan properties of the registered queries, with broadcasts decided by size off.

Both auto-broadcast thresholds are -1, which stands in for tables beyond any
threshold: only broadcasts that the code itself sizes remain. Plans are the final
ones, after the query ran.
"""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


@pytest.fixture()
def no_auto_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def plan(spark, name):
    df = entry.queries()[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


SEARCHES = ["knn_filtered", "knn_cosine", "knn_dot", "knn_named", "knn_grouped", "knn_group_best", "knn_multi_strategy",
            "filter_text_contains", "filter_text_match", "results_json", "postings_search", "ann_search", "ann_filtered",
            "ann_switch", "knn_batch"]


@pytest.mark.parametrize("name", SEARCHES)
def test_no_table_is_shuffled_by_a_search(spark, no_auto_broadcast, name):
    p = plan(spark, name)
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p, p
    # neither vectors, nor texts, nor the ids of a whole table are dealt by id
    assert not re.search(r"hashpartitioning\((vec_id|doc_id|id)#", p), p
    assert "RoundRobin" not in p and "SinglePartition" not in p.replace("SinglePartition, ENSURE_REQUIREMENTS", ""), p


@pytest.mark.parametrize("name", ["knn_grouped", "knn_multi_strategy", "knn_batch"])
def test_group_limits_are_partial_before_shuffle(spark, no_auto_broadcast, name):
    from simsift.operators import search

    df = entry.queries()[name](spark, SF)
    if name == "knn_grouped":                    # ranked groups arrive as a small fetched table
        from simsift.plans.search_queries import split_scores

        df = search.top_k_per(split_scores(spark, SF, keep=("source",)), "source", 2)
    assert df._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["chunk_fixed", "chunk_sentence", "token_report", "text_features", "chunk_semantic",
                                  "chunk_union"])
def test_per_document_work_has_no_exchange(spark, no_auto_broadcast, name):
    assert "Exchange" not in plan(spark, name)


def test_filters_reach_the_scan(spark):
    p = plan(spark, "ann_switch")
    assert "SortMergeJoin" not in p
    docs = entry.queries()["load_missing"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in docs      # text pruned


def test_stored_sparse_index_is_pruned(spark, no_auto_broadcast):
    from simsift.operators import sparse
    from simsift.plans.index_queries import TEXT_QUERY, sparse_terms

    qi, qv = sparse.query_terms(TEXT_QUERY)
    p = sparse.knn_inverted(sparse_terms(spark, SF), qi, qv)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and re.search(r"PushedFilters: \[[^\]]*In\(idx", p), p


def test_stored_postings_are_pruned(spark):
    from simsift.operators import layout
    from simsift.plans.feature_queries import MATCH_QUERY
    from simsift.sources import indexes, tables

    docs = tables.read_table(spark, SF, "documents")
    post = indexes.stored(spark, "postings", SF, lambda path: layout.write_postings(
        layout.postings(docs, "text", id_col="doc_id"), path))
    p = layout.match_ids(post, MATCH_QUERY)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*In\(token", p), p


def test_upsert_aggregates_narrow_rows(spark, no_auto_broadcast):
    p = plan(spark, "upsert_latest")
    aggs = re.findall(r"(\w+Aggregate)\(keys=\[([^\]]*)\], functions=\[([^\]]*)", p)
    assert any(a == "HashAggregate" and "min(_h" in f for a, _, f in aggs), aggs
