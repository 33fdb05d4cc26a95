"""Sparse vectors are counted where a text is read; posting blocks are cut where their postings lie."""

import pytest
from pyspark.sql import functions as F

from simsift.operators import impacts, sparse


TEXTS = [(1, "a b  A c"), (2, "b\tb b"), (3, ""), (4, None), (5, " \n"), (6, "Größe x x")]


@pytest.mark.parametrize("more", [[], [(1, "a d"), (2, None), (None, "a z"), (None, "z q")]])
def test_term_vectors_equal_the_long_form(spark, more):
    df = spark.createDataFrame(TEXTS + more, "doc_id bigint, text string").repartition(3)
    got = sparse.term_vectors(df, "text", "doc_id")
    want = sparse.collect_vectors(sparse.term_counts(df, "text", "doc_id"))
    key = lambda r: (r.id is None, r.id)                               # noqa: E731
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key) and got.dtypes == want.dtypes
    assert bool(more) == _shuffled_by(got, "id")                         # only texts that share an id meet


def _shuffled_by(df, key):
    return f"hashpartitioning({key}#" in df._jdf.queryExecution().executedPlan().toString()


def test_blocks_are_cut_where_they_lie(spark):
    rows = [(i % 3, i, float(1 + i * 7 % 50)) for i in range(2000)]
    long = spark.createDataFrame(rows, "idx bigint, id bigint, val float").repartition(5)
    blocks = impacts.posting_blocks(long, block_rows=16)
    assert not _shuffled_by(blocks, "idx")
    told = blocks.orderBy("idx", "block").collect()
    back = sorted((r.idx, e.id, e.val) for r in told for e in r.entries)
    assert back == sorted(rows)
    for i in range(3):
        mine = [r for r in told if r.idx == i]
        assert [r.block for r in mine] == list(range(mine[0].block, mine[0].block + len(mine)))
        flat = [e for r in mine for e in r.entries]
        assert [(-e.val, e.id) for e in flat] == sorted((-e.val, e.id) for e in flat)
        assert all(r.top == max(e.val for e in r.entries) and r.least == min(e.val for e in r.entries) <= r.top
                   and len(r.entries) <= 16 for r in mine)
    assert blocks.where(F.size("entries") == 16).count() > 100
