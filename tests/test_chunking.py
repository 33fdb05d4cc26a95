"""Chunkers against brute-force Python on invented texts and on sf0.001 documents."""

import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_SMALL
from simsift.functions import text as tx
from simsift.operators import chunking as ch

TEXTS = [
    "",
    "   ",
    "One short sentence.",
    "Alpha beta gamma. Delta epsilon! Zeta eta theta? Iota kappa lambda mu.",
    "no terminal punctuation at all just words " * 30,
    "Tiny. " * 120,
    "A very long sentence " + "word " * 700 + "ends here. Then a short one. And more text follows here!",
    "Mixed\nlines. With\ttabs and  double  spaces.  Next sentence here. " * 15,
]


def _df(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")


def _collect(df, key="id"):
    out = {}
    for r in df.orderBy(key, "chunk_index").collect():
        out.setdefault(r[key], []).append(r["chunk"])
    return out


@pytest.mark.parametrize("size", [1, 7, 64, 256])
def test_fixed_matches_brute(spark, size):
    got = _collect(ch.fixed_chunks(_df(spark, TEXTS), "text", size=size))
    for i, t in enumerate(TEXTS):
        assert got.get(i, []) == brute.fixed_chunks(t, size)


def test_fixed_concat_restores_tokens(spark):
    got = _collect(ch.fixed_chunks(_df(spark, TEXTS), "text", size=5))
    for i, t in enumerate(TEXTS):
        assert " ".join(got.get(i, [])).split() == brute.tokens(t)


@pytest.mark.parametrize("size,overlap", [(16, 40), (64, 10), (256, 40), (3, 40)])
def test_sentence_matches_brute(spark, size, overlap):
    got = _collect(ch.sentence_chunks(_df(spark, TEXTS), "text", size=size, overlap=overlap))
    for i, t in enumerate(TEXTS):
        assert got.get(i, []) == brute.sentence_chunks(t, size, overlap), i


def test_sentence_chunks_fit_budget(spark):
    df = ch.sentence_chunks(_df(spark, TEXTS), "text", size=20)
    assert df.where(tx.n_tokens("chunk") > 20).count() == 0
    assert df.where(tx.n_tokens("chunk") == 0).count() == 0


@pytest.mark.parametrize("method", ["arrow", "native"])
def test_semantic_matches_brute(spark, method):
    got = _collect(ch.semantic_chunks(_df(spark, TEXTS), "text", key="id", method=method))
    for i, t in enumerate(TEXTS):
        assert got.get(i, []) == (brute.semantic_chunks(t) if brute.tokens(t) else []), i


def test_chunkers_on_real_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    texts = {r.id: r.text for r in docs.collect()}
    sen = _collect(ch.sentence_chunks(docs, "text", size=64, overlap=10))
    sem = _collect(ch.semantic_chunks(docs, "text", key="id"))
    nat = _collect(ch.semantic_chunks(docs, "text", key="id", method="native"))
    for i, t in texts.items():
        assert sen.get(i, []) == brute.sentence_chunks(t, 64, 10), i
        assert sem.get(i, []) == nat.get(i, []) == brute.semantic_chunks(t), i


def test_column_valued_budget(spark):
    df = spark.createDataFrame([(1, TEXTS[3], 2), (2, TEXTS[3], 5)], "id long, text string, b int")
    got = _collect(ch.fixed_chunks(df, "text", size=F.col("b")))
    assert got[1] == brute.fixed_chunks(TEXTS[3], 2)
    assert got[2] == brute.fixed_chunks(TEXTS[3], 5)


def test_token_report(spark):
    df = _df(spark, ["a b c", "", "x " * 300])
    rows = {r.id: r for r in ch.token_report(df, "text").collect()}
    assert (rows[0].n_tokens, rows[0].excess, rows[0].over_limit) == (3, 0, False)
    assert rows[1].n_tokens == 0
    assert (rows[2].n_tokens, rows[2].excess, rows[2].over_limit) == (300, 44, True)


@pytest.mark.parametrize("method", ["native", "arrow"])
def test_semantic_carries_keep_columns(spark, method):
    df = spark.createDataFrame([(i, t, f"tag{i}") for i, t in enumerate(TEXTS)], "id long, text string, tag string")
    rows = ch.semantic_chunks(df, "text", key="id", keep=("tag",), method=method).collect()
    assert rows and all(r.tag == f"tag{r.id}" for r in rows)
    assert {r.id for r in rows} == {i for i, t in enumerate(TEXTS) if brute.tokens(t)}


def _random_texts(n=300, seed=7):
    import random

    rnd = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "DELTA", "x", "yy", "zzz", "über", "año", "1999", "a.b", "?!"]
    ends = [".", "!", "?", "", ",", "..."]
    spaces = [" ", "  ", "\n", "\t", " \n "]
    out = []
    for _ in range(n):
        parts = []
        for _s in range(rnd.randint(0, 30)):
            length = rnd.choice([1, 2, 5, 12, 40, 300])
            sent = " ".join(rnd.choice(words) for _ in range(length)) + rnd.choice(ends)
            parts.append(sent)
        out.append("".join(p + rnd.choice(spaces) for p in parts))
    return out


@pytest.mark.parametrize("size,overlap", [(1, 40), (7, 3), (50, 40), (256, 40)])
def test_random_texts_match_brute(spark, size, overlap):
    texts = _random_texts()
    df = _df(spark, texts)
    fx = _collect(ch.fixed_chunks(df, "text", size=size))
    sn = _collect(ch.sentence_chunks(df, "text", size=size, overlap=overlap))
    for i, t in enumerate(texts):
        assert fx.get(i, []) == brute.fixed_chunks(t, size), i
        assert sn.get(i, []) == brute.sentence_chunks(t, size, overlap), i


def test_random_texts_semantic_match_brute(spark):
    texts = _random_texts(seed=11)
    got = _collect(ch.semantic_chunks(_df(spark, texts), "text", key="id"))
    for i, t in enumerate(texts):
        assert got.get(i, []) == (brute.semantic_chunks(t) if brute.tokens(t) else []), i
