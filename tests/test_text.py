"""Native text functions against Python semantics (PRJ-1/2/4/5/6/7, EMB-1/2/3)."""

import uuid

import pytest
from pyspark.sql import functions as F

from simsift.functions import text as tx
from simsift.operators import embed, search


def test_uuid5_matches_python(spark):
    keys = ["1|fixed|0", "42|semantic|17", "ünïcødé|sentence|3", "", "a" * 300]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r.u for r in df.select(tx.uuid5("k").alias("u")).collect()]
    assert got == [str(uuid.uuid5(tx.POINT_ID_NAMESPACE, k)) for k in keys]


def test_point_id(spark):
    df = spark.createDataFrame([(7, "fixed", 2)], "rid long, ch string, i int")
    got = df.select(tx.point_id("rid", "ch", "i").alias("p")).collect()[0].p
    assert got == str(uuid.uuid5(tx.POINT_ID_NAMESPACE, "7|fixed|2"))


def test_has_numbers_matches_isdigit(spark):
    cps = [c for c in range(0x30000) if not (0xD800 <= c <= 0xDFFF)]
    df = spark.createDataFrame([(c, chr(c)) for c in cps], "cp int, ch string")
    got = {r.cp for r in df.where(tx.has_numbers("ch")).select("cp").collect()}
    exp = {c for c in cps if chr(c).isdigit()}
    missing, extra = exp - got, got - exp
    # characters newer than the JVM's Unicode tables cannot match; nothing may match wrongly
    assert not extra
    assert len(missing) <= 40, sorted(missing)[:20]


def test_length_counts_code_points(spark):
    df = spark.createDataFrame([("héllo😀",)], "t string")
    assert df.select(tx.text_length("t")).collect()[0][0] == len("héllo😀")


def test_menu_text(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["Dumplings", "Tea"])], "id long, m array<string>")
    out = {r.id: (r.menu, r.full, r.budget) for r in df.select(
        "id", tx.menu_highlights("m").alias("menu"),
        tx.prepend_menu(F.lit("Body text."), tx.menu_highlights("m")).alias("full"),
        tx.chunk_budget(tx.menu_highlights("m")).alias("budget")).collect()}
    assert out[1] == ("", "Body text.", 256)
    assert out[2] == ("", "Body text.", 256)
    assert out[3] == ("Menu highlights: Dumplings, Tea.", "Menu highlights: Dumplings, Tea.\n\nBody text.", 252)


def test_budget_never_below_one(spark):
    df = spark.createDataFrame([(" ".join(["w"] * 400),)], "m string")
    assert df.select(tx.chunk_budget("m")).collect()[0][0] == 1


def test_hashing_embedder_spark_equals_python(spark):
    texts = ["The quick brown fox", "", "repeat repeat REPEAT words", "Ünïcode Wörter hier"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: list(r.vector) for r in embed.embed(df, "text", ["id"], dim=64).collect()}
    nat = {r.id: list(r.vector) for r in embed.embed(df, "text", ["id"], dim=64, method="native").collect()}
    for i, t in enumerate(texts):
        assert got[i] == nat[i] == embed.embed_query(spark, t, dim=64)
    assert got[1] == [0.0] * 64


def test_empty_query_finds_nothing(spark):
    df = spark.createDataFrame([(1, "some text here")], "id long, text string")
    pts = embed.embed(df, "text", ["id"], dim=32)
    assert search.knn(pts, embed.embed_query(spark, "", dim=32), k=3).count() == 0


def test_query_embedding_fallback():
    def broken(_):
        raise RuntimeError("no service")

    with pytest.raises(RuntimeError):
        embed.query_embedding("q", broken, dim=8)
    v, status = embed.query_embedding("q", broken, dim=8, fallback=True)
    assert status == "fallback" and len(v) == 8
    assert v == embed.query_embedding("q", broken, dim=8, fallback=True)[0]
    v2, status2 = embed.query_embedding("q", lambda t: [1.0] * 8, dim=8)
    assert status2 == "ok" and v2 == [1.0] * 8


def test_external_model_interface(spark):
    import numpy as np

    def make_model():
        def predict(texts):
            return np.stack([embed.embed_query(None, str(t), dim=16) for t in texts]).astype(np.float32)
        return predict

    df = spark.createDataFrame([(1, "alpha beta"), (2, "gamma")], "id long, text string")
    got = {r.id: list(r.vector) for r in embed.embed_with_model(df, "text", make_model, dim=16).collect()}
    assert got[1] == embed.embed_query(None, "alpha beta", dim=16)
