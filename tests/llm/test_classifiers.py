"""Language identification and toxicity: held-out accuracy and awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers_llm import awkward, empty
from simsift.llm import langid, registry, toxicity
from simsift.llm import queries  # noqa: F401
from simsift.llm.common import crc_bucket

SF = SF_SMALL.replace("0.001", "0.01")


def test_windows_cover_every_byte():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 255, 256, 257, 1000]
    off = np.concatenate([[0], np.cumsum(sizes)])
    raw = rng.integers(0, 255, off[-1]).astype(np.uint8)
    win, rows = langid.cut_windows(raw, off)
    for i, n in enumerate(sizes):
        mine = win[rows == i]
        assert len(mine) == max(1, -(-n // langid.WINDOW))
        got = b"".join(w[w != langid.PAD].astype(np.uint8).tobytes() for w in mine)
        text = raw[off[i]:off[i + 1]].tobytes()
        assert got[:len(got) - len(mine[-1][mine[-1] != langid.PAD])] == text[:(len(mine) - 1) * langid.WINDOW]
        assert got.endswith(text[-min(n, langid.WINDOW):] if n else b"")


def test_convolution_equals_plain_loops():
    rng = np.random.default_rng(1)
    win = rng.integers(0, 256, (2, langid.WINDOW)).astype(np.int16)
    model = langid.train(win, np.array([0, 1]), 2, epochs=1)
    got = langid.pooled(model, win)
    at = 0
    for width in langid.WIDTHS:
        for f in range(langid.FILTERS):
            for w in range(2):
                best = max(float((model["emb"][win[w, s:s + width]].ravel() * model[f"f{width}"][:, f]).sum())
                           for s in range(langid.WINDOW - width + 1))
                assert abs(got[w, at] - max(0, best + model[f"b{width}"][f])) < 1e-4
            at += 1


def test_language_held_out_accuracy(spark):
    out = registry.QUERIES["op1_langid"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    rows = out.join(truth, "doc_id").where("held_out and n > 100").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    df = awkward(spark)
    out = langid.detect_languages(df, F.lit(True)).collect()
    assert len(out) == df.count()
    for r in out:
        assert r.lang_pred in ("en", "fr", "und")
    und = df.where(F.col("text").isNull() | ~F.col("text").rlike("\\p{L}")).count()
    assert sum(r.lang_pred == "und" for r in out) == und == 3
    assert langid.detect_languages(empty(spark), F.lit(True)).collect() == []
    assert {r.lang_pred for r in langid.detect_languages(df, F.lit(False)).collect()} == {"und"}


def test_subsequence_sums_equal_plain_kernel():
    """Folded weights give the same decision as kernels with the landmarks."""
    rng = np.random.default_rng(2)
    words = [bytes(rng.integers(1, 5, int(rng.integers(1, 9))).astype(np.uint8)) for _ in range(40)]

    def features(w):
        w = b"\0" + w + b"\0"
        out = {}
        for i in range(len(w)):
            for k in range(i + 2, min(len(w), i + toxicity.SPAN)):
                for j in range(i + 1, k):
                    key = (w[i], w[j], w[k])
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        n = len(w)
        norm = sum(toxicity.DECAY ** (2 * (k + 1)) for i in range(n) for k in range(2, toxicity.SPAN)
                   if i + k < n for _ in range(1, k)) ** 0.5 or 1.0
        return {k: v / norm for k, v in out.items()}

    weight = rng.normal(0, 1, toxicity.SYMBOLS ** 3).astype(np.float32)
    sym, starts = toxicity.frame(words)
    got = toxicity.word_sums(sym, starts, weight)
    for w, g in zip(words, got):
        want = sum(v * weight[a * toxicity.SYMBOLS ** 2 + b * toxicity.SYMBOLS + c] for (a, b, c), v in features(w).items())
        assert abs(g - want) < 1e-4


def test_word_symbols_join_single_letters():
    raw = np.frombuffer("You i d i o t\nÉté x".encode(), np.uint8)
    sym, starts, row = toxicity.word_symbols(raw, np.array([0, len(raw)]))
    words = [bytes(sym[a + 1:b - 1]) for a, b in zip(starts, starts[1:])]
    assert words[1] == bytes([9, 4, 9, 15, 20])
    assert len(words) == 4 and list(row) == [0] * 4
    low = np.frombuffer("été".encode(), np.uint8)
    assert words[2] == bytes(toxicity.word_symbols(low, np.array([0, len(low)]))[0][1:-1])


@pytest.mark.parametrize("insult", ["idiot", "nincompooptwit"])
@pytest.mark.parametrize("spaced", [False, True])
def test_insult_at_every_offset_of_a_long_word(insult, spaced):
    table = toxicity.symbol_table()
    code = lambda t: bytes(table[np.frombuffer(t.encode(), np.uint8)])
    weight = np.zeros(toxicity.SYMBOLS ** 3, np.float32)
    bad = np.frombuffer(code(insult), np.uint8).astype(np.int64)
    for j, k in toxicity.PAIRS:
        for i in range(len(bad) - k):
            weight[(bad[i] * toxicity.SYMBOLS + bad[i + j]) * toxicity.SYMBOLS + bad[i + k]] = 1
    net = {"beta": weight, "bias": 0.0, "b": 0.0}
    whole = toxicity.word_sums(*toxicity.frame([code("xyz" + insult + "x" * (21 - len(insult)))]), weight)[0]
    for offset in range(80):
        word = "x" * offset + insult + "x" * (80 - offset)
        raw = np.frombuffer((" ".join(word) if spaced else word).encode(), np.uint8)
        sym, starts, row = toxicity.word_symbols(raw, np.array([0, len(raw)]))
        parts = [sym[a:b].tobytes() for a, b in zip(starts, starts[1:])]
        assert any(code(insult) in p for p in parts) and max(map(len, parts)) <= toxicity.PIECE + 2
        assert sum(p.count(0) for p in parts) == 2 and parts[0][0] == parts[-1][-1] == 0
        assert [toxicity.framed(toxicity.unframed(p)) for p in parts] == parts
        assert toxicity.worst_words(net, raw, np.array([0, len(raw)]))[0] >= whole - 1e-5


def test_toxicity_held_out(spark):
    """Every language has the same bound on false alarms; a label that no word bears out cannot be found."""
    sf = SF_SMALL.replace("0.001", "0.1")
    out = registry.QUERIES["op8_toxicity"](spark, sf).cache()
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    rows = out.join(labels, "doc_id").join(docs, "doc_id").collect()
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    for lang in {r.lang for r in rows}:
        for held in (True, False):
            clean = [r.predicted for r in rows if r.lang == lang and r.toxic == 0 and r.held_out == held]
            assert len(clean) > 50 and np.mean(clean) < 0.02
    insults = "trash idiot pathetic worthless loser disgusting scum moron clown stupid".split()
    toxic = [r for r in rows if r.held_out and r.toxic == 1]
    found = [r for r in toxic if any(w in r.text.lower() for w in insults)]
    assert len(found) > 40 and np.mean([r.predicted for r in found]) > 0.95
    english = [r.predicted for r in toxic if r.lang == "en"]
    assert len(english) > 50 and np.mean(english) > 0.85        # some labels mark texts without an insult
    assert out.where("predicted = 1").join(docs, "doc_id").where("lang <> 'en'").count() < 40


def test_labels_without_evidence_teach_nothing():
    rng = np.random.default_rng(5)
    docs = [[bytes(rng.integers(1, 27, 6).astype(np.uint8)) for _ in range(30)] for _ in range(200)]
    assert toxicity.fit_sample(docs, (np.arange(200) % 5 == 0).astype(int)) is None
    assert toxicity.chance(3, 1, 0.5) == pytest.approx(5 / 16)
    assert toxicity.chance(0, 4, 0.3) == pytest.approx(1)


@pytest.mark.parametrize("text", ["you IDIOT", "an id-iot", "i d i o t", "such an idi.ot"])
def test_toxicity_tolerates_insertions(text):
    docs, y = [], []
    clean = [b"the", b"road", b"river", b"idea", b"radio", b"edition", b"patio", b"idle", b"riot"]
    table = toxicity.symbol_table()
    word = lambda w: bytes(table[np.frombuffer(w, np.uint8)])
    for i in range(60):
        docs.append([word(clean[i % 9]), word(clean[(i * 5 + 1) % 9])] + ([word(b"idiot")] if i % 2 else []))
        y.append(i % 2)
    model = toxicity.fit_sample(docs, np.array(y))
    raw = np.frombuffer(text.encode(), np.uint8)
    assert toxicity.worst_words(model, raw, np.array([0, len(raw)]))[0] >= model["b"]
    calm = np.frombuffer(b"the river road to the edition", np.uint8)
    assert toxicity.worst_words(model, calm, np.array([0, len(calm)]))[0] < model["b"]


def test_toxicity_of_awkward_rows(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(0, 1), (3, 0), (6, None), (None, 1), (9, 0), (9, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(df, labels, crc_bucket(F.col("doc_id"), 5) >= 0)
    out = toxicity.score(df, model).collect()
    assert len(out) == df.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    no_word = {r.doc_id for r in df.where("text is null or trim(text) = ''").collect()}
    assert all(r.predicted == 0 for r in out if r.doc_id in no_word)
    assert toxicity.fit(df, labels.where("false"), F.lit(True)) is None
    assert {r.score for r in toxicity.score(df, None).collect()} == {0.0}
    assert toxicity.score(empty(spark), model).collect() == []
    assert toxicity.drop_toxic(df, None).count() == df.count()
    assert toxicity.drop_toxic(df, model).columns == df.columns
