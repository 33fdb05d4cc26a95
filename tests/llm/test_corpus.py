"""Mixing, sharding, token files, decontamination, chat formatting and the pipeline."""

import functools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from helpers_llm import awkward, awkward_rows, empty, prose
from simsift.llm import chat, decontaminate, mixing, registry, sharding, tokens
from simsift.llm.common import trimmed, worker_memo
from simsift.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- mixing --------------------------------------------------------------------

def target_brute(sizes):
    names = sorted((k for k in sizes if k is not None)) + [k for k in sizes if k is None]
    weight = {k: mixing.WEIGHTS[i % 3] for i, k in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[k] for k in capped)
        w = sum(weight[k] for k in names if k not in capped)
        over = {k for k in names if k not in capped and left * weight[k] / w > 3 * sizes[k] + 1e-9}
        if not over:
            return {k: 3 * sizes[k] if k in capped else (left * weight[k] / w if w else 0) for k in names}
        capped |= over


def mixed_rows(seed, n=1500):
    rng = random.Random(seed)
    return [(i, prose(rng, rng.choice([0, 3, 10, 40])), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(n)]


def test_mix_meets_its_targets(spark):
    rows = mixed_rows(1)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes, source_of, taken = defaultdict(int), {}, defaultdict(int)
    for d, t, s in rows:
        sizes[s] += len(WORD.findall(t))
        source_of[d] = (s, len(WORD.findall(t)))
    want = target_brute(sizes)
    for r in got:
        s, n = source_of[r.doc_id]
        assert (r.source, r.size, r.source_size) == (s, n, sizes[s])
        assert r.target == pytest.approx(want[s])
        assert r.taken <= 3 * n and (n == 0 or r.taken % n == 0)
        copies = r.taken / n if n else 0
        assert copies in (int(want[s] / sizes[s] + 1e-9), int(want[s] / sizes[s] + 1e-9) + 1) or n == 0
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= near(got, s)
    again = mixing.mix(df.repartition(2)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def near(got, source):
    """Half of the shortest document of a source that can still move towards the target."""
    mine = [r for r in got if r.source == source and r.size > 0]
    off = mine[0].target - sum(r.taken for r in mine) if mine else 0
    share = mine[0].target / mine[0].source_size if mine else 0
    free = [r.size for r in mine if (share - r.taken / r.size) * off > 1e-9]
    return min(free, default=float("inf")) / 2 + 1e-6


def test_mix_of_long_and_short_documents_comes_near(spark):
    """Residues of long documents are spread over short ones; shares stay floor or ceiling."""
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.choice([1, 2, 5, 40, 40, 900, 4000])), rng.choice("aaaaabbc")) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    for s in "abc":
        mine = [r for r in got if r.source == s]
        share = mine[0].target / mine[0].source_size
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= min(near(got, s), 0.5 if share < 3 else 1e-6)
        assert {r.taken // r.size for r in mine} <= {int(share + 1e-9), int(share + 1e-9) + 1}
    again = mixing.mix(df.repartition(2)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_duels_keep_the_expectation(spark):
    """Over many seeds a document is taken as often as its share says."""
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1).cache()
    hits = Counter()
    seeds = 6
    for seed in range(seeds):
        for r in mixing.mix(df, seed=seed * 100).collect():
            hits[r.source] += r.taken / r.size / seeds
    share = {r.source: r.target / r.source_size for r in mixing.mix(df).collect()}
    for s in "ab":
        assert hits[s] / 30 == pytest.approx(share[s], abs=0.15)


def test_mix_of_awkward_rows(spark):
    df = awkward(spark)
    got = mixing.mix(df).collect()
    sizes = defaultdict(int)
    for r in awkward_rows():
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = target_brute(sizes)
    assert len(got) == df.count()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(
        (r[0], r[3], len(WORD.findall(r[1] or ""))) for r in awkward_rows())
    assert all(r.target == pytest.approx(want[r.source]) and r.taken <= 3 * r.size for r in got)
    assert mixing.mix(empty(spark)).collect() == []


def test_take_returns_the_rows(spark):
    df = awkward(spark).withColumn("__k", F.lit(1)).withColumn("__row", F.lit("x"))
    took = mixing.take(df)
    assert took.columns == df.columns
    words = Counter()
    for r in took.collect():
        words[r.source] += len(WORD.findall(r.text or ""))
    want = Counter()
    for r in mixing.mix(df).collect():
        want[r.source] += r.taken
    assert +words == +want
    assert mixing.take(empty(spark)).count() == 0


# --- sharding ------------------------------------------------------------------

@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_every_cell_in_unit_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    h = sharding.hilbert_index(cells, bits)
    order = np.argsort(h)
    assert sorted(h.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order].astype(int), axis=0)).sum(axis=1) == 1).all()


def check_shards(rows, got, shards):
    text = {}
    for r in rows:
        text.setdefault(r[0], []).append(r[1] or "")
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    counts = Counter(r.shard for r in got)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts.get(s, 0)))
    for r in got:
        assert (r.size, r.text_crc32) in {(16 + len(t.encode()), zlib.crc32(t.encode())) for t in text[r.doc_id]}
        assert r.law == "rows" and r.grown_shard is None


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_of_awkward_rows(spark, shards):
    check_shards(awkward_rows(), sharding.assign_shards(awkward(spark), shards).collect(), shards)
    assert sharding.assign_shards(empty(spark), shards).collect() == []


def test_hot_cell_is_cut_and_files_prune(spark, scratch):
    rng = random.Random(2)
    rows = [(i, prose(rng, 20), "en", "src1") for i in range(400)] + \
        [(1000 + i, prose(rng, rng.randint(1, 300)), rng.choice(["de", "en", "fr"]), f"src{rng.randrange(5)}") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    check_shards(rows, sharding.assign_shards(df, 40).collect(), 40)
    sharding.write_shards(df, f"{scratch}/shards", 40)
    back = spark.read.parquet(f"{scratch}/shards")
    assert back.count() == len(rows)
    span = back.groupBy("shard").agg(F.min("lang").alias("a"), F.max("lang").alias("b"), F.min("source").alias("c"),
                                     F.max("source").alias("d")).collect()
    hit = sum(1 for r in span if r.a <= "fr" <= r.b and r.c <= "src3" <= r.d)
    assert hit <= 24                                    # files that a filter on both cannot skip


# --- token files ---------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1), max_size=50))
def test_packed_values_round_trip(values):
    control, data = tokens.pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert tokens.unpack(control, data, len(values)).tolist() == values


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    spec = vocabulary()
    whole, fast = Tokenizer.from_str(spec), tokens.WordEncoder(spec, "<u2")
    odd = ["Don't it's WE'LL o'clock's", "İstanbul ΟΔΟΣ Σ", "J̌ é É", "<|endoftext|> x<|startoftext|>.",
           "a b c\u0085d\x1ce", "ﬁ ª º µ ß ÿ Ÿ", "x!!?? y..: 12.5 ½ ²", "日本語、テスト。", "", "  \n\n ", "a\tb\r\nc",
           "Ærø ÞÐ×÷ ¿qué?", "ÀÉÎ À́", "'s 's't ''ll", "a_b __c -d-", "soft­hyphen", "'sé x'S"]
    odd += [r[1] or "" for r in awkward_rows()]
    for t in odd * 2:
        assert np.frombuffer(fast.encode(t), "<u2").tolist() == whole.encode(t, add_special_tokens=False).ids, t


@functools.cache
def encoders():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary()), tokens.WordEncoder(vocabulary(), "<u2")


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_encoder_equals_the_library_on_any_text(text):
    whole, fast = encoders()
    assert np.frombuffer(fast.encode(text), "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids


def check_files(rows, got):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(vocabulary())
    want = []
    for r in rows:
        ids = whole.encode(r[1] or "", add_special_tokens=False).ids + [tokens.END_ID]
        want.append((r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    key = [float("-inf") if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert key == sorted(key)


def test_token_files_of_awkward_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_TOKENS", 500)
    files = tokens.write_token_files(awkward(spark), vocabulary(), f"{scratch}/files", partitions=3)
    check_files(awkward_rows(), tokens.read_token_files(spark, files).collect())
    blocks = spark.read.parquet(files.blocks)
    assert blocks.count() > 3
    ranks = spark.read.parquet(files.ranks).orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)


def test_token_files_of_nothing(spark, scratch):
    files = tokens.write_token_files(empty(spark), vocabulary(), f"{scratch}/files")
    assert tokens.read_token_files(spark, files).collect() == []


def test_encoder_remembers_words_that_come_up_again_within_bounds(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    encoder = tokens.WordEncoder(vocabulary(), "<u2")
    once = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}q" for i in range(600)]
    want = [encoder.encode(w) for w in once]
    assert len(encoder.words) < 20                          # few share a mark
    for _ in range(3):
        for a in range(0, 600, 40):
            assert [encoder.encode(w) for w in once[a:a + 40]] == want[a:a + 40]
            encoder.tidy()
            assert len(encoder.words) + len(encoder.older) <= 100
    assert len(encoder.older) == 50
    long = "日本語" * 200
    assert encoder.encode(long) == encoder.encode(long) == encoder.encode(long)
    assert long not in encoder.words
    older = encoder.older
    encoder.room = 0
    current = encoder.words
    encoder.tidy()
    assert encoder.older is current and encoder.older is not older        # no copy is made


def test_workers_let_the_encoder_go_once_texts_are_encoded(spark, scratch):
    def left(batches):
        import sys

        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([hasattr(sys.modules.get("simsift_worker_memo"), "encoder")])], ["left"])

    cores = spark.sparkContext.defaultParallelism
    held = lambda: [r["left"] for r in spark.range(0, 8 * cores, 1, 8 * cores).mapInArrow(left, "left boolean").collect()]
    encoded = tokens.encode_documents(awkward(spark), vocabulary())
    encoded.write.parquet(f"{scratch}/ids")
    assert any(held())
    stored = spark.read.parquet(f"{scratch}/ids").repartition(8 * cores)
    tokens.id_counts(stored, "<u2").collect()
    assert not any(held())


def test_memo_of_a_worker_belongs_to_one_step():
    first = tokens.process_encoder(vocabulary(), "<u2")
    worker_memo().owner = tokens.ENCODER
    assert list(trimmed(iter, tokens.ENCODER)([1, 2])) == [1, 2]
    assert tokens.process_encoder(vocabulary(), "<u2") is first
    assert list(trimmed(iter)([1, 2])) == [1, 2]
    assert tokens.process_encoder(vocabulary(), "<u2") is not first
    assert list(trimmed(iter)([])) == []


# --- decontamination -----------------------------------------------------------

def edit_in(pattern, text):
    """Smallest edit distance of ``pattern`` to a substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, c in enumerate(text, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (p != c)))
    return min(row)


def hits_brute(docs, items):
    out = set()
    for d, t, *_ in docs:
        for i, x in items:
            for p in decontaminate.probes(decontaminate.normal(x or "")):
                if edit_in(p, decontaminate.normal(t or "")) <= decontaminate.budget(len(p)):
                    out.add((d, i))
                    break
    return out


def test_hits_equal_brute_force(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(3, 40))) for i in range(12)] + [(50, None), (51, ""), (52, "ba ki")]
    items.append((60, items[4][1]))
    docs = []
    for d in range(40):
        text = prose(rng, rng.randint(0, 40))
        if d % 2:
            item = rng.choice(items[:12])[1]
            chars = list(item.upper() if d % 3 else item)
            for _ in range(rng.randint(0, 5)):
                at = rng.randrange(len(chars))
                chars[at:at + 1] = rng.choice([[], ["x"], [chars[at], "-"]])
            text = text + " \n" + "".join(chars) + "; " + prose(rng, 5)
        docs.append((d, text))
    docs += [(100, None), (101, ""), (1, docs[1][1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.find_hits(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == hits_brute(docs, items)
    clean = decontaminate.drop_hits(df, bench)
    dirty = {d for d, _ in hits_brute(docs, items)}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in docs if d not in dirty)


def test_items_in_blocks_and_empty_tables(spark, monkeypatch):
    rng = random.Random(7)
    items = [(i, prose(rng, 25)) for i in range(9)]
    docs = [(i, prose(rng, 9) + " " + items[i % 9][1]) for i in range(20)]
    df = awkward(spark).select("doc_id", "text").unionByName(spark.createDataFrame(docs, "doc_id bigint, text string"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = sorted(map(tuple, decontaminate.find_hits(df, bench).collect()))
    monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (200,))
    assert sorted(map(tuple, decontaminate.find_hits(df, bench).collect())) == one and len(one) >= 20
    none = bench.where("false")
    assert decontaminate.find_hits(df, none).collect() == []
    assert decontaminate.find_hits(empty(spark), bench).collect() == []
    full = awkward(spark)
    assert decontaminate.drop_hits(full, none).count() == full.count()
    assert decontaminate.drop_hits(full, bench).columns == full.columns


# --- chat ----------------------------------------------------------------------

def best_path(model, symbols):
    """Viterbi by trying every path."""
    paths = [((s,), model["t"][chat.START, s] + model["e"][s, symbols[0]]) for s in range(chat.STATES)]
    for o in symbols[1:]:
        paths = [((*p, s), v + model["t"][p[-1], s] + model["e"][s, o]) for p, v in paths for s in range(chat.STATES)
                 if np.isfinite(v + model["t"][p[-1], s])]
    return max(v for _, v in paths)


def value(model, symbols, states):
    v = model["t"][chat.START, states[0]] + model["e"][states[0], symbols[0]]
    for a, s, o in zip(states, states[1:], symbols[1:]):
        v += model["t"][a, s] + model["e"][s, o]
    return v


def toy_model(seed):
    rng = random.Random(seed)
    t = {(a, b): rng.randrange(9) for a in range(chat.STATES + 1) for b in range(chat.STATES)}
    e = {(s, o): rng.randrange(30) for s in range(chat.STATES) for o in range(chat.SYMBOLS)}
    return chat.estimate(t, e)


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_and_chunks_find_the_best_path(seed):
    model, rng = toy_model(seed), random.Random(seed)
    symbols = [rng.randrange(chat.SYMBOLS) for _ in range(6)]
    whole = chat.viterbi(model, symbols, None, None)
    assert value(model, symbols, whole) == pytest.approx(best_path(model, symbols))
    parts = [symbols[:2], symbols[2:3], [], symbols[3:]]
    ends = chat.borders([chat.matrix(model, p, i == 0) for i, p in enumerate(parts)])
    path = []
    for i, p in enumerate(parts):
        path += chat.viterbi(model, p, ends[i - 1] if i else None, ends[i])
    assert value(model, symbols, path) == pytest.approx(best_path(model, symbols))


def test_roles_are_recovered_on_held_out_conversations(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    got = registry.QUERIES["op6_chat_formatting"](spark, sf).collect()
    truth = {(r.conv_id, r.turn): r.role for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    held = {k: v for k, v in truth.items() if zlib.crc32(str(k[0]).encode()) % 5 == 0}
    right = sum(1 for r in got if r.begins and held.get((r.conv_id, r.piece)) == r.role)
    assert len(held) > 60 and right / len(held) > 0.98
    for r in got[:200]:
        assert r.rendered == f"<|{r.role}|>\n{r.text}\n" and not chat.MARKER.match(r.text)


def test_chat_of_awkward_rows(spark, monkeypatch):
    rows = [(1, 0, "User: hello\n\nAssistant: hi"), (1, 1, "there"), (1, 2, None), (1, 3, ""), (None, 0, "Q: what?\n\nA: that"),
            (2, 0, None), (3, 5, "User: a"), (3, 5, "User: a"), (4, None, "AI: no number")]
    rows += [(9, i, ("\nUser: " if i % 2 == 0 else "\nAI: ") + f"line {i}" * (i % 5 + 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, text string").withColumn("role", F.lit("x")) \
        .withColumn("rendered", F.lit(1)).repartition(4)
    known = spark.createDataFrame([(c, t, s, r) for c in range(30) for t, (s, r) in enumerate(
        [("\nUser: how\nare you?", "user"), ("\nAI: fine\nthanks", "assistant")])], "conv_id bigint, turn int, text string, role string")
    model = chat.learn(known, "conv_id", "turn", "text", "role")

    def text(got):
        out = defaultdict(str)
        for r in sorted(got, key=lambda r: (str(r.conv_id), -1 if r.piece is None else r.piece, r.line)):
            out[r.conv_id] += r.rendered
        return dict(out)

    whole = text(chat.parse(df, model).collect())
    assert whole[1] == "<|user|>\nhello\n<|assistant|>\nhi\nthere\n"
    assert whole[None] == "<|user|>\nwhat?\n<|assistant|>\nthat\n" and 2 not in whole
    assert whole[9].count("<|user|>") == 150 and whole[9].count("<|assistant|>") == 150
    none = chat.learn(known.where("false"), "conv_id", "turn", "text", "role")
    assert chat.parse(df, none).count() > 0
    assert chat.parse(df.where("false"), model).collect() == []


# --- pipeline ------------------------------------------------------------------

def test_pipeline_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(f"{scratch}/{name}")
        kept = spark.read.parquet(f"{scratch}/{name}")
        if name == "ngram_jaccard_join":
            from test_dedup import join_brute

            rows = [(r.doc_id, r.text) for r in docs.collect()]
            assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in join_brute(rows)})
        if name == "benchmark_decontamination":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
            rows = [(r.doc_id, r.text) for r in docs.where(F.length("text") < 1500).collect()]
            dirty = {d for d, _ in hits_brute(rows[:25], bench[:6])}
            assert not dirty & {r.doc_id for r in kept.collect()}
        if i < len(corpus_pipeline.STAGES) - 1:
            assert kept.columns == columns and 0 < kept.count() <= 3 * before
        else:
            check_files([(r.doc_id, r.text) for r in docs.collect()], kept.collect())
        docs = kept
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_run_is_the_stages_and_reruns_agree(spark):
    a = corpus_pipeline.run(spark, SF_SMALL).collect()
    b = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and a


def test_entry_registers_every_operator():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and "op2_exact_dedup" in entry.oracle_sql()


def test_exact_dedup_oracle(spark):
    from helpers import duck, same_rows

    same_rows(registry.QUERIES["op2_exact_dedup"](spark, SF_SMALL), duck(SF_SMALL), registry.ORACLE["op2_exact_dedup"])


def test_functions_reach_workers_by_value():
    """Workers need not have this package on their path."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    blob = cloudpickle.dumps(tokens.pack).hex()
    code = ("import pickle, numpy as np; from pyspark import cloudpickle; "
            f"f = pickle.loads(bytes.fromhex('{blob}')); print(f(np.array([1, 300], 'u4')))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd="/", env={"PATH": ""})
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == str(tokens.pack(np.array([1, 300], np.uint32)))


def test_short_items_stand_between_word_borders(spark):
    """Items of 1 to 19 characters against a search for whole words."""
    rng = random.Random(4)
    texts = ["I know nothing", "no", "oh no!", "clean an", "a" * 19, "b" + "a" * 19, "", None, "no-one, an"] + [
        " ".join(rng.choice(["no", "an", "know", "nothing", "clean", "now"]) for _ in range(6)) for _ in range(40)]
    items = ["no", "an", "know nothing", "a" * 19, "now no", "nothing clean now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    want = {(i, j) for i, t in enumerate(texts) for j, x in enumerate(items)
            if f" {x} " in f" {decontaminate.normal(t or '')} "}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_hits(df, bench, word_borders=True).collect()} == want
    kept = {r.doc_id for r in decontaminate.drop_hits(df, bench, word_borders=True).collect()}
    assert kept == set(range(len(texts))) - {i for i, _ in want} and 0 not in {i for i, j in want if j == 0}


def test_chat_keeps_the_lines_of_a_body(spark, monkeypatch):
    """Blank lines and lines that look like markers inside a turn come back as they were, across chunk borders too."""
    bodies = ["see\ncontext: keep this word\n\n  indented\n\n\nend", "one line", "list:\n\ninstructions: first\nsystem: second", "fine\n\nthanks"]
    turns = [(c, t, ("User: " if t % 2 == 0 else "AI: ") + bodies[(c + t) % 4], "user" if t % 2 == 0 else "assistant")
             for c in range(40) for t in range(8)]
    known = spark.createDataFrame([(c, t, "\n" + text, r) for c, t, text, r in turns],
                                  "conv_id bigint, turn int, text string, role string")
    model = chat.learn(known, "conv_id", "turn", "text", "role")
    pieces = []
    for c in range(6):                                      # a piece for each line, and blank ones between the turns
        text = "\n\n".join(t[2] for t in turns if t[0] == c)
        pieces += [(c, i, line or None) for i, line in enumerate(text.split("\n"))]
    df = spark.createDataFrame(pieces, "conv_id bigint, turn int, text string").repartition(4)
    for chunk in (64, 3):
        monkeypatch.setattr(chat, "CHUNK", chunk)
        out = defaultdict(list)
        for r in sorted(chat.parse(df, model).collect(), key=lambda r: (r.conv_id, r.piece, r.line)):
            if r.begins:
                out[r.conv_id].append([r.role, r.text])
            else:
                out[r.conv_id][-1][1] += "\n" + r.text
        assert dict(out) == {c: [[t[3], bodies[(c + t[1]) % 4]] for t in turns if t[0] == c] for c in range(6)}


def test_chunks_are_bounded_whatever_the_turn_numbers(spark, monkeypatch):
    """NULL conversations, NULL and repeated turns, a long one: bounded chunks and the path of the whole."""
    rows = [(None, None if i % 2 else 3, f"{'User' if i % 3 else 'AI'}: line {i:03d}" + "\n" * (i % 4 == 0)) for i in range(700)]
    rows += [(4, 1, f"same turn {i:03d}") for i in range(200)] + [(5, None, f"Q: {i:03d}?") for i in range(150)]
    rows += [(6, i, ("User: " if i % 2 else "") + f"long {i}") for i in range(500)] + [(7, 0, "AI: b" * 300)] * 3 + [(8, 0, "User: hi")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, text string").repartition(5)
    known = spark.createDataFrame([(c, t, s, r) for c in range(30) for t, (s, r) in enumerate(
        [("User: how\nare you?", "user"), ("AI: fine\nthanks", "assistant")])], "conv_id bigint, turn int, text string, role string")
    model = chat.learn(known, "conv_id", "turn", "text", "role")
    chunks = chat.chunked(df, "conv_id", "turn", "text")
    assert max(len(r.ps) for r in chunks.collect()) <= chat.CHUNK
    monkeypatch.setattr(chat, "CHUNK", 5)
    border = chat.border_states
    monkeypatch.setattr(chat, "border_states", lambda *a: border(*a, fan_in=3))
    parsed = sorted(chat.parse(df, model).collect(), key=lambda r: (-1 if r.piece is None else r.piece, r.line))
    got = [(r.conv_id, r.role, r.begins and n == 0, t) for r in parsed for n, t in enumerate(r.text.split("\n"))]
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (-1 if r[1] is None else r[1], r[2]))
        lines = chat.lines_of([r[2] for r in mine], True)
        found = sorted((r for r in got if r[0] == c), key=repr) if c != 6 else [r for r in got if r[0] == c]
        symbols = [x[2] for x in lines]
        states = chat.viterbi(model, symbols, None, None)
        if c == 6:                                          # several paths are equally likely: compare their values
            path = [2 * chat.ROLES.index(role) + (not begins) for _, role, begins, _ in found]
            assert [r[3] for r in found] == [x[3] for x in lines]
            assert value(model, symbols, path) == pytest.approx(value(model, symbols, states))
        else:
            assert found == sorted(((c, chat.ROLES[s // 2], s % 2 == 0, x[3].strip()) for x, s in zip(lines, states)), key=repr)
