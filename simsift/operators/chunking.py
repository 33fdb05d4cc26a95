"""Chunking of text into point rows (CHK-1..7).

All strategies are narrow, per-row transformations built from higher-order
functions, except the semantic splitter, which needs per-sentence embeddings
and a per-document percentile (see ``semantic_chunks``). Documents are
independent, so fixed and sentence chunking never shuffle.

Pinned contracts: tokens are whitespace tokens; chunks are rejoined with one
space; sentences end at whitespace after '.', '!' or '?'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsift.functions.text import MAX_TOKENS, tokens
from simsift.operators.batches import runs, trimmed

# Sentence boundary and overlap of the sentence splitter; the
# semantic splitter's breakpoint percentile and its neighbour buffer (one
# sentence on each side, built into the window sums below).
SENTENCE_SPLIT = r"(?<=[.!?])\s+"
SENTENCE_OVERLAP = 40
SEMANTIC_PERCENTILE = 0.95
SEMANTIC_BUFFER = 1

# Tokens that the semantic pass holds at once, and tokens whose hash it remembers.
SLICE_TOKENS, MEMO_TOKENS = 100_000, 200_000

FIXED, SENTENCE, SEMANTIC = "fixed", "sentence", "semantic"


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable.

    Catalyst collapses adjacent projections by substituting column definitions
    into their uses; a derived array used inside a higher-order function body
    would then be recomputed on every iteration (quadratic). A lambda variable
    is never substituted, so this binds the value exactly once per row.
    """
    return F.element_at(F.transform(F.array(value), fn), 1)


def _size_col(size) -> Column:
    return size if isinstance(size, Column) else F.lit(int(size))


def token_report(df: DataFrame, text: str, *, keep=("id",), limit: int = MAX_TOKENS) -> DataFrame:
    """CHK-1/2: token count per row and the excess over ``limit`` (0 when within)."""
    n = F.size(tokens(text))
    return df.select(*keep, n.alias("n_tokens"),
                     F.greatest(n - F.lit(limit), F.lit(0)).alias("excess"),
                     (n > F.lit(limit)).alias("over_limit"))


def fixed_chunk_array(text, size=MAX_TOKENS) -> Column:
    """CHK-3 as a column: the array of chunk strings of one text."""
    sz = _size_col(size)

    def pieces(v):
        toks, n = v["toks"], F.size(v["toks"])
        starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, v["size"])).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.array_join(F.slice(toks, s + 1, v["size"]), " "))

    return let(F.struct(tokens(text).alias("toks"), sz.alias("size")), pieces)


def fixed_chunks(df: DataFrame, text: str, *, size=MAX_TOKENS, keep=("id",)) -> DataFrame:
    """CHK-3: windows of ``size`` tokens (a column or an int), no overlap, last short.

    Empty text gives no rows. Output: ``keep.., chunk_index, chunk``.
    """
    return df.select(*keep, F.posexplode(fixed_chunk_array(text, size)).alias("chunk_index", "chunk"))


def sentences(text) -> Column:
    """Sentences of a text as token arrays, each split once; empties dropped."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.transform(F.split(c, SENTENCE_SPLIT), lambda s: tokens(s)), lambda t: F.size(t) > 0)


_BOUNDS = "array<struct<s:int,e:int>>"


def _pieces(toks: Column, size: Column) -> Column:
    """CHK-3 on one token array: consecutive slices of ``size`` tokens."""
    n = F.size(toks)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(toks, s + 1, size))


def sentence_units(text, size) -> Column:
    """Sentences as token arrays; a sentence longer than ``size`` is cut by CHK-3."""
    sz = _size_col(size)
    return F.flatten(F.transform(sentences(text), lambda toks: _pieces(toks, sz)))


def _pack(units: Column, counts: Column, size: Column, overlap: int) -> Column:
    """Chunk bounds ``[(s, e)]`` over units by the packing rule (ordered fold, JVM-side).

    Walk units in order; append while the chunk stays within ``size`` tokens;
    otherwise close it and start the next chunk with the longest run of trailing
    units of at most ``min(overlap, size - c)`` tokens (c = the new unit), so
    the new chunk fits and adds at least the new unit.
    """
    m = F.size(units)
    c_at = lambda i: F.element_at(counts, i + 1)

    def step(acc, i):
        c = c_at(i)
        lim = F.least(F.lit(overlap), size - c)
        back_idx = F.when(i - 1 >= acc["start"] + 1, F.sequence(i - 1, acc["start"] + 1, F.lit(-1))) \
                    .otherwise(F.array().cast("array<int>"))
        back = F.aggregate(
            back_idx,
            F.struct(F.lit(0).alias("r"), i.alias("best"), F.lit(0).alias("rb")),
            lambda st, j: F.struct(
                (st["r"] + c_at(j)).alias("r"),
                F.when(st["r"] + c_at(j) <= lim, j).otherwise(st["best"]).alias("best"),
                F.when(st["r"] + c_at(j) <= lim, st["r"] + c_at(j)).otherwise(st["rb"]).alias("rb")))
        closed = F.struct(
            back["best"].alias("start"), (back["rb"] + c).alias("total"),
            F.concat(acc["bounds"], F.array(F.struct(acc["start"].alias("s"), i.alias("e")))).alias("bounds"))
        grown = F.struct(acc["start"].alias("start"), (acc["total"] + c).alias("total"),
                         acc["bounds"].alias("bounds"))
        return F.when(acc["total"] + c <= size, grown).otherwise(closed)

    init = F.struct(F.lit(0).alias("start"), F.lit(0).alias("total"), F.array().cast(_BOUNDS).alias("bounds"))
    folded = F.aggregate(F.sequence(F.lit(0), m - 1), init, step,
                         lambda acc: F.concat(acc["bounds"],
                                              F.array(F.struct(acc["start"].alias("s"), m.alias("e")))))
    return F.when(m > 0, folded).otherwise(F.array().cast(_BOUNDS))


def sentence_chunks(df: DataFrame, text: str, *, size=MAX_TOKENS, overlap: int = SENTENCE_OVERLAP,
                    keep=("id",)) -> DataFrame:
    """CHK-4: sentences packed up to ``size`` tokens with up to ``overlap`` tokens of
    trailing sentences repeated. Narrow (no shuffle). Output ``keep.., chunk_index, chunk``."""
    return df.select(*keep, F.posexplode(sentence_chunk_array(text, size, overlap)).alias("chunk_index", "chunk"))


def tagged_chunks(df: DataFrame, arrays: dict, *, keep=("id",)) -> DataFrame:
    """Several per-row chunkings in one pass: ``arrays`` maps a strategy name to a
    chunk-array column; output ``keep.., chunking, chunk_index, chunk``."""
    arms = F.array(*[F.struct(F.lit(n).alias("chunking"), c.alias("chunks")) for n, c in arrays.items()])
    return (df.select(*keep, F.inline(arms))
              .select(*keep, "chunking", F.posexplode("chunks").alias("chunk_index", "chunk")))


def sentence_chunk_array(text, size=MAX_TOKENS, overlap: int = SENTENCE_OVERLAP) -> Column:
    """CHK-4 as a column: the array of packed chunk strings of one text."""
    sz = _size_col(size)

    def texts(v):
        u = v["u"]
        counts = F.transform(u, lambda x: F.size(x))
        bounds = let(F.struct(counts.alias("c")), lambda cv: _pack(u, cv["c"], v["size"], overlap))
        return F.transform(bounds, lambda b: F.array_join(F.flatten(F.slice(u, b["s"] + 1, b["e"] - b["s"])), " "))

    return let(F.struct(sentence_units(text, sz).alias("u"), sz.alias("size")), texts)


def semantic_chunks(df: DataFrame, text: str, *, key: str = "id", percentile: float = SEMANTIC_PERCENTILE,
                    dim: int | None = None, partitions: int | None = None, method: str = "arrow",
                    keep=()) -> DataFrame:
    """CHK-5: break between sentences where the embedding distance jumps.

    Window text of sentence i = sentences i-1, i, i+1; with the additive hashing
    embedder its vector is the sum of the three sentence vectors. Distance
    ``d_i = round(1 - cos(W_i, W_{i+1}), 6)``; threshold ``round(p95(d), 6)`` per
    document; break after i when ``d_i > threshold``.

    A document is one row, so nothing is shuffled: the sentences' tokens go
    through one Arrow pass that hashes them, compares neighbouring windows, takes
    the percentile and joins the pieces (``method="arrow"``, the default).
    ``method="native"`` is the all-built-in long form (one row per sentence and
    bucket; it shuffles), kept to cross-check: both give identical chunks (tested).
    """
    if method == "native":
        return _semantic_native(df, text, key=key, percentile=percentile, dim=dim, partitions=partitions,
                                keep=keep)
    if method != "arrow":
        raise ValueError("method must be 'arrow' or 'native'")
    from simsift.operators.embed import EMBED_DIM

    cols = (key, *keep)
    src = df.select(*cols, sentences(text).alias("_sentences"))
    chunked = src.mapInArrow(trimmed(_semantic_pass(percentile, dim or EMBED_DIM)),
                             T.StructType([*[src.schema[c] for c in cols],
                                           T.StructField("_chunks", T.ArrayType(T.StringType()))]))
    return chunked.select(key, F.posexplode("_chunks").alias("chunk_index", "chunk"), *keep)


def _semantic_pass(percentile: float, dim: int):
    """Arrow function: ``(.., sentences)`` -> ``(.., chunks)``. Self-contained, as it runs on executors.

    A batch is worked in slices of about ``SLICE_TOKENS`` tokens, whatever rows it holds.
    """
    slice_tokens, memo_tokens = SLICE_TOKENS, MEMO_TOKENS

    def run(batches):
        import hashlib
        import math
        from decimal import ROUND_HALF_UP, Decimal

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        step = Decimal("0.000001")

        def half_up(x):
            return float(Decimal(repr(x)).quantize(step, ROUND_HALF_UP))

        def signed_bucket(tok):
            h = int(hashlib.md5(tok.lower().encode("utf-8")).hexdigest()[:8], 16)
            b = h % dim
            return b if (h // dim) % 2 == 0 else b + dim

        def window_products(codes, ends):
            """Squared norms of the windows and products of neighbours, block by block."""
            m = len(ends)
            n2, dot = np.zeros(m, np.int64), np.zeros(max(m - 1, 0), np.int64)
            block = 512
            for lo in range(0, m, block):
                hi = min(m, lo + block)
                a, z = max(0, lo - 1), min(m, hi + 2)        # sentences that the windows lo..hi need
                first = ends[a - 1] if a else 0
                part = codes[first:ends[z - 1]]
                row = np.repeat(np.arange(z - a), np.diff(np.concatenate([[first], ends[a:z]])))
                s = (np.bincount(row * dim + part % dim, np.where(part < dim, 1, -1), (z - a) * dim)
                     .astype(np.int64).reshape(z - a, dim))
                w = s.copy()
                w[1:] += s[:-1]
                w[:-1] += s[1:]
                w = w[lo - a:]                               # windows lo.. (the row after the last needed one is partial)
                n2[lo:hi] = (w[:hi - lo] * w[:hi - lo]).sum(axis=1)
                pairs = min(hi, m - 1) - lo
                if pairs > 0:
                    dot[lo:lo + pairs] = (w[:pairs] * w[1:pairs + 1]).sum(axis=1)
            return n2, dot

        memo = {}

        def code(tok):
            c = memo.get(tok)
            if c is None:
                c = memo[tok] = signed_bucket(tok)
            return c

        def breaks(codes, ends):
            """The sentences after which a document breaks."""
            n2, dot = window_products(codes, ends)
            d = []
            for i in range(len(ends) - 1):
                den = math.sqrt(float(n2[i])) * math.sqrt(float(n2[i + 1]))
                d.append(half_up(1.0 - float(dot[i]) / den) if den else None)
            known = sorted(x for x in d if x is not None)
            if not known:
                return []
            at = (len(known) - 1) * percentile
            lo, hi = math.floor(at), math.ceil(at)
            cut = half_up(known[lo] if lo == hi or known[lo] == known[hi]
                          else (hi - at) * known[lo] + (at - lo) * known[hi])
            return [i for i, x in enumerate(d) if x is not None and x > cut]

        def chunks(col, held, words):
            """The chunks of every row of ``col``; tokens stay in Arrow's buffers."""
            if len(memo) > memo_tokens:
                memo.clear()
            flat = pc.list_flatten(pc.list_flatten(col))
            enc = flat.dictionary_encode()
            of = np.array([code(t) for t in enc.dictionary.to_pylist()], np.int64)
            codes = of[enc.indices.to_numpy()]
            ends = np.cumsum(words, dtype=np.int64)
            ats, rows, a = [0], [0], 0
            for m in held.tolist():
                if m:
                    first, mine = ats[-1], ends[a:a + m]
                    ats += [int(mine[i]) for i in breaks(codes[first:mine[-1]], mine - first)]
                    ats.append(int(mine[-1]))
                    a += m
                rows.append(len(ats) - 1)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ats, pa.int32()), flat), " ")
            return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), joined)

        for b in batches:
            col = b.column(b.num_columns - 1)
            held = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            words = pc.list_value_length(pc.list_flatten(col)).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(held)])
            until = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)[ends[1:]]
            for lo, hi in runs(1 + np.diff(until, prepend=0), slice_tokens):
                part = b.slice(lo, hi - lo)
                out = chunks(part.column(b.num_columns - 1), held[lo:hi], words[ends[lo]:ends[hi]])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], out], names=[*b.schema.names[:-1], "_chunks"])

    return run


def _semantic_native(df: DataFrame, text: str, *, key: str = "id", percentile: float = SEMANTIC_PERCENTILE,
                     dim: int | None = None, partitions: int | None = None, keep=()) -> DataFrame:
    """All-built-in form of ``semantic_chunks`` (same result).

    Window vectors are sums of sentence vectors, so with sentence-pair products
    ``A_i = <S_i,S_i>``, ``B_i = <S_i,S_i+1>``, ``C_i = <S_i,S_i+2>``, ``D_i = <S_i,S_i+3>``:

        |W_w|^2          = A_w-1 + A_w + A_w+1 + 2 (B_w-1 + B_w) + 2 C_w-1
        <W_w, W_w+1>     = B_w-1 + C_w-1 + D_w-1 + A_w + 2 B_w + C_w + A_w+1 + B_w+1

    (terms outside the document are 0). The products come from one row per
    (sentence, bucket) and ``lead`` up to 3 within (document, bucket); all sums
    are of integers, so the distances equal the direct window computation
    bit for bit. Documents are shuffled once by ``key``; every later aggregate
    and window is keyed by it.
    """
    from simsift.operators.embed import EMBED_DIM

    dim = dim or EMBED_DIM
    keep = tuple(keep)
    docs = df.select(key, text, *keep)
    docs = docs.repartition(partitions, key) if partitions else docs.repartition(key)
    rows = let(F.struct(sentences(text).alias("st")),
               lambda v: F.transform(v["st"], lambda x, i: F.struct(
                   i.alias("si"), x.alias("toks"), F.size(v["st"]).alias("m"))))
    sent = docs.select(key, *keep, F.inline(rows))
    tok = sent.select(key, "si", F.explode("toks").alias("_tok"))
    h = tok.select(key, "si", F.conv(F.substring(F.md5(F.lower("_tok")), 1, 8), 16, 10)
                   .cast("long").alias("_h"))
    sv = (h.select(key, "si", (F.col("_h") % F.lit(dim)).cast("int").alias("bucket"),
                   F.expr(f"1 - 2 * pmod(_h div {dim}, 2)").cast("long").alias("_s"))
           .groupBy(key, "si", "bucket").agg(F.sum("_s").alias("v"))
           .where(F.col("v") != 0))
    wb = Window.partitionBy(key, "bucket").orderBy("si")
    nxt = sv.select(key, "si", "v", *[x for o in (1, 2, 3) for x in (
        F.lead("si", o).over(wb).alias(f"_s{o}"), F.lead("v", o).over(wb).alias(f"_v{o}"))])

    def at(off):   # product with the entry `off` sentences ahead, 0 when absent
        terms = [F.when(F.col(f"_s{o}") == F.col("si") + off, F.col("v") * F.col(f"_v{o}")) for o in (1, 2, 3)]
        return F.coalesce(*terms, F.lit(0))

    pairs = nxt.groupBy(key, "si").agg(F.sum(F.col("v") * F.col("v")).alias("A"), F.sum(at(1)).alias("B"),
                                       F.sum(at(2)).alias("C"), F.sum(at(3)).alias("D"))
    base = sent.select(key, "si", "m").join(pairs, [key, "si"], "left").na.fill(0, ["A", "B", "C", "D"])
    ww = Window.partitionBy(key).orderBy("si")
    prev = lambda c: F.coalesce(F.lag(c).over(ww), F.lit(0))
    nxt1 = lambda c: F.coalesce(F.lead(c).over(ww), F.lit(0))
    q = base.select(key, "si", "m",
                    (prev("A") + F.col("A") + nxt1("A") + 2 * (prev("B") + F.col("B")) + 2 * prev("C")).alias("n2"),
                    (prev("B") + prev("C") + prev("D") + F.col("A") + 2 * F.col("B") + F.col("C")
                     + nxt1("A") + nxt1("B")).alias("dot"))
    q = q.select(key, "si", "m", "dot", "n2", F.lead("n2").over(ww).alias("_n2next"))
    dist = (q.where(F.col("si") < F.col("m") - 1)
             .select(key, F.col("si").alias("w"), F.round(F.lit(1.0) - F.try_divide(
                 F.col("dot").cast("double"), F.sqrt(F.col("n2").cast("double")) * F.sqrt(F.col("_n2next").cast("double"))),
                 6).alias("d")))
    ww = Window.partitionBy(key).orderBy("w")
    thr = F.round(F.percentile("d", percentile).over(Window.partitionBy(key)), 6)
    brk = dist.select(key, "w", F.coalesce(F.col("d") > thr, F.lit(False)).cast("int").alias("brk"))
    cum = brk.select(key, (F.col("w") + 1).alias("si"), F.sum("brk").over(
        ww.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    lab = (sent.join(cum, [key, "si"], "left")
               .select(key, "si", "toks", *keep, F.coalesce("cum", F.lit(0)).alias("chunk_index")))
    grouped = lab.groupBy(key, "chunk_index").agg(
        F.sort_array(F.collect_list(F.struct("si", "toks"))).alias("_p"), *[F.first(c).alias(c) for c in keep])
    return grouped.select(key, F.col("chunk_index").cast("int").alias("chunk_index"),
                          F.array_join(F.flatten(F.transform("_p", lambda p: p["toks"])), " ").alias("chunk"), *keep)
