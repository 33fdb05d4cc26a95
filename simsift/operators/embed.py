"""Text -> vector (EMB-1..3).

Built-in embedder: signed feature hashing (published technique). Per lower-cased
whitespace token ``t``: ``h`` = first 8 hex digits of ``md5(t)`` as a number,
bucket ``h % dim``, sign ``+1`` when ``(h div dim) % 2 == 0`` else ``-1``; a
text's vector is the sum over its tokens. Counts are integers, so the result is
exact in every engine.

The vector is built in long form, ``(key, bucket, value)``: tokens are exploded,
summed per bucket, then densified with one bounded ``collect_list`` per key
(at most ``dim`` entries).

External models plug in through ``embed_with_model`` (Arrow batches, the model
is loaded once per Python worker), for when a real encoder is installed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsift.functions.text import tokens
from simsift.operators.batches import runs, trimmed

# Fixed value: dimension of the built-in hashing embedder.
EMBED_DIM = 256
# Characters whose tokens a task holds at once, and tokens whose hash it remembers.
SLICE_CHARS, MEMO_TOKENS = 1 << 18, 200_000


def hashed_terms(df: DataFrame, keys: Sequence[str], text: str | Column, dim: int = EMBED_DIM,
                 tokenized: bool = False) -> DataFrame:
    """Long sparse embedding ``(keys.., bucket, value)`` with zero values dropped.

    ``text`` is a string column, or with ``tokenized`` an array of tokens.
    """
    t = F.col(text) if isinstance(text, str) else text
    toks = df.select(*keys, F.explode(t if tokenized else tokens(t)).alias("_tok"))
    h = toks.select(*keys, F.conv(F.substring(F.md5(F.lower("_tok")), 1, 8), 16, 10).cast("long").alias("_h"))
    signed = h.select(*keys, (F.col("_h") % F.lit(dim)).cast("int").alias("bucket"),
                      F.expr(f"1 - 2 * pmod(_h div {dim}, 2)").cast("int").alias("_s"))
    return (signed.groupBy(*keys, "bucket").agg(F.sum("_s").cast("int").alias("value"))
                  .where(F.col("value") != 0))


def densify(terms: DataFrame, keys: Sequence[str], dim: int = EMBED_DIM, out: str = "vector") -> DataFrame:
    """Long ``(keys.., bucket, value)`` -> ``(keys.., out array<float>[dim])``."""
    m = terms.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "value"))).alias("_m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                        lambda d: F.coalesce(F.element_at(F.col("_m"), d), F.lit(0)).cast("float"))
    return m.select(*keys, dense.alias(out))


def hashed_vector_udf(dim: int = EMBED_DIM):
    """Arrow-batched hashing embedder: narrow, one pass, no shuffle.

    A task remembers the hashes (md5 -> bucket and sign) of up to ``MEMO_TOKENS``
    tokens; the vectors are summed by one weighted count over (row, bucket). A batch
    is worked in slices of about ``SLICE_CHARS`` characters, so that a task's memory
    does not depend on how many rows a batch holds. Same contract as the native long
    form below. Non-deterministic only for the optimizer, so that a plan that uses
    the vector twice still computes it once.
    """
    import hashlib

    import pyarrow as pa
    import pyarrow.compute as pc

    slice_chars, memo_tokens = SLICE_CHARS, MEMO_TOKENS

    def vectors(texts, known):
        words = pc.ascii_split_whitespace(pa.array(texts, pa.string()))           # at the same six characters as ``tokens``
        row = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
        enc = pc.list_flatten(words).dictionary_encode()
        if len(known) > memo_tokens:
            known.clear()
        for x in set(found := enc.dictionary.to_pylist()).difference(known):
            h = int(hashlib.md5(x.lower().encode("utf-8")).hexdigest()[:8], 16)
            known[x] = (h % dim) * 2 + (h // dim) % 2
        code = np.array([known[x] for x in found], np.int64)
        sign = np.where([x != "" for x in found], 1 - 2 * (code & 1), 0)           # white space at an end is no token
        at = enc.indices.to_numpy()
        return np.bincount(row * dim + (code >> 1)[at], sign[at], len(texts) * dim).reshape(len(texts), dim)

    def run(batches):
        known = {}
        for texts in batches:
            out = np.zeros((len(texts), dim), np.float32)
            # a vector counts like 4 characters a value, so that many short texts are cut as well
            for a, b in runs([4 * dim + (len(t) if t is not None else 0) for t in texts], slice_chars):
                out[a:b] = vectors(texts.iloc[a:b].tolist(), known)
            yield pd.Series(list(out))

    whole = trimmed(run)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return whole(batches)

    return hashed.asNondeterministic()


def embed(df: DataFrame, text: str, keys: Sequence[str], *, dim: int = EMBED_DIM, out: str = "vector",
          method: str = "arrow") -> DataFrame:
    """EMB-1: add ``out`` = hashed embedding of ``text`` to every row (``keys`` unique).

    ``method="arrow"`` (default) is a narrow Arrow UDF: no shuffle, no join.
    ``method="native"`` builds the same vectors with built-in expressions in long
    form; it costs a shuffle of every token plus a join back, so it is kept for
    cross-checking and for engines without Python workers.

    Rows without tokens (empty text) get the zero vector, whose cosine is NULL,
    so an empty query finds nothing (EMB-3).
    """
    if method == "arrow":
        return df.withColumn(out, hashed_vector_udf(dim)(F.col(text)))
    if method != "native":
        raise ValueError("method must be 'arrow' or 'native'")
    # One shuffle: rows are clustered by the first key, and every later
    # aggregate and the join back are keyed by it, so the partitioning is reused.
    df = df.repartition(keys[0])
    vecs = densify(hashed_terms(df, keys, text, dim), keys, dim, out)
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return df.join(vecs, list(keys), "left").withColumn(out, F.coalesce(F.col(out), zero))


def embed_query(spark, text: str, *, dim: int = EMBED_DIM) -> list[float]:
    """EMB-2: one query string -> vector (same hashing, computed on the driver)."""
    import hashlib
    import re

    v = np.zeros(dim, dtype=np.float64)
    for tok in re.split(r"[ \t\n\x0b\f\r]+", text):
        if not tok:
            continue
        h = int(hashlib.md5(tok.lower().encode("utf-8")).hexdigest()[:8], 16)
        v[h % dim] += 1 - 2 * ((h // dim) % 2)
    return v.tolist()


def fallback_vector(text: str, dim: int) -> list[float]:
    """EMB-2 opt-in fallback: a Gaussian vector seeded from a hash of the text (reproducible)."""
    import hashlib

    seed = int(hashlib.sha256(text.encode("utf-8")).hexdigest()[:16], 16)
    return np.random.default_rng(seed).normal(0.0, 1.0, dim).tolist()


def query_embedding(text: str, encode: Callable[[str], Sequence[float]], *, dim: int,
                    fallback: bool = False) -> tuple[list[float], str]:
    """EMB-2: ``(vector, status)``; on encoder error either raise or, opt-in, fall back."""
    try:
        v = [float(x) for x in encode(text)]
        if len(v) != dim:
            raise ValueError(f"encoder returned {len(v)} dims, expected {dim}")
        return v, "ok"
    except Exception:
        if not fallback:
            raise
        return fallback_vector(text, dim), "fallback"


def embed_with_model(df: DataFrame, text: str, make_model: Callable[[], Callable[[np.ndarray], np.ndarray]],
                     *, dim: int, out: str = "vector", batch_size: int = 256) -> DataFrame:
    """EMB-1 with an external model: ``make_model()`` runs once per Python worker and
    returns ``predict(texts: ndarray[str]) -> ndarray[n, dim]``. Arrow-batched."""
    from pyspark.ml.functions import predict_batch_udf

    udf = predict_batch_udf(make_model, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size,
                            input_tensor_shapes=None)
    return df.withColumn(out, udf(F.col(text)))
