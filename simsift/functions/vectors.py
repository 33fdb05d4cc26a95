"""Vector column expressions (JVM-side, no UDF).

Pinned score contract: elements are cast to double and summed by a left fold in
index order; cosine = dot / (|a| |b|) with a zero norm giving NULL (never a hit);
scores are reported rounded to 6 places and ranked on the rounded value, ties
broken by id ascending.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_DIGITS = 6
COSINE = "cosine"
DOT = "dot"
METRICS = (COSINE, DOT)


def as_col(v) -> Column:
    """A vector given as a Column, a column name, or a Python sequence (literal)."""
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.array(*[F.lit(float(x)).cast("double") for x in v])


def dot(a, b) -> Column:
    a, b = as_col(a), as_col(b)
    prods = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    a = as_col(a)
    sq = F.transform(a, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def literal_norm(q: Sequence[float]) -> float:
    """Norm of a literal query, folded in the same order as ``norm`` (same IEEE result)."""
    s = 0.0
    for x in q:
        x = float(x)
        s += x * x
    return math.sqrt(s)


def cosine(a, b) -> Column:
    """Cosine similarity; a literal query's norm is computed once on the driver."""
    nb = F.lit(literal_norm(b)) if _is_literal(b) else norm(b)
    return F.try_divide(dot(a, b), norm(a) * nb)


def _is_literal(v) -> bool:
    return not isinstance(v, (Column, str))


def score(vec, query, metric: str = COSINE) -> Column:
    """Similarity of ``vec`` to ``query`` under ``metric``, rounded to 6 places."""
    if metric == COSINE:
        s = cosine(vec, query)
    elif metric == DOT:
        s = dot(vec, query)
    else:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
    return F.round(s, SCORE_DIGITS)


def valid_vector(vec, dim: int) -> Column:
    """FLT-7: the vector has exactly ``dim`` non-null elements."""
    v = as_col(vec)
    return (F.size(v) == F.lit(dim)) & F.forall(v, lambda x: x.isNotNull())


def preview(vec, n: int = 5) -> list[Column]:
    """PRJ-11: dimension and the first ``n`` values."""
    v = as_col(vec)
    return [F.size(v).alias("dim"), F.slice(v, 1, n).alias("head")]


def check_query(query: Sequence[float], dim: int | None = None) -> list[float]:
    q = [float(x) for x in query]
    if dim is not None and len(q) != dim:
        raise ValueError(f"query has {len(q)} dims, table declares {dim}")
    return q
