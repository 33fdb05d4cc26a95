"""Payload filter conditions (FLT-1..5) as Spark Columns.

``must`` is an AND; a NULL field never matches (SQL three-valued logic collapses
to "not selected" in ``where``). Range bounds are inclusive for ``gte``/``lte``.
Simple comparisons push down to the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the word-tokenizer splits on anything that is not a letter or digit.
WORD_SPLIT = r"[^\p{L}\p{N}]+"


def match_value(field: str, value) -> Column:
    """Keyword equality (FLT-2)."""
    return F.col(field) == F.lit(value)


def match_any(field: str, values) -> Column:
    return F.col(field).isin(list(values))


def range_(field: str, gte=None, gt=None, lte=None, lt=None) -> Column:
    """Numeric range (FLT-3); every given bound must hold."""
    c = F.col(field)
    conds = []
    if gte is not None:
        conds.append(c >= F.lit(gte))
    if gt is not None:
        conds.append(c > F.lit(gt))
    if lte is not None:
        conds.append(c <= F.lit(lte))
    if lt is not None:
        conds.append(c < F.lit(lt))
    if not conds:
        raise ValueError("range_ needs at least one bound")
    return reduce(lambda a, b: a & b, conds)


def text_contains(field: str, term: str) -> Column:
    """FLT-4: case-sensitive substring match (no text index)."""
    return F.col(field).contains(F.lit(term))


def word_tokens(text) -> Column:
    """Lower-cased word tokens: split on non letters/digits, empties dropped."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), WORD_SPLIT), lambda x: x != F.lit(""))


def query_words(query: str) -> list[str]:
    """Tokenise a query string with the same rule (driver side, tiny input)."""
    import regex

    return sorted({w for w in regex.split(WORD_SPLIT, query.lower()) if w})


def text_match(field: str, query: str) -> Column:
    """FLT-5: all query words present as tokens, any order. No words → no match."""
    words = query_words(query)
    if not words:
        return F.lit(False)
    # the query words are distinct, so all are present iff the intersection keeps
    # every one of them; the text is tokenised once (not once per word)
    return F.size(F.array_intersect(F.array(*[F.lit(w) for w in words]), word_tokens(field))) == F.lit(len(words))


def must(*conds: Column) -> Column:
    """FLT-1: AND of all conditions; NULL counts as no match inside ``where``.

    Kept as a plain conjunction (no coalesce wrapper) so Catalyst can split it
    and push each simple comparison down to the Parquet scan.
    """
    if not conds:
        return F.lit(True)
    return reduce(lambda a, b: a & b, conds)
