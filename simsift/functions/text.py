"""Native text column functions: tokens, features, menu text, stable ids (PRJ-*, CHK-1).

All of these are built-in Spark expressions (codegen'd or JVM higher-order
functions); none runs Python per row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values (must stay equal for identical results) --------------------
# Maximum tokens per chunk / embedding input.
MAX_TOKENS = 256
# Namespace of the deterministic point ids (UUIDv5 of "record|chunking|index").
POINT_ID_NAMESPACE = uuid.UUID("d6e29a3a-8f2e-4f0d-9b0a-9e1a9c9f5b3c")
# Prefix and separators of the menu highlights text.
MENU_PREFIX = "Menu highlights: "
MENU_SEP = ", "
MENU_END = "."
MENU_GAP = "\n\n"
# Characters Python's str.isdigit() accepts: Unicode Nd plus the superscript,
# subscript, circled, parenthesized and other digit characters (category No
# with a digit value). Written as a Java regex class.
DIGIT_CLASS = (
    r"[\p{Nd}\x{B2}-\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}"
    r"\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
    r"\x{11F50}-\x{11F59}\x{16AC0}-\x{16AC9}\x{1E4F0}-\x{1E4F9}]"
)
# Whitespace tokenizer (pinned stand-in for a subword tokenizer).
TOKEN_SPLIT = r"\s+"
# ------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Whitespace tokens, empties dropped (CHK-1 unit)."""
    return F.filter(F.split(_c(text), TOKEN_SPLIT), lambda x: x != F.lit(""))


def n_tokens(text) -> Column:
    return F.size(tokens(text))


def text_length(text) -> Column:
    """PRJ-1: length in code points."""
    return F.length(_c(text))


def has_numbers(text) -> Column:
    """PRJ-2: any character that Python's ``isdigit`` accepts."""
    return _c(text).rlike(DIGIT_CLASS)


def menu_highlights(menu_items) -> Column:
    """PRJ-5: 'Menu highlights: a, b.' or '' for a NULL or empty array."""
    m = F.coalesce(_c(menu_items), F.array().cast("array<string>"))
    return F.when(F.size(m) > 0, F.concat(F.lit(MENU_PREFIX), F.array_join(m, MENU_SEP), F.lit(MENU_END))) \
            .otherwise(F.lit(""))


def prepend_menu(chunk, menu_text) -> Column:
    """PRJ-6: menu text, a blank line, then the chunk; unchanged when there is no menu."""
    menu = _c(menu_text)
    return F.when((menu.isNull()) | (menu == F.lit("")), _c(chunk)) \
            .otherwise(F.concat(menu, F.lit(MENU_GAP), _c(chunk)))


def chunk_budget(menu_text, max_tokens: int = MAX_TOKENS) -> Column:
    """PRJ-7: tokens left for the description after the menu, at least 1."""
    return F.greatest(F.lit(max_tokens) - n_tokens(F.coalesce(_c(menu_text), F.lit(""))), F.lit(1))


def uuid5(key, namespace: uuid.UUID = POINT_ID_NAMESPACE) -> Column:
    """PRJ-4: RFC 4122 UUIDv5 of a string column, as a native expression.

    SHA-1 over namespace bytes + UTF-8 key, then version nibble 5 and the
    RFC variant bits, formatted 8-4-4-4-12.
    """
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), _c(key).cast("binary")))
    nib = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.conv(nib.bitwiseAND(3).bitwiseOR(8).cast("string"), 10, 16))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.concat(F.lit("5"), F.substring(h, 14, 3)),
                       F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def point_id(record_id, chunking, chunk_index) -> Column:
    """Stable id of a chunk row: UUIDv5 of ``"record|chunking|index"``."""
    key = F.concat_ws("|", _c(record_id).cast("string"), _c(chunking).cast("string"),
                      _c(chunk_index).cast("string"))
    return uuid5(key)
