"""Indexes built once per application and searched in their stored form.

An index lives below the shared checkpoint folder (``session.checkpoint_dir``,
which fails on a cluster that names none). It is built on the first use in an
application and keyed by what it was built from; inputs are taken as immutable
for the lifetime of the application.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from simsift.session import checkpoint_dir

_BUILT: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, name: str, source: str, write: Callable[[str], None]) -> DataFrame:
    """The index ``name`` over ``source``; ``write(path)`` builds it when this application has not yet."""
    return spark.read.parquet(stored_path(spark, name, source, write))


def stored_path(spark: SparkSession, name: str, source: str, write: Callable[[str], None]) -> str:
    """Where :func:`stored` keeps the index; other formats than Parquet are read by the caller."""
    key = (spark.sparkContext.applicationId, name, source)
    if key not in _BUILT:
        digest = hashlib.sha256(repr(key).encode()).hexdigest()[:16]
        path = f"{checkpoint_dir(spark).rstrip('/')}/simsift-index/{name}-{digest}"
        write(path)
        _BUILT[key] = path
    return _BUILT[key]
