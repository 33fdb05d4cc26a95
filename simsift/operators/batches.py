"""Bounded work inside Arrow tasks: pieces of batches by rows or by size, memory given back when a task ends."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# functions of this module run in Arrow tasks; they travel by value, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pieces(batches, rows: int):
    """The record batches in slices of at most ``rows`` rows (an empty batch stays)."""
    for rb in batches:
        for a in range(0, max(1, rb.num_rows), rows):
            yield rb.slice(a, rows)


def runs(sizes, budget: int):
    """Row ranges ``(a, b)`` whose sizes sum to at most ``budget``, one row at least."""
    import numpy as np

    ends = np.cumsum(np.asarray(sizes, np.int64))
    a, n = 0, len(ends)
    while a < n:
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + budget, side="right"))
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def trimmed(run):
    """The function ``run`` of an iterator; what its task freed goes back to the system, as Spark reuses workers."""
    def wrapped(batches):
        import ctypes
        import gc

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # of the GNU C library
            if trim is not None:
                trim(0)

    return wrapped
