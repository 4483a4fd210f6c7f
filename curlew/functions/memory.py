"""Memory of Python workers, which live on between batches and stages."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

#: Rows whose results are Python objects at once.
ROWS = 64


def give_back() -> None:
    """Returns to the system what this process has freed; its allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def by_rows(f: Callable, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """f of each row as one array. Only ROWS rows at a time are Python objects, inputs and results."""
    done = []
    for at in range(0, len(columns[0]), ROWS):
        rows = zip(*[c.slice(at, ROWS) for c in columns], strict=True)
        done.append(pa.array([f(*[x.as_py() for x in row]) for row in rows], kind))
    return pa.concat_arrays(done) if done else pa.array([], kind)


def lean(f: Callable, kind: pa.DataType) -> Callable[[Iterator], Iterator]:
    """The function of rows over an iterator of Arrow batches (arrays, or tuples of them), which holds little between them."""

    def run(batches):
        for batch in batches:
            yield by_rows(f, kind, *(batch if isinstance(batch, tuple) else (batch,)))
            batch = None
            give_back()

    return run
