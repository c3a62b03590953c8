"""Arrow batches in pieces: what a Python worker holds does not grow with the rows of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

#: Rows that are Python objects at once; a row is a page or a document.
ROWS = 256


def pieces(*columns: pa.Array, rows: int = ROWS) -> Iterator[tuple[list, ...]]:
    """The values of equally long columns, some rows at a time."""
    for i in range(0, len(columns[0]), rows):
        yield tuple(c.slice(i, rows).to_pylist() for c in columns)


def mapped(use: Callable, kind: pa.DataType) -> Callable[[Iterator], Iterator[pa.Array]]:
    """An iterator of batches of one or more columns to arrays of use(value, ...), a piece at a time."""

    def run(batches: Iterator) -> Iterator[pa.Array]:
        for batch in batches:
            for values in pieces(*(batch if isinstance(batch, tuple) else (batch,))):
                yield pa.array([use(*row) for row in zip(*values, strict=True)], kind)

    return run
