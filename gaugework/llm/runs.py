"""Runs of documents that share a local dictionary: codes instead of values, looked up corpus-wide once per run and value.

A run is some megabytes of whole texts. Its dictionary lists each value that occurs in it once; documents refer to it by
position. What the corpus says about a value is joined to the dictionaries, which are far shorter than the documents' values,
and brought back to the documents of the run by grouping on the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

RUN_BYTES = 1 << 22


def run_ids() -> Iterator[int]:
    """Numbers no other task of the stage gives; a stage that uses them is written once and read back."""
    task = TaskContext.get()
    first = (task.partitionId() if task else 0) << 32
    while True:
        yield first
        first += 1


def pack(at: np.ndarray, n: np.ndarray) -> bytes:
    """Increasing positions and their counts as bytes, the high bytes apart from the low ones, so that they compress well."""
    steps = np.diff(at, prepend=0).astype("<u4")
    return np.concatenate([x.view(np.uint8).reshape(-1, 4).T.ravel() for x in (steps, n.astype("<u4"))]).tobytes()


def unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and count of every entry of a column of packed values."""
    rows, ats, ns = [], [], []
    for r, cell in enumerate(column):
        planes = np.frombuffer(cell.as_buffer(), np.uint8)
        steps, n = np.ascontiguousarray(planes.reshape(2, 4, -1).transpose(0, 2, 1)).view("<u4")[..., 0]
        rows.append(np.full(len(n), r, np.int64))
        ats.append(np.cumsum(steps, dtype=np.int64))
        ns.append(n.astype(np.int64))
    empty = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or empty) for x in (rows, ats, ns))


def counted(row: np.ndarray, code: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes below 2^32 of each row in order, how often they occur, and the rows' offsets."""
    key = np.sort(row << 32 | code)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.diff(np.append(first, len(key)))
    key = key[first]
    return key & 0xFFFFFFFF, n, np.searchsorted(key >> 32, np.arange(rows + 1))
