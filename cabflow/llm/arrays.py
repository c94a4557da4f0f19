"""Hash arithmetic on numpy arrays, for operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd, so that it keeps all bits.
STEP = np.uint64(0xD6E8FEB86659FD93)


def runs_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash for every ``k`` neighbours; as many as fit."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    hashes = hashes.view(np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= STEP
        out += hashes[j : j + n]
    return mixed(out, k)


def lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of numbers in a column, without copies; empty where null."""
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    for a, b in zip(offsets, offsets[1:], strict=False):
        yield values[a:b]


def as_lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """Gives Arrow's unused memory back when a task ends: the worker waits for the next one with what it holds."""

    def then_release(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return then_release
