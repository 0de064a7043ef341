"""Batches inside blocks of a run: the part that runs inside Python workers.

A block is a stretch of products that follow one another. Its ``state`` is how
many rows the batch that is open where it begins still needs; 0 begins a batch.
The functions are pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The products of one block after another, from rows sorted by group, block and place."""
    held, name = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        group, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_group", "_block"))
        cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]) | (block[1:] != block[:-1])) + 1), len(group)]
        for low, high in zip(cuts, cuts[1:]):
            if held and name != (group[low], block[low]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            name = (group[low], block[low])
    if held:
        yield pa.Table.from_batches(held)


def _places(block: pa.Table, size: int) -> tuple[np.ndarray, int, np.ndarray]:
    """Rows of the block before each product, rows of the block, and the product that follows a batch begun at each."""
    before, n = block["_before"].to_numpy(), block["_n"].to_numpy()
    place = before - before[0]
    return place, int(place[-1] + n[-1]), np.searchsorted(place, place + size)


def block_steps(size: int) -> Callable:
    """``_group, _block, state, to_state, n_starts`` of each block and each state it may begin with."""

    def steps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            place, rows, following = _places(block, size)
            n = len(place)
            # Where the batches begun at each product end up: the last one that begins in the block.
            last = np.where(following == n, np.arange(n), following)
            begun = (following < n).astype(np.int64)
            while (following[last] < n).any():
                begun += begun[last]
                last = last[last]
            state = np.arange(size if block["_before"][0].as_py() else 1)
            at = np.searchsorted(place, state)
            inside = np.minimum(at, n - 1)
            needed = np.where(at < n, place[last[inside]] + size, state) - rows
            yield pa.RecordBatch.from_pydict({
                "_group": np.full(len(state), block["_group"][0].as_py(), np.int64),
                "_block": np.full(len(state), block["_block"][0].as_py(), np.int64),
                "state": state,
                "to_state": np.maximum(needed, 0),
                "n_starts": np.where(at < n, begun[inside] + 1, 0),
            })

    return steps


def number_blocks(size: int, columns: list[str]) -> Callable:
    """Products with their batch, from the state their block begins with and the batches before it."""

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            place, _, following = _places(block, size)
            starts, following = np.zeros(len(place), np.int64), following.tolist()
            at = int(np.searchsorted(place, block["_state"][0].as_py()))
            while at < len(place):
                starts[at] = 1
                at = following[at]
            batch = block["_earlier"][0].as_py() + np.cumsum(starts) - 1
            yield from block.select(columns).append_column("batch", pa.array(batch)).to_batches()

    return number


cloudpickle.register_pickle_by_value(sys.modules[__name__])
