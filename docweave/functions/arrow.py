"""Columns of an Arrow batch to Python values and back, without a step per scalar."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

STAMP = pa.timestamp("us", tz="UTC")
STOCK_MAP = pa.map_(pa.string(), pa.int32())


def texts(column: pa.Array) -> list:
    """Strings, or decimals as text; None for null."""
    if pa.types.is_decimal(column.type):
        column = column.cast(pa.string())
    return column.to_numpy(zero_copy_only=False).tolist()


def longs(column: pa.Array) -> list:
    """Integers; 0 for null."""
    return column.fill_null(0).to_numpy(zero_copy_only=False).tolist()


def micros(column: pa.Array) -> list:
    """Times as microseconds since the epoch; 0 for null."""
    return longs(column.cast(STAMP).cast(pa.int64()))


class RepeatedMaps:
    """A map column most of whose rows repeat the row before."""

    def __init__(self):
        self._distinct: list = []
        self._rows: list[int | None] = []
        self._last = None

    def append(self, entries) -> None:
        """``entries``: pairs in order, or None; compared with the last by identity."""
        if entries is None:
            self._rows.append(None)
            return
        if entries is not self._last:
            self._distinct.append(entries)
            self._last = entries
        self._rows.append(len(self._distinct) - 1)

    def array(self) -> pa.Array:
        return pa.array(self._distinct, STOCK_MAP).take(pa.array(self._rows, pa.int64()))


def changes(column: pa.Array) -> np.ndarray:
    """Rows whose value differs from the row before; the first row always counts."""
    values = column.dictionary_encode().indices.to_numpy() if pa.types.is_string(
        column.type
    ) else column.to_numpy(zero_copy_only=False)
    differs = np.ones(len(values), dtype=bool)
    differs[1:] = values[1:] != values[:-1]
    return differs
