"""Finding equal 64-bit keys across all texts without an unbounded group.

A task first groups the keys of its own texts. Rows of a key that the task holds often are known to be
shared and go on at once; only one of them also takes part in the exchange by key. So the exchange gets
few rows per key and task, however often a key occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SINGLE, MARK, SHARED = 0, 1, 2  # of a row: one of few in its task; stands for shared rows; shared


def local_groups(key: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of rows by key and rank, whether each opens its group, and the size of its group."""
    order = np.lexsort((rank, key))
    key = key[order]
    opens = np.ones(len(key), bool)
    opens[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(opens)
    size = np.diff(np.append(first, len(key)))
    return order, opens, np.repeat(size, size)


def spread_by_key(rows: DataFrame) -> DataFrame:
    """Rows with a key (``key``, ``kind``) brought together by key; shared rows go anywhere."""
    place = F.when(F.col("kind") == SHARED, F.xxhash64("key", "doc")).otherwise(F.col("key"))
    return rows.repartition(place).sortWithinPartitions("key")


def whole_groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...] = ("key",)) -> Iterator[pa.Table]:
    """The rows of a sorted stream, cut only where ``columns`` change."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            v = batch.column(c).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
            if rest:
                change[0] |= v[0] != rest[-1].column(c)[-1].as_py()
        cut = np.flatnonzero(change)
        if len(cut):
            head = [*rest, batch.slice(0, cut[-1])]
            rest = [batch.slice(cut[-1])]
            table = pa.Table.from_batches([b for b in head if b.num_rows]) if any(b.num_rows for b in head) else None
            if table is not None:
                yield table
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)
