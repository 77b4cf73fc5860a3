"""A sparse matrix as blocks of compressed rows: what is written, read by row ranges and unpacked again.

A block holds at most ``ENTRIES`` neighbouring entries in the order of row and column: its rows, where each of them
begins, and the columns and weights of its entries, as little-endian binary. Only rows with an entry are named, so
gaps cost nothing, and a row of any length runs on through as many blocks as it needs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRIES = 65_536

_BLOCKS = "first_row long, last_row long, n_entries int, rows binary, starts binary, columns binary, weights binary"


def pack(matrix: DataFrame, row: str = "user_idx", column: str = "item_idx", weight: str = "weight", entries: int = ENTRIES) -> DataFrame:
    """Blocks of (row, column, weight), sorted by row within range partitions. Null weights become NaN; entries without a
    row or column are left out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            n += batch.num_rows
            if n >= entries:
                whole = [np.concatenate(parts) for parts in zip(*held)]
                full = n // entries * entries
                for lo in range(0, full, entries):
                    yield block(*(part[lo : lo + entries] for part in whole))
                held, n = [[part[full:] for part in whole]], n - full
        if n:
            yield block(*(np.concatenate(parts) for parts in zip(*held)))

    def block(rows: np.ndarray, columns: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
        named, starts = np.unique(rows, return_index=True)
        values = [
            pa.array([int(rows[0])], pa.int64()), pa.array([int(rows[-1])], pa.int64()), pa.array([len(rows)], pa.int32()),
            *(pa.array([part.tobytes()], pa.binary()) for part in (
                named.astype("<i8"), starts.astype("<i4"), columns.astype("<i8"), weights.astype("<f8"))),
        ]
        return pa.RecordBatch.from_arrays(values, ["first_row", "last_row", "n_entries", "rows", "starts", "columns", "weights"])

    triplets = matrix.select(
        F.col(row).cast("long").alias("r"), F.col(column).cast("long").alias("c"), F.coalesce(F.col(weight).cast("double"), F.lit(float("nan")))
    ).where("r is not null and c is not null")
    return triplets.repartitionByRange("r", "c").sortWithinPartitions("r", "c").mapInArrow(cut, _BLOCKS)


def row_slice(blocks: DataFrame, low: int, high: int) -> DataFrame:
    """The blocks with rows in [low, high): both bounds reach the scan, which passes over files and row groups by their
    smallest and largest rows."""
    return blocks.where((F.col("last_row") >= low) & (F.col("first_row") < high))


def unpack(
    blocks: DataFrame, row: str = "user_idx", column: str = "item_idx", weight: str = "weight", low: int | None = None, high: int | None = None
) -> DataFrame:
    """(row, column, weight) of all entries, or of the rows in [low, high)."""
    if low is not None and high is not None:
        blocks = row_slice(blocks, low, high)

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, rows, starts, columns, weights in zip(*(batch.column(i).to_pylist() for i in range(5))):
                named, at = np.frombuffer(rows, "<i8"), np.frombuffer(starts, "<i4")
                each = np.repeat(named, np.diff(at, append=n))
                lo = 0 if low is None else int(np.searchsorted(each, low))
                hi = n if high is None else int(np.searchsorted(each, high))
                parts = [each, np.frombuffer(columns, "<i8"), np.frombuffer(weights, "<f8")]
                yield pa.RecordBatch.from_arrays([pa.array(part[lo:hi]) for part in parts], [row, column, weight])

    wanted = blocks.select("n_entries", "rows", "starts", "columns", "weights")
    return wanted.mapInArrow(open_, f"`{row}` long, `{column}` long, `{weight}` double")
