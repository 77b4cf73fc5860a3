"""Packed sparse matrices: round trips and slices equal the triplets, and a slice opens few blocks."""

import numpy as np
import pytest

from crossfade.operators.matrix import pack, row_slice, unpack

SCHEMA = "user_idx long, item_idx long, weight double"


def triplets(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("entries", [1, 7, 4096])
def test_round_trip_and_slices(spark, folder, entries):
    rng = np.random.default_rng(1)
    pairs = {(int(u), int(i)) for u, i in zip(rng.integers(0, 60, 300), rng.integers(0, 40, 300))}
    rows = [(u, i, float(u * 100 + i)) for u, i in pairs]
    rows += [(1 << 40, i, 0.5) for i in range(200)]  # a long row, far from the others
    blocks = pack(triplets(spark, rows), entries=entries)
    blocks.write.parquet(f"{folder}/matrix")
    blocks = spark.read.parquet(f"{folder}/matrix")
    assert max(r["n_entries"] for r in blocks.collect()) <= entries
    assert found(unpack(blocks)) == sorted(rows)
    for low, high in ((0, 1), (10, 30), (59, 1 << 40), (1 << 40, 1 << 41), (70, 80)):
        assert found(unpack(blocks, low=low, high=high)) == sorted(r for r in rows if low <= r[0] < high)


def test_slice_opens_only_its_blocks(spark, folder):
    blocks = pack(triplets(spark, [(u, i, 1.0) for u in range(100) for i in range(20)]), entries=100)
    blocks.write.parquet(f"{folder}/matrix")
    part = row_slice(spark.read.parquet(f"{folder}/matrix"), 40, 50)
    assert part.count() <= 4 + 8  # 200 entries, and the last of each partition
    plan = part._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(last_row,40)" in plan and "LessThan(first_row,50)" in plan


def test_nulls_repeats_and_nothing(spark):
    rows = [(1, 2, None), (1, 2, 3.0), (None, 2, 1.0), (1, None, 1.0)]
    got = unpack(pack(triplets(spark, rows))).collect()
    assert len(got) == 2 and {str(r["weight"]) for r in got} == {"nan", "3.0"}
    assert pack(triplets(spark, [])).count() == 0 and unpack(pack(triplets(spark, []))).count() == 0
