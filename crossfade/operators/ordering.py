"""Order-based building blocks that never put a whole column into one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from crossfade.sources.tables import materialize

RANGE_ROWS = 1 << 20  # distinct values handled by one task


def place_in_ranges(df: DataFrame, order: list[str], rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` written in ranges of ``order``, each sorted and of about ``rows`` rows, with two more
    columns: ``_part``, the number of the range, and ``_place``, the row's number in it from 0.

    The number of ranges follows the number of rows, so tasks grow in number and not in size. The
    result is a table, so ranges and places stay as they are however often it is read. Runs jobs.
    """
    table = materialize(df)
    parts = -(-table.count() // rows) or 1
    numbered = (
        table.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())  # range number, then 33 bits of place
    )
    return materialize(
        numbered.select(
            *df.columns,
            F.shiftrightunsigned("_at", 33).cast("int").alias("_part"),
            F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place"),
        )
    )


def range_offsets(placed: DataFrame, total: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(*keys, _part, _total, _offset): the sum of each range, and of all ranges before it."""
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.groupBy(*keys, "_part")
        .agg(total.alias("_total"))
        .withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    )


def _add_offset(df: DataFrame, placed: DataFrame, total: Column, col: str) -> DataFrame:
    # one row for each range, so the broadcast holds a millionth of the rows
    offsets = range_offsets(placed, total).select("_part", "_offset")
    return df.join(F.broadcast(offsets), "_part").withColumn(col, F.col(col) + F.col("_offset"))


def running_total(
    df: DataFrame, order_col: str, weight_col: str, out: str, rows: int = RANGE_ROWS
) -> DataFrame:
    """Inclusive running sum of ``weight_col`` in ascending order of a unique column of any sorted
    type: summed within ranges of the column, plus the totals of the ranges before."""
    placed = place_in_ranges(df, [order_col], rows)
    within = W.partitionBy("_part").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    summed = placed.withColumn(out, F.sum(weight_col).over(within))
    return _add_offset(summed, placed, F.sum(weight_col), out).drop("_part", "_place", "_offset")


def dense_index(df: DataFrame, id_cols: str | list[str], out: str, rows: int = RANGE_ROWS) -> DataFrame:
    """Distinct ids in ascending order, numbered from 0 without gaps; ids may be of any sorted type
    or of several columns (nulls first). Places in ranges are known from the write, so nothing is
    windowed."""
    ids = [id_cols] if isinstance(id_cols, str) else id_cols
    placed = place_in_ranges(df.select(*ids).distinct(), ids, rows)
    numbered = placed.withColumn(out, F.col("_place"))
    return _add_offset(numbered, placed, F.count("*"), out).select(*ids, F.col(out).cast("long"))


def histogram_quantiles(
    histogram: DataFrame, quantiles: Sequence[float], rows: int = RANGE_ROWS
) -> DataFrame:
    """(column_name, q, value) from a histogram (column_name, value, n) of distinct values without
    nulls: for every column the value at row ``round((n - 1) * q)`` in sorted order, exactly.

    All columns are placed in ranges together. Sums of the ranges tell in which one a wanted row
    lies, and only these ranges (columns times quantiles at most) are summed up value by value.
    """
    placed = place_in_ranges(histogram, ["column_name", "value"], rows)
    offsets = range_offsets(placed, F.sum("n"), ["column_name"])
    totals = offsets.groupBy("column_name").agg(F.sum("_total").alias("_rows"))
    wanted = F.explode(F.array(*(F.lit(float(q)) for q in quantiles))).alias("q")
    row = F.round((F.col("_rows") - 1) * F.col("q")).cast("long")
    targets = totals.select("column_name", "_rows", wanted).withColumn("_row", row)
    holding = offsets.join(F.broadcast(targets), "column_name").filter(
        (F.col("_row") >= F.col("_offset")) & (F.col("_row") < F.col("_offset") + F.col("_total"))
    )
    within = W.partitionBy("column_name", "q").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    return (
        placed.join(
            F.broadcast(holding.select("column_name", "_part", "q", "_row", "_offset")),
            ["column_name", "_part"],
        )
        .withColumn("_upto", F.sum("n").over(within) + F.col("_offset"))
        .filter(F.col("_upto") > F.col("_row"))
        .groupBy("column_name", "q")
        .agg(F.min("value").alias("value"))
    )


def value_histogram(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(column_name, value, n) of several columns of one type, nulls included, in one pass over
    ``df``; equal values are counted before the shuffle."""
    cells = F.array(
        *(
            F.struct(F.lit(name).alias("column_name"), col.alias("value"))
            for name, col in columns.items()
        )
    )
    return df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def exact_quantiles(df: DataFrame, col: str | Column, quantiles: dict[str, float]) -> DataFrame:
    """One row, a column per name: the value at row ``round((n - 1) * q)`` in sorted order.

    One pass over ``df`` builds the histogram (map-side combined), which is written to the shared
    folder; the rest works on distinct values. Nulls are ignored. Runs jobs.
    """
    column = F.col(col) if isinstance(col, str) else col
    histogram = value_histogram(df, {"value": column}).filter(F.col("value").isNotNull())
    found = histogram_quantiles(histogram, sorted(set(quantiles.values())))
    return found.agg(
        *(
            F.min(F.when(F.col("q") == float(q), F.col("value"))).alias(name)
            for name, q in quantiles.items()
        )
    )


def exact_quantile(df: DataFrame, col: str | Column, q: float, out: str = "value") -> DataFrame:
    return exact_quantiles(df, col, {out: q})


def split_row_number(
    df: DataFrame, keys: list[str], slice_col: str, order: list[Column], out: str
) -> DataFrame:
    """``row_number()`` over ``keys`` ordered by (slice_col, *order), one task per (keys, slice).

    For keys that may be too large for one task: the caller cuts such a key into slices that follow
    the sort order, and the row counts of the earlier slices are added to the rank inside a slice.
    """
    before = W.partitionBy(*keys).orderBy(slice_col).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys, slice_col)
        .agg(F.count("*").alias("_rows"))
        .select(*keys, slice_col, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    within = W.partitionBy(*keys, slice_col).orderBy(*order)
    return (
        df.withColumn(out, F.row_number().over(within))
        .join(offsets, [*keys, slice_col])
        .withColumn(out, F.col(out) + F.col("_before"))
        .drop("_before")
    )


def top_k_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    """The k first rows of each key with their 1-based rank.

    Spark cuts each map task's rows to k per key before the shuffle (WindowGroupLimit), so a key
    holding a large share of the table still ships at most k rows per task.
    """
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(
        F.col(out) <= k
    )


def hash_order(seed: int, *cols: str) -> Column:
    """Seeded pseudo-random sort key that depends on the row's ids only, not on partitioning."""
    return F.md5(F.concat_ws(":", *(F.col(c).cast("string") for c in cols), F.lit(str(seed))))


def sample_keys(keys: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n distinct keys without replacement, repeatable (plans to a distributed top-n)."""
    distinct = keys.select(key).distinct()
    return distinct.orderBy(hash_order(seed, key), key).limit(n)
