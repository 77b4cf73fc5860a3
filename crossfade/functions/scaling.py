"""Score arithmetic."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar(df: DataFrame, col: str | Column) -> Column:
    """The single value of a one-row table, as a scalar subquery (run once, no join)."""
    return df.select(col).scalar()


def divide_by_max(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """``col / max(col)`` over the whole table."""
    top = scalar(df, F.max(col))
    return df.withColumn(out or col, F.col(col) / top)


def min_max_scale(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """``(x - min) / (max - min)``; left as it is when all values are equal."""
    x = F.col(col).cast("double")
    bounds = scalar(df, F.struct(F.min(x).alias("low"), F.max(x).alias("high")))
    low, high = F.col("_bounds.low"), F.col("_bounds.high")
    scaled = F.when(high > low, (x - low) / (high - low)).otherwise(x)
    return df.withColumn("_bounds", bounds).withColumn(out or col, scaled).drop("_bounds")


def confidence(count: str | Column, alpha: float = 1.0) -> Column:
    """Implicit-feedback confidence of a pair heard ``count`` times."""
    return F.lit(1.0) + F.lit(float(alpha)) * (F.col(count) if isinstance(count, str) else count)


def sparsity_percent(nonzeros: Column, rows: Column, columns: Column) -> Column:
    return F.lit(100.0) * (F.lit(1.0) - nonzeros / (rows.cast("double") * columns))


def rank_gain(rank: Column) -> Column:
    """Discount of a hit at 1-based ``rank``."""
    return F.lit(1.0) / F.log2(rank + F.lit(1.0))


def self_information(popularity: Column, top: Column) -> Column:
    """Novelty of one recommended item; the offset keeps log2 finite at zero popularity."""
    return -F.log2(popularity / top + F.lit(1e-10))
