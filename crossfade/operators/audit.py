"""What must hold of any ranked list, whatever model it came from: counted per owner of a list."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

TOLERANCE = 1e-3


def _product(a: str, b: str) -> Column:
    terms = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)


def with_products(
    lists: DataFrame, key: str, item: str, owners: DataFrame, items: DataFrame, cosine: bool = False
) -> DataFrame:
    """Adds ``expected``: the product (or cosine) of the vectors of a row's owner and item. ``owners`` and ``items``
    are (key, vector) and (item, vector). Rows without one of the vectors get null."""
    rows = lists.join(owners.toDF(key, "_a"), key, "left").join(items.toDF(item, "_b"), item, "left")
    product = _product("_a", "_b")
    if cosine:
        product = product / F.sqrt(_product("_a", "_a") * _product("_b", "_b"))
    return rows.withColumn("expected", product).drop("_a", "_b")


def _marked(rows: DataFrame, among: DataFrame, keys: list[str], mark: str) -> DataFrame:
    """Adds ``mark``: 1 where the keys are among these, else null."""
    found = among.select(*keys).distinct().withColumn(mark, F.lit(1))
    return rows.join(found.hint("merge"), keys, "left")


def audit_lists(
    lists: DataFrame,
    key: str,
    item: str,
    score: str,
    allowed: DataFrame | None = None,
    refused: DataFrame | None = None,
    shared: DataFrame | None = None,
) -> DataFrame:
    """One row per owner of a list: rows, different items, first and last rank, and how many rows break a rule.

    ``n_rising`` rows score higher than the row ranked before them. With ``allowed`` (key, item), ``n_foreign`` rows
    are not among these pairs; ``shared`` (item: a short list) are allowed too for every owner that ``allowed`` names.
    With ``refused``, ``n_refused`` rows are among these pairs. Both are joined by a shuffle, since lists made inside a
    plan have more rows than Spark expects and would be gathered in the driver to be broadcast. If the lists have a column ``expected``,
    ``n_wrong`` rows have no such value or a score that differs from it by more than ``TOLERANCE`` of its size or of 1.
    """
    pair = [key, item]
    extra = ["expected"] if "expected" in lists.columns else []
    rows = lists.select(*pair, "rank", F.col(score).cast("double").alias("_score"), *extra)
    counts = [
        F.count("*").alias("n_rows"),
        F.count_distinct(item).alias("n_items"),
        F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"),
        F.count_if(F.col("_score") > F.col("_before")).alias("n_rising"),
    ]
    if allowed is not None:
        rows = _marked(rows, allowed, pair, "_allowed")
        if shared is not None:
            everyone = F.array_contains(shared.select(F.collect_set(item)).scalar(), F.col(item))
            rows = _marked(rows, allowed, [key], "_owner")
            rows = rows.withColumn("_allowed", F.when(everyone & F.col("_owner").isNotNull(), 1).otherwise(F.col("_allowed")))
        counts.append(F.count_if(F.col("_allowed").isNull()).alias("n_foreign"))
    if refused is not None:
        rows = _marked(rows, refused, pair, "_refused")
        counts.append(F.count_if(F.col("_refused").isNotNull()).alias("n_refused"))
    if extra:
        bound = TOLERANCE * F.greatest(F.lit(1.0), F.abs("expected"))
        near = F.coalesce(F.abs(F.col("_score") - F.col("expected")) <= bound, F.lit(False))
        counts.append(F.count_if(~near).alias("n_wrong"))
    before = F.lag("_score").over(W.partitionBy(key).orderBy("rank"))
    return rows.withColumn("_before", before).groupBy(key).agg(*counts)
