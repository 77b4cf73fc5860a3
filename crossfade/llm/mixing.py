"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

A source's size is the number of its words, and all sizes together are to be shared out by weight. No source
can give more than ``most`` times its size (its epochs):

1. Clamp: with a level L, source i is to give min(most * size_i, L * weight_i). L begins at total / sum of weights;
   sources above their cap are clamped to it, the rest is shared again by weight among the others, which
   raises L, until none is above. Only L, a fraction of two whole numbers, passes through the driver; each round is
   one aggregate over the table of sources. Rounds are few, since L rises as in Newton's method.
2. Sample: a source that is to give q words of its s gives every document q div s times whole. The remaining
   q mod s words are one more, fractional repetition: documents in the order of a seeded hash until the words
   are reached; the last one gives only its first words. So each source gives round(target) words exactly.

The order is cut into slices of the hash, in number by the source's rows. Sums of slices tell which one the limit
falls into; only its rows are summed up one by one. So no task holds a source, however hot it is. The hash is
taken of id and text, so that rows without an id are spread too.

A repeated row is one more document, whose words count again. Null and empty
texts have size 0 and give nothing. Rows without a source are a source of their own, the last in order. With no
words at all every target is 0; an empty table gives an empty result.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crossfade.llm.tables import materialize, small_side
from crossfade.operators.ordering import dense_index, hash_order

SLICE_ROWS = 4096  # rows of a source in one slice of its seeded order
_WIDE = "decimal(38,0)"
_SOURCE = ["no_source", "source_name"]


def words(text: str = "text") -> Column:
    """How many runs of other characters than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_level(sources: DataFrame, most: int) -> tuple[int, int]:
    """The level (numerator, denominator) at which the sources (size, weight) give all their sizes together."""
    cap = (F.col("size") * most).cast(_WIDE)
    top, bottom = 0, 1
    while True:
        # above its cap at the level so far; at level 0 this clamps the sources of size 0
        above = cap * F.lit(bottom).cast(_WIDE) <= F.col("weight").cast(_WIDE) * F.lit(top).cast(_WIDE)
        row = sources.agg(
            F.coalesce(F.sum(F.col("size").cast(_WIDE)), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("clamped"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        total, clamped, weights = int(row.total), int(row.clamped), int(row.weights)
        if not weights or (total - clamped) * bottom == top * weights:
            return top, bottom
        top, bottom = total - clamped, weights


def source_targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(no_source, source_name, rows, source_size, target, quota): what each source is to give, the sources
    by code point with null last, weighted by ``weights`` in turn."""
    sums = materialize(
        sized.groupBy(*_SOURCE).agg(F.sum("size").cast("long").alias("size"), F.count("*").alias("rows"))
    )
    place = dense_index(sums, _SOURCE, "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = materialize(sums.join(place.withColumn("weight", weight.cast("long")), _SOURCE))
    top, bottom = water_level(sources, most)
    cap = (F.col("size") * most).cast(_WIDE)
    share = F.col("weight").cast(_WIDE) * F.lit(top).cast(_WIDE)
    full = cap * F.lit(bottom).cast(_WIDE) <= share
    # rounded half up, on whole numbers
    quota = F.expr(f"cast((2 * weight * cast({top} as {_WIDE}) + {bottom}) div (2 * cast({bottom} as {_WIDE})) as long)")
    return materialize(
        sources.select(
            *_SOURCE, "rows", F.col("size").alias("source_size"),
            F.when(full, cap.cast("double")).otherwise(share.cast("double") / F.lit(float(bottom))).alias("target"),
            F.when(full, cap.cast("long")).otherwise(quota).alias("quota"),
        )
    )


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: int = 42, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (of its source), taken (words the mix takes of
    it, repetitions counted: at most ``most`` times its size). Runs jobs."""
    sized = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").isNull().alias("no_source"),
            F.coalesce("source", F.lit("")).alias("source_name"),
            words().alias("size"),
            hash_order(seed, "doc_id", "text").alias("draw"),
        )
    )
    targets = source_targets(sized, weights, most)
    # the first 8 hex digits of the draw as a share of 2^32 pick the slice
    share = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    drawn = sized.join(small_side(targets), _SOURCE).select(
        "*", F.floor(share * F.ceil(F.col("rows") / slice_rows)).alias("slice"),
        F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(F.lit(0)).alias("whole"),
    )
    rest = F.col("quota") - F.col("whole") * F.col("source_size")
    earlier = Window.partitionBy(*_SOURCE).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    limits = (
        drawn.groupBy(*_SOURCE, "slice")
        .agg(F.sum("size").alias("words"), F.first(rest).alias("rest"))
        .withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
        .select(*_SOURCE, F.col("slice").alias("limit_slice"), "before")
    )
    # every source with words has exactly one limit slice, since rest < source_size
    placed = drawn.join(small_side(materialize(limits)), _SOURCE, "left").withColumn("rest", rest)
    at_limit = F.col("slice").eqNullSafe(F.col("limit_slice"))
    order = Window.partitionBy(*_SOURCE).orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    cut = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - upto))
    clear = F.when(F.col("slice") < F.col("limit_slice"), F.col("size")).otherwise(F.lit(0).cast("long"))
    some = placed.where(at_limit).withColumn("extra", cut)
    others = placed.where(~at_limit).withColumn("extra", clear)
    return some.unionByName(others).select(
        "doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("extra")).alias("taken")
    )
