"""Small helpers shared by the operators: written intermediate tables, checked broadcasts, components."""

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfade.sources.tables import materialize

# A side of a join is sent to all executors only up to this many (narrow) rows; beyond it, and
# whenever its size is unknown, the join shuffles.
BROADCAST_ROWS = 500_000


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand workers at most this many rows at once: texts can be long, and memory follows the batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def gives_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function over Arrow batches; what its task freed goes back to the machine at its end, since workers
    live on beside the executor's other work and would keep the most they ever used."""

    @functools.wraps(run)
    def run_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
                if trim:
                    trim(0)

    return run_task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder, read in small batches wherever Python works on it."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column, remainder: int):
    """Whether crc32 of the id as text leaves this remainder modulo 5."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == remainder


def small_side(written: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of a few fixed-size columns, marked for broadcast if its counted rows allow it."""
    return F.broadcast(written) if written.count() <= rows else written


def fresh(columns: list[str], name: str) -> str:
    """A column name like this one that none of the given columns has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_keys(docs: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows, with the columns as given, whose key is not among the keys (a written table of one column)."""
    name = fresh(docs.columns, "row_key")
    kept = docs.withColumn(name, key).join(small_side(keys.toDF(name)), name, "left_anti")
    return kept.drop(name).select(*(F.col(f"`{c}`") for c in docs.columns))


def without_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of df whose column is not among the ids (a written table of that one column)."""
    return df.join(small_side(ids), column, "left_anti")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, component), where component is the
    smallest node reachable. Nodes without an edge to another node have no row.

    Alternates the large-star and small-star steps (Kiveris et al. 2014): every round hangs nodes on
    smaller ones until only stars are left. A node with many neighbours is summed up before the
    shuffle (min) and joined back, where skewed partitions can be split; no neighbour list is built.
    """
    stars = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialize(large.where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        following = materialize(small)
        done = following.join(following.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        twice = following.groupBy("a").count().where("count > 1").isEmpty() if done else False
        stars = following
        if done and twice:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
