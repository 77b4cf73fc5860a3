"""Exact top-k inner products between two vector tables: packed blocks, bounds, and a threshold per query.

Vectors are packed into blocks of near ones, each described by a ball (centre, radius) and its longest vector. For
a query q, no item x of a block has a larger product than ``min(q.centre + |q| radius, |q| longest)``. Queries are
packed in the same way, and a block of queries is searched in two steps:

1. Home: the few item blocks with the largest bounds are scored. Each query's k-th score so far is its threshold.
2. Open: only the blocks whose bound reaches the threshold of one of the queries are scored, best bounds first, each
   only for the queries that need it; the threshold rises on the way.

Blocks without an open pair are never copied to the queries, so as many bytes move as pairs are opened, and the items
move once for each block of queries at most. That is why blocks of queries are large, also where the items themselves
ask: one a core, until they reach ``QUERY_ROWS``. How
many that is depends on the data: few for vectors in clusters or of unequal length, nearly all for vectors without
any structure, as in every exact search. ``TopK.pairs`` has what was opened. Where there are few pairs of blocks, the
first step takes all of them in the order of their bounds, and no second one is needed; the rows are the same.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from crossfade.operators.ordering import top_k_per_key
from crossfade.sources.tables import materialize

QUERY_ROWS = 65536  # most queries of a block
ITEM_ROWS = 128  # items of a block, as long as MOST_BLOCKS are enough
MOST_BLOCKS = 16384  # their descriptions are sent to all tasks
SAMPLE = 8192  # vectors from which centres are learnt
CENTRES = 1024
HOME_ROWS = 2048  # items scored in the first step
STRIPE = 256  # blocks that one task scores in the second step
ONE_STEP = 4096  # up to so many pairs of blocks, each task goes through all items in one step
_SLICE_ROWS = 256  # query rows scored at a time inside a task
_ITEMS_AT_ONCE = 1024  # against at least so many items
_BOUNDS = 1 << 22  # bounds held at a time
_RESCORE = 1 << 16  # pairs whose exact products are taken at a time
_SLACK = 1e-9  # far above rounding, relative to the lengths

_PACKED = "block int, ids array<long>, vectors binary, centre array<double>, radius double, longest double"
_FOUND = "query_id long, item_id long, score double"


class TopK(NamedTuple):
    rows: DataFrame  # query_id, item_id, score, rank
    pairs: DataFrame  # one row: query_blocks, item_blocks, opened


class _Balls(NamedTuple):
    """Descriptions of all item blocks, by number."""

    block: np.ndarray
    rows: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    longest: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest product that each query can have in each block, with room for rounding."""
        length = np.linalg.norm(queries, axis=1, keepdims=True)
        reach = queries @ self.centre.T + length * self.radius
        return np.minimum(reach, length * self.longest) + _SLACK * length * self.longest

    def slices(self, queries: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """``bounds`` of some queries at a time."""
        rows = max(1, _BOUNDS // len(self.block))
        for start in range(0, len(queries), rows):
            some = slice(start, start + rows)
            yield some, self.bounds(queries[some])


def _matrix(vectors: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(vectors, np.float64).reshape(rows, -1)


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    squares = (centres * centres).sum(axis=1) - 2 * vectors @ centres.T
    near = squares.argmin(axis=1)
    return near, np.linalg.norm(vectors - centres[near], axis=1)


def _centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Centres of a bounded sample, by a few rounds of k-means from evenly spaced rows."""
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)]
    for _ in range(6):
        near, _ = _nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        sizes = np.bincount(near, minlength=count)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def _pack(vectors: DataFrame, id_col: str, rows: int | None, most_rows: int, tasks: int = 1) -> DataFrame | None:
    """Blocks of about ``rows`` near vectors, written; None if there is no vector."""
    values = F.col("vector").cast("array<double>")
    finite = F.forall(values, lambda c: F.abs(c) < float("inf"))  # false for nan
    kept = vectors.where(F.col("vector").isNotNull() & finite)
    seen = Observation()  # how many rows the write sees
    table = materialize(
        kept.select(F.col(id_col).cast("long").alias("id"), values.alias("vector")).observe(seen, F.count(F.lit(1)).alias("n"))
    )
    n = seen.get["n"]
    if not n:
        return None
    rows = rows or max(min(-(-n // tasks), most_rows), -(-n // MOST_BLOCKS))
    share = F.lit(min(SAMPLE / n, 1.0) * 2.0**30)
    picked = table.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= share).limit(2 * SAMPLE)
    sample = np.array([r["vector"] for r in picked.select("vector").collect()] or [table.first()["vector"]])
    centres = _centres(sample, min(CENTRES, -(-n // rows), len(sample)))
    near, distance = _nearest(sample, centres)
    # a cluster is cut into shells of equal numbers by the distance from its centre
    cuts, first = [], [0]
    for c in range(len(centres)):
        mine = np.sort(distance[near == c])
        parts = max(1, round(len(mine) / len(sample) * n / rows))
        cuts.append(mine[(np.arange(1, parts) * len(mine)) // parts] if len(mine) else mine)
        first.append(first[-1] + len(cuts[-1]) + 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            data = batch.column(1).flatten().to_numpy().reshape(len(ids), -1)
            own, far = _nearest(data, centres)
            block = np.empty(len(ids), np.int32)
            for c in np.unique(own):
                at = np.flatnonzero(own == c)
                low, high = (np.searchsorted(cuts[c], far[at], side) for side in ("left", "right"))
                # vectors at one distance, such as copies, are dealt over all shells that end there
                block[at] = first[c] + low + (ids[at] * 0x9E3779B1 >> 16) % (high - low + 1)
            yield pa.RecordBatch.from_arrays([pa.array(block), batch.column(0), batch.column(1)], names=["block", "id", "vector"])

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        data = group.column("vector").combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
        centre = data.mean(axis=0)
        return pa.table(
            {
                "block": pa.array([key[0].as_py()], pa.int32()),
                "ids": pa.array([group.column("id").to_numpy()], pa.list_(pa.int64())),
                "vectors": pa.array([data.tobytes()], pa.binary()),
                "centre": pa.array([centre], pa.list_(pa.float64())),
                "radius": pa.array([np.linalg.norm(data - centre, axis=1).max()]),
                "longest": pa.array([np.linalg.norm(data, axis=1).max()]),
            }
        )

    placed = table.mapInArrow(place, "block int, id long, vector array<double>")
    return materialize(placed.groupBy("block").applyInArrow(pack, _PACKED))


def _balls(blocks: DataFrame) -> _Balls:
    rows = blocks.select("block", F.size("ids"), "centre", "radius", "longest").orderBy("block").collect()
    block, size, centre, radius, longest = zip(*rows)
    return _Balls(np.array(block), np.array(size), np.array(centre), np.array(radius), np.array(longest))


class _Search:
    """The k best items so far of the queries of a block, best first; places not yet filled have a score of -inf."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, least: np.ndarray | None) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.length = np.linalg.norm(vectors, axis=1)
        # thresholds from other tasks count for what is opened, not for what is found
        self.least = np.full(len(ids), -np.inf) if least is None else least
        self.item = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.score = np.full((len(ids), k), -np.inf)

        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.blocks, self.enough = 0, 2 * k  # the first thresholds come early

    def add(self, item_ids: np.ndarray, items: np.ndarray, bound: np.ndarray, barred: tuple[np.ndarray, np.ndarray]) -> None:
        """Items whose products are at most ``bound``, without the barred pairs; some blocks are scored at a time."""
        if not (bound >= self.least).any():
            return
        self.blocks += 1
        places = np.searchsorted(self.ids, barred[0]), np.searchsorted(item_ids, barred[1])
        self.waiting.append((item_ids, items, bound, *places))
        if sum(len(w[0]) for w in self.waiting) >= self.enough:
            self.settle()
            self.enough = min(2 * self.enough, _ITEMS_AT_ONCE)

    def settle(self) -> None:
        """Score the blocks that wait."""
        if not self.waiting:
            return
        ids, matrices, bounds, out_rows, out_items = zip(*self.waiting)
        self.waiting = []
        first = np.cumsum([0, *map(len, ids)])
        out_rows, out_items = np.concatenate(out_rows), np.concatenate([o + f for o, f in zip(out_items, first)])
        item_ids, items = np.concatenate(ids), np.concatenate(matrices)
        wanted = np.flatnonzero(np.max(bounds, axis=0) >= self.least)
        slack = 2 * _SLACK * np.linalg.norm(items, axis=1).max()
        for start in range(0, len(wanted), _SLICE_ROWS):
            rows = wanted[start : start + _SLICE_ROWS]
            scores = self.vectors[rows] @ items.T
            if len(out_rows):
                at = np.searchsorted(rows, out_rows)
                here = (at < len(rows)) & (rows[np.minimum(at, len(rows) - 1)] == out_rows)
                scores[at[here], out_items[here]] = -np.inf
            least, near = self.least[rows], slack * self.length[rows]
            enough = scores >= (least - near)[:, None]
            if self.k < scores.shape[1]:
                many = np.flatnonzero(np.count_nonzero(enough, axis=1) > 2 * self.k)
                most = scores[many]
                kth = -np.partition(-most, self.k - 1, axis=1)[:, self.k - 1]
                enough[many] &= most >= (kth - near[many])[:, None]
            r, c = np.nonzero(enough & (scores > -np.inf))
            # products of single pairs, so that equal vectors have equal scores wherever they stand
            for i in range(0, len(r), _RESCORE):
                a, b = rows[r[i : i + _RESCORE]], c[i : i + _RESCORE]
                self._merge(a, item_ids[b], np.einsum("ij,ij->i", self.vectors[a], items[b]))

    def _merge(self, row: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        better = (score > self.score[row, -1]) | ((score == self.score[row, -1]) & (item < self.item[row, -1]))
        row, item, score = row[better], item[better], score[better]
        if not len(row):
            return
        some = np.unique(row)
        row = np.concatenate([np.repeat(some, self.k), row])
        item = np.concatenate([self.item[some].ravel(), item])
        score = np.concatenate([self.score[some].ravel(), score])
        order = np.lexsort((item, -score, row))
        row, item, score = row[order], item[order], score[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        self.item[some], self.score[some] = item[keep].reshape(-1, self.k), score[keep].reshape(-1, self.k)
        self.least[some] = np.maximum(self.least[some], self.score[some, -1])

    def found(self) -> tuple[np.ndarray, ...]:
        self.settle()
        row, place = np.nonzero(self.score > -np.inf)
        return self.ids[row], self.item[row, place], self.score[row, place]


def _searcher(k: int, balls: _Balls, open_more: bool):
    """Scores streams of rows sorted by (query block, stripe, place): the query block, then its item blocks."""
    number = {int(b): i for i, b in enumerate(balls.block)}

    def result(block: int, search: _Search, seen: list[int]) -> pa.RecordBatch:
        found = search.found()
        more = np.zeros(0, np.int32)
        if open_more:
            best, done = np.full(len(balls.block), -np.inf), [number[b] for b in seen]
            for some, bounds in balls.slices(search.vectors):
                bounds[:, done] = -np.inf
                bounds[bounds < search.least[some, None]] = -np.inf
                best = np.maximum(best, bounds.max(axis=0))
            order = np.argsort(-best, kind="stable")
            more = balls.block[order[best[order] > -np.inf]].astype(np.int32)
        values = [block, *found, search.least, more, search.blocks]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, _RESULT_ARROW)], schema=_RESULT_ARROW
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, current, seen = None, None, []
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            for i in range(batch.num_rows):
                row = {name: column[i] for name, column in columns.items()}
                ids = row["ids"].values.to_numpy()
                vectors = _matrix(row["vectors"].as_buffer(), len(ids))
                if row["item_block"].as_py() is None:
                    if search is not None:
                        yield result(current, search, seen)
                    least = row["least"].values
                    least = None if least is None else least.to_numpy().copy()
                    search, current, seen = _Search(ids, vectors, k, least), row["block"].as_py(), []
                    continue
                ball = number[row["item_block"].as_py()]
                one = _Balls(*(column[ball : ball + 1] for column in balls))
                barred = row["barred"].values
                pairs = tuple(barred.field(x).to_numpy() for x in (0, 1)) if barred is not None else (ids[:0], ids[:0])
                search.add(ids, vectors, one.bounds(search.vectors)[:, 0], pairs)
                seen.append(row["item_block"].as_py())
        if search is not None:
            yield result(current, search, seen)

    return run


_RESULT = (
    "block int, query_ids array<long>, item_ids array<long>, scores array<double>, least array<double>, "
    "more array<int>, scored int"
)
_RESULT_ARROW = pa.schema(
    [("block", pa.int32()), ("query_ids", pa.list_(pa.int64())), ("item_ids", pa.list_(pa.int64())),
     ("scores", pa.list_(pa.float64())), ("least", pa.list_(pa.float64())), ("more", pa.list_(pa.int32())), ("scored", pa.int32())]
)


def _home_blocks(balls: _Balls, rows: int | None):
    """(block, item_block, place): the item blocks that most queries of a block have their largest bound in, until
    they hold so many rows (None: all blocks, the largest bounds first)."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, size, vectors in zip(*(batch.column(i) for i in range(3))):
                votes, best = np.zeros(len(balls.block), int), np.full(len(balls.block), -np.inf)
                for _, bounds in balls.slices(_matrix(vectors.as_buffer(), size.as_py())):
                    votes += np.bincount(bounds.argmax(axis=1), minlength=len(balls.block))
                    best = np.maximum(best, bounds.max(axis=0))
                order = np.lexsort((-best, -votes))
                if rows is not None:
                    order = order[: int(np.searchsorted(np.cumsum(balls.rows[order]), rows)) + 1]
                chosen, n = balls.block[order].astype(np.int32), len(order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block.as_py()), pa.int32()), pa.array(chosen), pa.array(np.arange(1, n + 1), pa.int32())],
                    names=["block", "item_block", "place"],
                )

    return choose


def search_blocks(
    queries: DataFrame | None,
    items: DataFrame,
    k: int,
    excluded: DataFrame | None = None,
    query_rows: int | None = None,
    item_rows: int | None = None,
    stripe: int = STRIPE,
) -> TopK:
    """See ``top_k_products``; also how many pairs of blocks were opened. Runs jobs."""
    spark = items.sparkSession
    cores = spark.sparkContext.defaultParallelism
    nothing = TopK(
        spark.createDataFrame([], f"{_FOUND}, rank int"),
        spark.createDataFrame([(0, 0, 0)], "query_blocks long, item_blocks long, opened long"),
    )
    item_blocks = _pack(items, "item_id", item_rows, ITEM_ROWS)
    if item_blocks is None:
        return nothing
    if queries is None:
        query_blocks = _pack(items.withColumnRenamed("item_id", "query_id"), "query_id", query_rows, QUERY_ROWS, cores)
    else:
        query_blocks = _pack(queries, "query_id", query_rows, QUERY_ROWS, 4 * cores)
    if query_blocks is None:
        return nothing
    n_queries, last = query_blocks.agg(F.count("*"), F.max("block")).first()
    balls = _balls(item_blocks)
    stored = item_blocks.select(F.col("block").alias("item_block"), "ids", "vectors")
    asking = query_blocks.select("block", "ids", "vectors")

    barred_type = "array<struct<query_id:bigint,item_id:bigint>>"
    if excluded is not None:
        of_query = query_blocks.select("block", F.explode("ids").alias("query_id"))
        of_item = item_blocks.select(F.col("block").alias("item_block"), F.explode("ids").alias("item_id"))
        barred = (
            excluded.select("query_id", "item_id").join(of_item, "item_id").join(of_query, "query_id")
            .groupBy("block", "item_block").agg(F.collect_list(F.struct("query_id", "item_id")).alias("barred"))
        )

    def score(pairs: DataFrame, asking: DataFrame, open_more: bool, stripes: int = 1) -> DataFrame:
        """pairs: block, stripe, item_block, place from 1 on; asking: block, ids, vectors, least. A task for each block
        and stripe."""
        if excluded is not None:
            pairs = pairs.join(barred, ["block", "item_block"], "left")
        else:
            pairs = pairs.withColumn("barred", F.lit(None).cast(barred_type))
        heads = pairs.select("block", "stripe").distinct().join(asking, "block").select(
            "block", "stripe", F.lit(None).cast("int").alias("item_block"), F.lit(0).alias("place"), "ids", "vectors", "least",
            F.lit(None).cast(barred_type).alias("barred"),
        )
        rest = pairs.join(stored, "item_block").select(
            "block", "stripe", "item_block", "place", "ids", "vectors", F.lit(None).cast("array<double>").alias("least"), "barred"
        )
        tasks = heads.unionByName(rest).repartitionById((last + 1) * stripes, F.col("block") * stripes + F.col("stripe"))
        rows = tasks.sortWithinPartitions("block", "stripe", "place")
        return materialize(rows.mapInArrow(_searcher(k, balls, open_more), _RESULT))

    few = n_queries * len(balls.block) <= ONE_STEP
    homes = asking.select("block", F.size("ids"), "vectors").mapInArrow(
        _home_blocks(balls, None if few else max(2 * k, HOME_ROWS)), "block int, item_block int, place int"
    )
    results = first = score(
        homes.withColumn("stripe", F.lit(0)), asking.withColumn("least", F.lit(None).cast("array<double>")), not few
    )
    if not few:
        opened = first.select("block", F.posexplode("more").alias("at", "item_block")).select(
            "block", F.floor(F.col("at") / stripe).cast("int").alias("stripe"), "item_block", (F.col("at") + 1).alias("place")
        )
        stripes = -(-len(balls.block) // stripe)
        results = first.unionByName(score(opened, asking.join(first.select("block", "least"), "block"), False, stripes))
    found = results.select(F.inline(F.arrays_zip("query_ids", "item_ids", "scores"))).toDF("query_id", "item_id", "score")
    pairs = results.agg(
        F.count_distinct("block").alias("query_blocks"),
        F.lit(len(balls.block)).cast("long").alias("item_blocks"),
        F.sum("scored").alias("opened"),
    )
    return TopK(top_k_per_key(found, ["query_id"], [F.desc("score"), F.col("item_id")], k), pairs)


def top_k_products(
    queries: DataFrame | None,
    items: DataFrame,
    k: int,
    excluded: DataFrame | None = None,
    query_rows: int | None = None,
    item_rows: int | None = None,
) -> DataFrame:
    """(query_id, item_id, score, rank): the k items with the largest inner product for every query, ties to the
    lowest item id.

    ``queries(query_id, vector)`` (None: the items ask) and ``items(item_id, vector)`` have unique ids; vectors that are
    null or hold non-finite entries are left out. ``excluded(query_id, item_id)`` pairs never come out: each goes to the
    one block pair it belongs to, so a query with a very long list is spread over all item blocks. ``query_rows``
    and ``item_rows`` set the size of blocks, which otherwise follows the number of rows. Runs jobs.
    """
    return search_blocks(queries, items, k, excluded, query_rows, item_rows).rows
