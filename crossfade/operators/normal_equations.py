"""The iterations of implicit-feedback ALS over packed blocks of users and items.

Each user (and item) solves ``(Y'Y + Y'CY + regularization * n * I) x = Y'p`` over the factors Y of the other side, n
being its positive ratings, C its ratings times ``alpha`` and p 1 + C where a rating is positive, as in MLlib. MLlib adds
a rank x rank product for each rating and decomposes a rank x rank matrix for each user and item. Most of them have fewer
ratings than the rank; such a row is solved in the space of its own ratings (Woodbury's identity) over the
eigenvectors of Y'Y, which all rows share. That is exact, not an approximation.

A side is cut into blocks by id. A block is packed once: its ratings sorted by row, rows by their number of ratings, and
for each block of the other side the rows that it asks for. In each half of an iteration a block sends its factors to the
blocks that need them, every factor once to a block, beside its part of Y'Y.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfade.session import shared_dir
from crossfade.sources import manifest

BLOCK_RATINGS = 1 << 22  # most ratings of a block on average; there is a block a core, or a multiple of that
_ENTRIES = 1 << 17  # factor entries that a task gathers at a time
_SENT_BYTES = 1 << 30  # most bytes of factors that a task sends in one batch, unless one block needs more



def _schema(*binaries: str) -> pa.Schema:
    return pa.schema([("block", pa.int32()), ("sender", pa.int32()), *((name, pa.binary()) for name in binaries)])


# what a block is made of, and what it receives: a row of the first kind has no sender, one of the second no links
_LINKED = ("ids", "sizes", "places", "counts", "links", "weights")
_LINKS = "block int, sender int, " + ", ".join(f"{name} binary" for name in (*_LINKED, "factors", "gram"))
_LINKS_ARROW = _schema(*_LINKED, "factors", "gram")
_STATE = "block int, sender int, ids binary, sizes binary, places binary, factors binary"
_STATE_ARROW = _schema("ids", "sizes", "places", "factors")


def _row(schema: pa.Schema, *values) -> pa.RecordBatch:
    plain = [v.tobytes() if isinstance(v, np.ndarray) else v for v in values]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(plain, schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows with their binary columns as buffers, not copied."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {
                name: column[i].as_buffer() if pa.types.is_binary(column.type) and column[i].is_valid else column[i].as_py()
                for name, column in zip(batch.schema.names, batch.columns)
            }


def _pack(blocks: int):
    """One block from its ratings (own id, other id, weight)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches if batch.num_rows]
        if not parts:
            return
        own, other, weight = map(np.concatenate, zip(*parts))
        ids, row, counts = np.unique(own, return_inverse=True, return_counts=True)
        order = np.lexsort((ids, counts))
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(len(ids))
        # factors arrive by the block that sends them, then by id
        others = np.unique(other)
        arrival = np.empty(len(others), np.int32)
        arrival[np.lexsort((others, others % blocks))] = np.arange(len(others))
        link = arrival[np.searchsorted(others, other)]
        at = np.lexsort((weight, link, place[row]))
        # and leave in the same order
        asked = np.unique((other % blocks).astype(np.int64) * len(ids) + row)
        sizes = np.bincount(asked // len(ids), minlength=blocks)
        yield _row(
            _LINKS_ARROW, int(own[0] % blocks), None, ids[order].astype(np.int32), sizes.astype(np.int64),
            place[asked % len(ids)], counts[order].astype(np.int64), link[at], weight[at].astype(np.float32), None, None,
        )

    return pack


def _start(rank: int):
    def start(block: pa.Table, factors: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.Table.from_batches([], _STATE_ARROW)
        (row,) = _rows(block.to_batches())
        ids, given = np.frombuffer(row["ids"], np.int32), factors.column("id").to_numpy()
        values = factors.column("features").combine_chunks().flatten().to_numpy().reshape(-1, rank)
        order = np.argsort(given)
        mine = values[order[np.searchsorted(given[order], ids)]].astype(np.float32)
        kept = [np.frombuffer(row[name], np.uint8) for name in ("ids", "sizes", "places")]
        return pa.Table.from_batches([_row(_STATE_ARROW, row["block"], None, *kept, mine)])

    return start


def _gram(factors: np.ndarray) -> np.ndarray:
    total = np.zeros((factors.shape[1], factors.shape[1]))
    for start in range(0, len(factors), 1 << 14):
        some = factors[start : start + (1 << 14)].astype(np.float64)
        total += some.T @ some
    return total


def _send(rank: int):
    """The factors each block of the other side needs, and this block's part of Y'Y."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            factors = np.frombuffer(row["factors"], np.float32).reshape(-1, rank)
            places, gram = np.frombuffer(row["places"], np.int32), _gram(factors).tobytes()
            first = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], np.int64))])
            start = 0
            while start < len(first) - 1:
                most = first[start] + _SENT_BYTES // (4 * rank)
                stop = max(start + 1, int(np.searchsorted(first, most, "right")) - 1)
                # the rows of all these blocks in one buffer, cut by offsets
                sent = factors[places[first[start] : first[stop]]]
                offsets = ((first[start : stop + 1] - first[start]) * 4 * rank).astype(np.int32)
                n = stop - start
                binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(sent)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(start, stop), pa.int32()), pa.array(np.full(n, row["block"]), pa.int32())]
                    + [pa.nulls(n, pa.binary())] * len(_LINKED) + [binary, pa.array([gram] * n, pa.binary())],
                    schema=_LINKS_ARROW,
                )
                start = stop

    return send


def solve_rows(
    factors: np.ndarray, gram: np.ndarray, counts: np.ndarray, links: np.ndarray, weights: np.ndarray, alpha: float, regularization: float
) -> np.ndarray:
    """The factors of rows sorted by ``counts``, whose ratings follow each other in ``links`` (rows of ``factors``) and
    ``weights``. Rows without a positive rating get zeros."""
    rank = factors.shape[1]
    solved = np.zeros((len(counts), rank), np.float32)
    values, basis = np.linalg.eigh(gram)
    values = np.maximum(values, 0.0)
    first = np.concatenate([[0], np.cumsum(counts)])
    row = 0
    while row < len(counts):
        n = int(counts[row])
        same = int(np.searchsorted(counts, n, "right"))
        rows = min(same - row, max(1, _ENTRIES // (n * rank)))
        here = slice(int(first[row]), int(first[row + rows]))
        link, weight = links[here].reshape(rows, n), weights[here].reshape(rows, n).astype(np.float64)
        extra = alpha * np.abs(weight)
        wanted = np.where(weight > 0, 1.0 + extra, 0.0)
        positive = np.count_nonzero(weight > 0, axis=1)
        ridge = np.where(positive > 0, regularization * positive, 1.0)  # without a positive rating the answer is zero
        if n < rank and regularization > 0:
            scale = 1.0 / np.sqrt(values + ridge[:, None])
            own = (factors[link.ravel()].astype(np.float64) @ basis).reshape(rows, n, rank) * scale[:, None, :]
            inner = extra[:, :, None] * (own @ own.transpose(0, 2, 1)) + np.eye(n)
            part = np.linalg.solve(inner, wanted[:, :, None])
            found = ((part.transpose(0, 2, 1) @ own)[:, 0] * scale) @ basis.T
        else:
            left = gram + ridge[:, None, None] * np.eye(rank)
            right = np.zeros((rows, rank, 1))
            step = max(1, _ENTRIES // rank)
            for start in range(0, n, step):  # a very long row a part at a time
                some = slice(start, start + step)
                own = factors[link[:, some].ravel()].astype(np.float64).reshape(rows, -1, rank)
                left = left + (own * extra[:, some, None]).transpose(0, 2, 1) @ own
                right += own.transpose(0, 2, 1) @ wanted[:, some, None]
            found = np.linalg.solve(left, right)[:, :, 0]
        solved[row : row + rows] = np.where(positive[:, None] > 0, found, 0.0)
        row += rows
    return solved


def _solve(rank: int, alpha: float, regularization: float):
    """A block's factors from its ratings (the row without a sender) and the factors sent to it."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sent = None, []
        for row in _rows(batches):
            if row["sender"] is None:
                block = row
            else:
                sent.append((row["sender"], np.frombuffer(row["factors"], np.float32), np.frombuffer(row["gram"], np.float64)))
            del row
        if block is None:
            return
        order = sorted(range(len(sent)), key=lambda i: sent[i][0])
        first, place = {}, 0
        for i in order:
            first[i], place = place, place + len(sent[i][1])
        gram = np.sum([sent[i][2] for i in order], axis=0).reshape(rank, rank)
        factors = np.empty(place, np.float32)
        while sent:  # what has been copied is let go
            i = len(sent) - 1
            _, values, _ = sent.pop()
            factors[first[i] : first[i] + len(values)] = values
            del values
        factors = factors.reshape(-1, rank)
        counts, links = np.frombuffer(block["counts"], np.int64), np.frombuffer(block["links"], np.int32)
        weights = np.frombuffer(block["weights"], np.float32)
        solved = solve_rows(factors, gram, counts, links, weights, alpha, regularization)
        kept = [np.frombuffer(block[name], np.uint8) for name in ("ids", "sizes", "places")]
        yield _row(_STATE_ARROW, block["block"], None, *kept, solved)

    return solve


def _unpack(rank: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, factors = np.frombuffer(row["ids"], np.int32), np.frombuffer(row["factors"], np.float32)
            for start in range(0, len(ids), 1 << 14):
                some = pa.array(factors[start * rank : (start + (1 << 14)) * rank])
                mine = ids[start : start + (1 << 14)]
                lists = pa.ListArray.from_arrays(np.arange(0, len(some) + 1, rank, dtype=np.int32), some)
                yield pa.RecordBatch.from_arrays([pa.array(mine), lists], names=["id", "features"])

    return unpack


def iterate(
    ratings: DataFrame, start: DataFrame, rank: int, iterations: int, alpha: float, regularization: float, blocks: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors), each (id, features), after ``iterations`` >= 1 from the user factors ``start``.

    ``ratings(user_idx int, item_idx int, weight float)`` is a written table. Runs a job for each iteration; what it
    wrote is removed when the next one has ended.
    """
    spark = ratings.sparkSession
    root = f"{shared_dir(spark)}/crossfade/{uuid.uuid4().hex}"
    if blocks is None:
        cores = spark.sparkContext.defaultParallelism
        blocks = cores * max(1, -(-ratings.count() // (cores * BLOCK_RATINGS)))

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    def packed(own: str, other: str) -> DataFrame:
        dealt = ratings.select(own, other, "weight").repartitionById(blocks, F.pmod(own, F.lit(blocks)))
        return written(dealt.mapInArrow(_pack(blocks), _LINKS), f"{own}-links")

    def half(state: DataFrame, links: DataFrame) -> DataFrame:
        rows = state.mapInArrow(_send(rank), _LINKS).union(links).repartitionById(blocks, "block")
        return rows.mapInArrow(_solve(rank, alpha, regularization), _STATE)

    of_users, of_items = packed("user_idx", "item_idx"), packed("item_idx", "user_idx")
    first = start.withColumn("block", F.pmod("id", F.lit(blocks)))
    users = of_users.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(_start(rank), _STATE)
    users = written(users, "users-0")
    for i in range(1, iterations + 1):
        items = half(users, of_items)
        if i == iterations:
            items = written(items, "items")
        users = written(half(items, of_users), f"users-{i}")
        manifest.remove(spark, f"{root}/users-{i - 1}")
    for name in ("user_idx-links", "item_idx-links"):
        manifest.remove(spark, f"{root}/{name}")
    users, items = (df.mapInArrow(_unpack(rank), "id int, features array<float>") for df in (users, items))
    return users, items
