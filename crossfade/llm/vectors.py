"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest of ``PIVOTS`` reference points, in order of nearness. These are
vectors of a sample of ``SAMPLE``, no two of them with a cosine of the first of ``APART`` or more; where the sample has
too few of these, as when all vectors lie in a narrow cone, of the next, and random directions fill up the rest. So a
group of near copies, however large, holds one of them at most: with several, all nearly as near, chance would choose
among them and copies would not meet. Vectors that all lie closer together than the last of ``APART`` share most of their
lists and are compared with one another in full. The inverted lists go from every three of those pivots to the vectors that have all
three among their nearest: two vectors meet in a list if and only if they share at
least three pivots, and a pair that meets in several is looked at in the first list only. Every pair that
meets is verified by its cosine in double precision, so a link is never wrong; near vectors share fewer than
three pivots very rarely (the tests measure recall against brute force).

Equal vectors are one class before all this, however many they are. Lists are worked off by products of ``TILE`` rows
with at most ``BLOCK``, so memory follows these numbers and the vectors' length, not the lists; a long list is cut into blocks of ``BLOCK`` rows, and each pair of blocks is a task's work of its own, so no list
is capped and none has to fit a task. A task hands on sums and a spanning forest of its links, not the pairs.
"""

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfade.llm.tables import components, materialize, small_side

PIVOTS = 64
SAMPLE = 4096  # vectors that the pivots are taken from
APART = (0.7, 0.8, 0.9)  # cosines that two pivots stay below, the first that gives enough
NEAREST = 6
SHARED = 3
BLOCK = 2048
TILE = 128
_LINKS_HELD = 1 << 20  # links between folds into a forest
_CHOICES = np.array(list(combinations(range(NEAREST), SHARED)))


def _kind(vectors: DataFrame) -> type:
    """How components are kept: as floats if they are."""
    return np.float32 if vectors.schema["embedding"].dataType.elementType == T.FloatType() else np.float64


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, node) of all rows, and (node, label, count, low, vector as bytes) of each class of equal
    vectors under one label. Vectors that cannot link have no node."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, raws = [], []
            labels, lists = batch.column(1).to_pylist(), batch.column(2)
            offsets, values = lists.offsets.to_numpy(), lists.values
            holes = values.is_null().to_numpy(zero_copy_only=False)
            values = values.fill_null(0).to_numpy()
            present = lists.is_valid().to_numpy(zero_copy_only=False)
            for i, label in enumerate(labels):
                a, b = offsets[i], offsets[i + 1]
                vector = values[a:b] + values.dtype.type(0)  # -0 is 0
                usable = label is not None and present[i] and vector.any() and np.isfinite(vector).all()
                if not usable or holes[a:b].any():
                    nodes.append(None)
                    raws.append(None)
                else:
                    raws.append(vector.tobytes())
                    digest = hashlib.blake2b(raws[-1], digest_size=8, key=str(label).encode()).digest()
                    nodes.append(int.from_bytes(digest, "little", signed=True))
            yield pa.record_batch(
                {"vec_id": batch.column(0), "node": pa.array(nodes, pa.int64()), "label": batch.column(1), "raw": pa.array(raws, pa.binary())}
            )

    kind = "array<float>" if _kind(vectors) is np.float32 else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast(kind))
    rows = rows.mapInArrow(describe, "vec_id long, node long, label long, raw binary")
    rows = materialize(rows)
    classes = rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.count("*").alias("count"), F.min("vec_id").alias("low"), F.first("raw").alias("raw")
    )
    return rows.select("vec_id", "node"), materialize(classes)


def _unit(raw: pa.Array, kind) -> np.ndarray:
    """Rows of equal length, kept as floats or doubles, as unit vectors of doubles."""
    rows = np.frombuffer(b"".join(raw.to_pylist()), kind).reshape(len(raw), -1).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square overflows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _pivots(rows: np.ndarray) -> np.ndarray:
    """Unit vectors from the rows, in their order, that lie apart, filled up with random directions."""
    chosen, near = [], np.full(len(rows), -1.0)
    for apart in APART:
        for i in range(len(rows)):
            if near[i] < apart and len(chosen) < PIVOTS:
                chosen.append(i)
                near = np.maximum(near, rows @ rows[i])
    others = np.random.default_rng(rows.shape[1]).standard_normal((PIVOTS - len(chosen), rows.shape[1]))
    return np.concatenate([rows[chosen], others / np.linalg.norm(others, axis=1, keepdims=True)])


def _index(classes: DataFrame, kind: type) -> DataFrame:
    """(label, size, trio, node, count, nearest, raw): the inverted lists. ``nearest`` and ``trio`` are sets of pivots as
    bits; lists of different vector lengths are different lists."""
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("raw").collect()  # SAMPLE rows
    by_size: dict[int, list[bytes]] = {}
    for row in sample:
        by_size.setdefault(len(row["raw"]), []).append(bytes(row["raw"]))
    pivots = {size: _pivots(_unit(pa.array(raws, pa.binary()), kind)) for size, raws in by_size.items()}
    sent = classes.sparkSession.sparkContext.broadcast(pivots)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column("raw").to_pylist()])
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                points = sent.value.get(int(size))
                if points is None:  # too rare a length for the sample
                    points = _pivots(np.zeros((0, size // np.dtype(kind).itemsize)))
                for lo in range(0, part.num_rows, 1000):
                    rows = part.slice(lo, 1000)
                    order = np.argsort(-(_unit(rows.column("raw"), kind) @ points.T), axis=1, kind="stable")[:, :NEAREST]
                    bits = np.uint64(1) << order.astype(np.uint64)
                    trios = np.bitwise_or.reduce(bits[:, _CHOICES], axis=2)
                    again = pa.array(np.repeat(np.arange(rows.num_rows), trios.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("label").take(again),
                            pa.array(np.full(len(again), size, np.int32)),
                            pa.array(trios.ravel().view(np.int64)),
                            rows.column("node").take(again),
                            rows.column("count").take(again),
                            pa.array(np.repeat(np.bitwise_or.reduce(bits, axis=1), trios.shape[1]).view(np.int64)),
                            rows.column("raw").take(again),
                        ],
                        ["label", "size", "trio", "node", "count", "nearest", "raw"],
                    )

    schema = "label long, size int, trio long, node long, count long, nearest long, raw binary"
    return classes.select("label", "node", "count", "raw").mapInArrow(describe, schema)


def _first_trio(common: np.ndarray) -> np.ndarray:
    """The lowest three of the set bits."""
    rest, out = common.copy(), np.zeros_like(common)
    for _ in range(SHARED):
        bit = rest & (~rest + np.uint64(1))
        out |= bit
        rest ^= bit
    return out


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest row that each of n rows reaches by the links a - b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _near_pairs(units: np.ndarray, ends: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs a < b of rows of one list whose product reaches the threshold, a tile of products at a time. Rows of a list
    follow one another; ``ends`` has the end of each row's list."""
    for lo in range(0, len(units), TILE):
        hi = min(lo + TILE, len(units))
        for left in range(lo, int(ends[hi - 1]), BLOCK):
            right = min(left + BLOCK, int(ends[hi - 1]))
            a, b = np.nonzero(units[lo:hi] @ units[left:right].T >= threshold)
            a, b = a + lo, b + left
            mine = (a < b) & (b < ends[a])
            yield a[mine], b[mine]


def _links(lists: DataFrame, threshold: float, kind: type) -> DataFrame:
    """(node, links, root): what the links verified in one portion of the lists add up to for a node."""
    keys = ["label", "size", "trio", "left", "right"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            open_ = _last_list(held, keys)
            if open_:
                yield from portion(held.slice(0, open_).combine_chunks())
                held = held.slice(open_)
        if held is not None and held.num_rows:
            yield from portion(held.combine_chunks())

    def fold(root: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The forest with these links added to the ones it stands for."""
        a = np.concatenate([np.arange(len(root)), *(a for a, _ in found)])
        return _forest(a, np.concatenate([root, *(b for _, b in found)]), len(root))

    def portion(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        n = rows.num_rows
        columns = {name: rows.column(name).to_numpy() for name in [*keys, "own", "node", "count"]}
        trio, nearest = (rows.column(name).to_numpy().view(np.uint64) for name in ("trio", "nearest"))
        new = np.zeros(n, bool)
        new[0] = True
        for name in keys:
            new[1:] |= columns[name][1:] != columns[name][:-1]
        starts = np.flatnonzero(new)
        raw = rows.column("raw").combine_chunks()
        ends = np.repeat(np.append(starts[1:], n), np.diff(starts, append=n))
        node, place = np.unique(columns["node"], return_inverse=True)
        links, root, found, waiting = np.zeros(n, np.int64), np.arange(len(node)), [], 0
        for size in np.unique(columns["size"]):
            at = np.flatnonzero(columns["size"] == size)  # whole lists
            units = _unit(raw.take(pa.array(at)), kind)
            for a, b in _near_pairs(units, np.searchsorted(at, ends[at]), threshold):
                a, b = at[a], at[b]
                # two blocks of a long list: only pairs across them; one block: all pairs
                mine = (columns["left"][a] == columns["right"][a]) | (columns["own"][a] != columns["own"][b])
                mine &= _first_trio(nearest[a] & nearest[b]) == trio[a]
                a, b = a[mine], b[mine]
                np.add.at(links, a, columns["count"][b])
                np.add.at(links, b, columns["count"][a])
                found.append((place[a], place[b]))
                waiting += len(a)
                if waiting >= _LINKS_HELD:
                    root, found, waiting = fold(root, found), [], 0
        root = fold(root, found)
        total = np.bincount(place, links, len(node)).astype(np.int64)
        yield pa.record_batch({"node": node, "links": total, "root": node[root]}).filter(pa.array(total > 0))

    lists = lists.repartition(*keys).sortWithinPartitions(*keys)
    return lists.mapInArrow(verify, "node long, links long, root long")


def _last_list(rows: pa.Table, keys: list[str]) -> int:
    """Where the last list begins; what follows it may still lack rows."""
    same = np.ones(rows.num_rows, bool)
    for name in keys:
        column = rows.column(name).to_numpy()
        same &= column == column[-1]
    other = np.flatnonzero(~same)
    return int(other[-1]) + 1 if len(other) else 0


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null, their lengths equal, and their cosine is at least
    ``threshold``. Null, empty and zero vectors, and those with a null, NaN or infinite component, link with
    nothing. Equal rows are linked with each other, repeated ids included; rows without an id count as links,
    their component_id is the smallest id they reach. Other columns are ignored.
    """
    rows, classes = _classes(vectors)
    lists = _index(classes, _kind(vectors))
    long = lists.groupBy("label", "size", "trio").count().where(F.col("count") > BLOCK)
    long = materialize(long.select("label", "size", "trio", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    lists = lists.join(small_side(long), ["label", "size", "trio"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    lists = lists.withColumn("own", own).withColumn("other", other)
    lists = lists.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).drop("other", "blocks")
    links = materialize(_links(lists, threshold, _kind(vectors)))
    sums = links.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.join(sums, "node", "left").join(joined, "node", "left").select(
        "node", "low", (F.col("count") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component")
    )
    least = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = materialize(known.join(least, "component").select("node", "n_links", "component_id"))
    return rows.join(known, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
