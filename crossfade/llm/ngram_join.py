"""Exact Jaccard join of documents on word shingles through a token-group matrix.

A document's set holds its distinct shingles; two documents link when ``100 * |A & B| >=
percent * |A | B|``. The steps, each a Spark job over all rows:

1. A count sketch of fixed size over all documents gives every token a commonness, and with the token
   itself as tie-break one global order, rare tokens first. Any order is right; this one keeps tokens
   of shared passages out of the way.
2. Each document becomes its set's size, digest and *probe*: the first n - ceil(t n) + 1 tokens of that
   order. Two sets that link share a token of their probes. Equal sets become one class.
3. Groups of similar classes: the hash range is cut into eight parts, and a class's smallest tokens of two
   parts make a key (one-permutation min-hash), four keys in all. Classes with a key and size band in
   common are compared with one leader, in whole: the class with the commonest tokens, which is the one
   least changed of a family of copies. The components of the links found are the groups. The number of
   comparisons is linear, however large a group of copies is.
4. The token-group matrix holds, for each token and group, the members that have it among the first
   m - ceil(2t / (1 + t) m) + 1 of their m tokens: their range of sizes, and the most tokens that follow in
   one of them. Of two sets that link, the larger one's probe holds one of these tokens of the smaller one,
   and the first token they share leaves enough tokens behind it in both. So a class bounds its overlap with a group by
   what follows each token they share, and only groups whose bound reaches the threshold are opened. Texts
   that are alike but not linked begin with more tokens of their own than that, and do not meet.
5. Members of opened groups are bounded in the same way one by one, and what is left is compared in whole.

Classes in one group are connected already, so they need no further comparison, and any link between two
groups is found in 4 and 5: the components are exact. No step pairs up the members of a group.

Token hashes are 64 bits wide, so a pair could be misjudged only if two of its own tokens collide.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfade.llm.decontaminate import row_key
from crossfade.llm.tables import components, fresh, gives_back, materialize, small_side, without_keys
from crossfade.llm.words import mix, shingle_sets

SKETCH_BITS = 20  # 4 MB of counts, whatever the corpus
_SLICE = 1 << 14
_FANS = 64  # sketches are added in groups of so many, then the sums
_PARTS = np.arange(8, dtype=np.uint64) << np.uint64(61)


def token_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """How many documents have a token of each of 2^20 hash buckets. The size is fixed, so the merged
    counts may pass through the driver and to all executors."""

    @gives_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for tokens in shingle_sets(batch.column(0), width):
                np.add.at(counts, _bucket(tokens), 1)
        slices = [i for i in range(0, len(counts), _SLICE) if counts[i : i + _SLICE].any()]
        fan = np.full(len(slices), TaskContext.get().partitionId() // _FANS)
        yield pa.record_batch(
            {"fan": pa.array(fan, pa.int32()), "slice": pa.array(slices, pa.int32()),
             "counts": pa.array([counts[i : i + _SLICE].tobytes() for i in slices], pa.binary())}
        )

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(_SLICE, np.uint64)
        for part in table.column("counts"):
            total += np.frombuffer(part.as_buffer(), np.uint32)
        total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
        return table.slice(0, 1).set_column(2, "counts", pa.array([total.tobytes()], pa.binary()))

    schema = "fan int, slice int, counts binary"
    # a sketch for each core, however many partitions there are, and no group of more than _FANS of them
    cores = docs.sparkSession.sparkContext.defaultParallelism
    merged = docs.select("text").coalesce(cores).mapInArrow(count, schema)
    for keys in (["fan", "slice"], ["slice"]):
        merged = merged.groupBy(*keys).applyInArrow(merge, schema)
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    for row in merged.collect():  # at most 64 slices of 64 kB
        sketch[row["slice"] : row["slice"] + _SLICE] = np.frombuffer(row["counts"], np.uint32)
    return sketch


def _digest(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _node(digest: bytes | None) -> int | None:
    return digest and int.from_bytes(digest[:8], "little", signed=True)


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _probe(tokens: np.ndarray, sketch: np.ndarray, percent: int) -> np.ndarray:
    """The tokens of which a linked set must hold at least one, in the global order."""
    n = len(tokens)
    keep = n + (-percent * n) // 100 + 1 if n else 0  # n - ceil(percent n / 100) + 1
    common = sketch[_bucket(tokens)]
    # the tokens are sorted, so a stable sort on the count breaks ties by the token
    return tokens[np.argsort(common, kind="stable")[:keep]]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _group_keys(tokens: np.ndarray) -> np.ndarray:
    if not len(tokens):
        return tokens
    least = tokens[np.searchsorted(tokens, _PARTS) % len(tokens)]
    return mix(least[0::2] ^ mix(least[1::2]))


def document_sets(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: row (a number of its own), doc_id, n (set size), node (a digest of the set as a
    number, null if empty), probe and keys (arrays of tokens and of group keys), common (mean log
    commonness of the tokens). Written once; the input is read twice."""
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(token_sketch(docs, width))

    @gives_back
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes, digests, probes, keys, common = [], [], [], [], []
            for tokens in shingle_sets(batch.column(1), width):
                sizes.append(len(tokens))
                digests.append(_digest(tokens))
                probes.append(_probe(tokens, sketch.value, percent))
                keys.append(_group_keys(tokens))
                common.append(float(np.log1p(sketch.value[_bucket(tokens)]).mean()) if len(tokens) else 0.0)
            yield pa.record_batch(
                {
                    "row": np.arange(row, row + batch.num_rows),
                    "doc_id": batch.column(0),
                    "n": pa.array(sizes, pa.int64()),
                    "node": pa.array(map(_node, digests), pa.int64()),
                    "probe": _lists(probes),
                    "keys": _lists(keys),
                    "common": pa.array(common, pa.float64()),
                }
            )
            row += batch.num_rows

    schema = "row long, doc_id long, n long, node long, probe array<bigint>, keys array<bigint>, common double"
    return materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(describe, schema))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the written pairs of classes (a, b) whose whole sets link."""

    @gives_back
    def of_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """An id that stands for several texts brings them all; those of another set go."""
        for batch in batches:
            nodes = np.array([_node(_digest(tokens)) or 0 for tokens in shingle_sets(batch.column(2), width)], np.int64)
            yield batch.filter(pa.array(nodes == batch.column(1).to_numpy(), pa.bool_())).select([0, 2])

    wanted = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    wanted = materialize(wanted)
    wanted = materialize(classes.select("row", "node", "doc_id").join(small_side(wanted), "row"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(wanted), "doc_id")
    texts = texts.select("row", "node", "text").mapInArrow(of_class, "row long, text string")
    texts = materialize(texts)
    if texts.count() > wanted.count():  # rows repeated with one id and text
        texts = materialize(texts.dropDuplicates(["row"]))
    both = pairs.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")

    @gives_back
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy() for i in (0, 1))
            starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])  # a leader's rows mostly follow each other
            leaders = shingle_sets(batch.column(2).take(pa.array(starts)), width)
            kept, starts = [], set(starts.tolist())
            for i, second in enumerate(shingle_sets(batch.column(3), width)):
                if i in starts:
                    first = next(leaders)
                shared = len(np.intersect1d(first, second, assume_unique=True))
                kept.append(100 * shared >= percent * (len(first) + len(second) - shared))
            yield pa.record_batch({"a": a, "b": b}).filter(pa.array(kept, pa.bool_()))

    both = both.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")
    return materialize(both)


def set_classes(sets: DataFrame) -> DataFrame:
    """One row of ``sets`` for each distinct set, that of the smallest doc_id; its row number names the class."""
    usable = sets.where("n > 0 and doc_id is not null")
    copies = usable.groupBy("node").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("copies"))
    copies = materialize(copies.where("copies > 1").select("node", F.col("first.row").alias("kept")))
    return usable.join(small_side(copies), "node", "left").where("kept is null or kept = row").drop("kept")


def links(classes: DataFrame, docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """Links (a, b) between classes, enough of them to connect all that is connected."""
    share = percent / 100
    # groups: compare classes with the leader of each of their keys
    band = F.floor(F.log("n") / -np.log(share)) if percent < 100 else F.col("n")
    first = classes.select("row", "common", band.alias("band"), F.explode(F.array_distinct("keys")).alias("key"))
    leaders = first.groupBy("key", "band").agg(F.max(F.struct("common", "row")).alias("leader"), F.count("*").alias("members"))
    leaders = leaders.where("members > 1").select("key", "band", F.col("leader.row").alias("leader"))
    near = first.join(leaders, ["key", "band"]).where("row <> leader")
    near = materialize(near.select(F.col("leader").alias("a"), F.col("row").alias("b")).distinct())
    found = _verified(near, classes, docs, width, percent)
    grouped = materialize(components(found).select(F.col("node").alias("row"), F.col("component").alias("grp")))
    grouped = classes.join(small_side(grouped), "row", "left").withColumn("grp", F.coalesce("grp", "row"))
    # the matrix, and each class's bound with each other group that holds a class of its size or smaller; 48
    # bits of a token are enough here, since tokens taken for equal can only open a group too many
    tokens = grouped.select("row", "n", "grp", F.posexplode("probe").alias("at", "token"))
    tokens = tokens.withColumn("token", F.col("token").bitwiseAND((1 << 48) - 1))
    short = F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / (100 + percent) - 1e-6) + 1
    matrix = tokens.where(F.col("at") < short).groupBy("token", "grp").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("at")).alias("rest")
    )
    matrix = matrix.select("token", F.col("grp").alias("other"), "low", "high", "rest")
    needed = share / (1 + share) * (F.col("n") + F.greatest(F.col("low").cast("double"), share * F.col("n")))
    bounded = tokens.join(matrix, "token").where(
        (F.col("grp") != F.col("other"))
        & ((F.col("low") < F.col("n")) | ((F.col("low") == F.col("n")) & (F.col("grp") < F.col("other"))))
        & (100 * F.col("high") >= percent * F.col("n"))
        & (F.least(F.col("n") - F.col("at"), "rest") >= needed - 1e-6)
    )
    opened = materialize(bounded.select(F.col("row").alias("a"), "other").distinct())
    groups = materialize(opened.select(F.col("other").alias("grp")).distinct())
    members = grouped.join(small_side(groups), "grp", "left_semi")
    members = members.select(F.col("row").alias("b"), F.col("grp").alias("other"), F.col("n").alias("n_b"), F.col("probe").alias("probe_b"))
    asking = materialize(opened.select(F.col("a").alias("row")).distinct())
    asking = classes.join(small_side(asking), "row", "left_semi")
    asking = asking.select(F.col("row").alias("a"), F.col("n").alias("n_a"), F.col("probe").alias("probe_a")).join(opened, "a")
    common = F.size(F.array_intersect("probe_a", "probe_b"))
    pairs = asking.join(members, "other").where(
        (F.col("n_a") >= F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a"))
        & (common >= 1) & (common >= _least_shared(F.col("n_a"), F.col("n_b"), share) - 1e-6)
    )
    return found.unionByName(_verified(materialize(pairs.select("a", "b")), classes, docs, width, percent))


def _least_shared(n, m, share: float):
    """Sets of sizes n and m that link share at least this many probe tokens: the overlap they need, less
    what can lie beyond the longer probe. In whole numbers, with c(x) for x rounded up: beyond the probe of n there are
    c(share n) - 1 tokens, so at least c(share / (1 + share) (n + m)) - c(share max(n, m)) + 1 are shared, and that is
    no less than the value given here. Callers leave 1e-6 for rounding."""
    return share / (1 + share) * (n + m) - share * F.greatest(n, m)


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    Null or blank text: no shingles, linked with nothing. Fewer words than ``width``: the whole sequence
    is the one shingle. Null doc_id: linked with nothing, component_id null. Rows repeated with the same
    id each give a row. Other columns are ignored.
    """
    sets = document_sets(docs, width, percent)
    classes = set_classes(sets)
    found = components(links(classes, docs, width, percent))
    known = classes.select("row", "node", "doc_id").join(found.withColumnRenamed("node", "row"), "row", "left")
    known = known.withColumn("component", F.coalesce("component", "row"))
    smallest = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = materialize(known.join(smallest, "component").select("node", "component_id"))
    linked = sets.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
    return linked.join(known, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near duplicates, by row: of each group of rows whose texts are linked, one stays, that
    of the smallest doc_id, of equal ids that of the smallest key. Ids only break ties: rows of one id with
    different texts are different documents, and rows without an id come last. Of rows repeated with one
    id and text, one stays. Rows without words are linked with nothing and all stay. Columns as given, whatever
    their names."""
    key, order = row_key(), docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("id"))
    texts = docs.select(key.alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = jaccard_components(texts, width, percent).where("n_shingles > 0")
    parts = materialize(parts.groupBy("doc_id", "component_id").agg(F.count("*").alias("rows")))
    some = materialize(order.distinct())
    groups = parts.withColumnRenamed("doc_id", "key").join(some, "key")
    first = F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first")
    stays = groups.groupBy("component_id").agg(first).select(F.col("first.key").alias("doc_id"), F.lit(True).alias("stays"))
    judged = materialize(parts.join(stays, "doc_id", "left"))
    kept = without_keys(docs, key, materialize(judged.where("stays is null").select("doc_id")))
    twice = materialize(judged.where("stays and rows > 1").select("doc_id"))
    once = without_keys(kept, key, twice)
    name = fresh(docs.columns, "row_key")
    again = kept.withColumn(name, key).join(small_side(twice.toDF(name)), name, "left_semi").dropDuplicates([name]).drop(name)
    return once.unionByName(again)
