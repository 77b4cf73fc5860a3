"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

A text is its lower-cased (A-Z) UTF-8 bytes and one end symbol. A byte is eight binary decisions; each of
the 255 decision nodes has a context tree of its own whose branches are the preceding bytes, nearest
first, down to ``DEPTH`` of them. A tree node estimates its bit by Krichevsky-Trofimov; the weighted
probability of a node is half its own estimate and half the product of its children's, so all depths are
mixed by how well they coded the training bytes. The score of a text is the log probability that the
mixture gives to its symbols after training; divided by the bytes it is the code length per byte.

Training and scoring are Spark jobs. The corpus is read once for counts of (context, byte) grams and of
words, added up map-side. Trees are weighted in groups of grams with the same two nearest bytes; the top
two levels (at most 256 x 255 nodes) are put together on the driver. Texts are scored in a second reading
against a table of the grams that all texts together have most often, at most ``GRAMS_SENT`` rows; the other
grams of each document, each of them rare, are joined with their scores.

The base score (unigram words) uses the frequent words in a table of at most ``WORDS_SENT`` rows; the other
words of each document are joined with their counts.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfade.llm.hashtable import HashTable
from crossfade.llm.tables import fold, materialize
from crossfade.llm.words import LOWER, find_words, text_blocks, word_hashes

DEPTH = 5
GRAMS_SENT = 4_000_000
WORDS_SENT = 1 << 19
EDGE = 0xFF  # never part of UTF-8: stands before a text's first byte and ends it
_MERGE_AT = 3 << 20

_WORD, _GRAM, _DOCS = 0, 1, 2


def grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed (context bytes, symbol) of each symbol in order, end symbols included, and where rows begin."""
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    stream = np.full(len(data) + depth * (rows + 1), EDGE, np.uint8)
    shift = np.repeat(np.arange(1, rows + 1) * depth, sizes)
    stream[np.arange(len(data)) + shift] = LOWER[data]
    packed = np.zeros(len(stream) - depth, np.uint64)
    for i in range(depth + 1):
        packed = (packed << np.uint64(8)) | stream[i : i + len(packed)]
    begins = offsets[:-1] + depth * np.arange(rows)
    inside = np.zeros(len(packed) + 1, np.int64)
    np.add.at(inside, begins, 1)
    np.add.at(inside, begins + sizes + 1, -1)
    return packed[np.cumsum(inside[:-1]) > 0], np.concatenate([[0], np.cumsum(sizes + 1)])


class _Counter:
    """Counts of 64-bit keys, in training texts and in all, merged now and then so that memory follows the
    distinct keys."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, train: bool = True) -> None:
        keys = np.sort(keys)
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        seen = np.diff(heads, append=len(keys))
        self._put(keys[heads], np.stack([seen * train, seen], axis=1))

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > _MERGE_AT and len(self.keys) > 4:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) > 1:
            keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.keys, self.counts = [keys[heads]], [np.add.reduceat(counts, heads, axis=0)]
            self.size = len(heads)
        return (self.keys[0], self.counts[0]) if self.keys else (np.zeros(0, np.uint64), np.zeros((0, 2), np.int64))


def count_corpus(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(kind, key, n, seen): training counts of words and of grams, with n = 0 for grams of other texts only; and
    the number of training texts. ``seen`` counts grams in all texts. ``docs`` has train (boolean) and text. Written
    once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, texts = _Counter(), _Counter(), 0
        for batch in batches:
            train = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            texts += int(train.sum())
            for first, data, offsets in text_blocks(batch.column(1)):
                own = train[first : first + len(offsets) - 1]
                packed, bounds = grams(data, offsets, depth)
                mine = np.repeat(own, np.diff(bounds))
                pairs.add(packed[mine])
                pairs.add(packed[~mine], train=False)
                found = find_words(data, offsets)
                words.add(word_hashes(data, found)[own[found.row]])
        for kind, counter in ((_WORD, words), (_GRAM, pairs)):
            keys, counts = counter.merge()
            for i in range(0, len(keys), 1 << 18):
                part = keys[i : i + (1 << 18)]
                n, seen = counts[i : i + (1 << 18)].astype(np.int64).T
                yield pa.record_batch({"kind": np.full(len(part), kind, np.int32), "key": part.view(np.int64), "n": n, "seen": seen})
        yield pa.record_batch({"kind": np.array([_DOCS], np.int32), "key": np.array([0]), "n": np.array([texts]), "seen": np.array([texts])})

    counted = docs.select("train", "text").mapInArrow(count, "kind int, key long, n long, seen long")
    return materialize(counted.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")))


def _ln_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0: Stirling's series at x + 8."""
    below = np.zeros_like(x)
    for i in range(8):
        below += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) - below


def ln_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    half = _ln_gamma(np.array([0.5]))[0]
    return _ln_gamma(zeros + 0.5) + _ln_gamma(ones + 0.5) - 2 * half - _ln_gamma(zeros + ones + 1.0)


class _Level:
    """The nodes of one depth: keys (context bytes, then decision node), counts, ln probabilities, the
    weight of the node's own estimate, and the place of each child's parent among them."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None) -> None:
        self.keys, self.zeros, self.ones = keys, zeros, ones
        kt = ln_kt(zeros, ones)
        self.ln = kt if children is None else np.logaddexp(kt, children) - np.log(2)
        self.weight = np.ones(len(keys)) if children is None else np.exp(kt - np.log(2) - self.ln)
        self.one = (ones + 0.5) / (zeros + ones + 1)


def _levels(packed: np.ndarray, counts: np.ndarray, depth: int, top: int):
    """Levels from ``depth`` up to ``top`` of the trees of these grams; for each gram its eight leaf nodes;
    and the parents between neighbouring levels."""
    symbol = (packed & np.uint64(0xFF)).astype(np.int64)
    bits = np.arange(8)
    node = (1 << bits)[None, :] | (symbol[:, None] >> (8 - bits)[None, :])
    bit = (symbol[:, None] >> (7 - bits)[None, :]) & 1
    keys = ((packed >> np.uint64(8)) << np.uint64(8))[:, None] | node.astype(np.uint64)
    keys, leaf = np.unique(keys, return_inverse=True)
    leaf = leaf.reshape(node.shape)
    ones = np.bincount(leaf.ravel(), (counts[:, None] * bit).ravel(), len(keys))
    zeros = np.bincount(leaf.ravel(), (counts[:, None] * (1 - bit)).ravel(), len(keys))
    levels, parents = [_Level(keys, zeros, ones, None)], []
    for d in range(depth - 1, top - 1, -1):
        below = levels[-1]
        keys, parent = np.unique(below.keys & np.uint64((1 << 8 * (d + 1)) - 1), return_inverse=True)
        zeros, ones, children = (np.bincount(parent, x, len(keys)) for x in (below.zeros, below.ones, below.ln))
        levels.append(_Level(keys, zeros, ones, children))
        parents.append(parent)
    return levels, parents, leaf, bit


def fit(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, seen, score): log10 probability of the symbol of each counted gram in its context. Written once."""
    if depth < 2:
        raise ValueError("depth must be 2 or more")
    spark = counted.sparkSession
    rows = counted.where(F.col("kind") == _GRAM).select("key", "n", "seen", F.shiftright("key", 8).bitwiseAND(0xFFFF).alias("near"))

    def weigh(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        packed = table.column("key").to_numpy().view(np.uint64)
        levels, _, _, _ = _levels(packed, table.column("n").to_numpy(), depth, 2)
        last = levels[-1]
        return pa.table({"key": last.keys.view(np.int64), "zeros": last.zeros, "ones": last.ones, "ln": last.ln})

    second = rows.drop("seen").groupBy("near").applyInArrow(weigh, "key long, zeros double, ones double, ln double")
    first = second.groupBy(F.col("key").bitwiseAND(0xFFFF).alias("key")).agg(F.sum("zeros"), F.sum("ones"), F.sum("ln"))
    first = first.orderBy("key").toPandas().to_numpy(np.float64).reshape(-1, 4)  # at most 256 x 255 rows
    keys = first[:, 0].astype(np.uint64)
    level1 = _Level(keys, first[:, 1], first[:, 2], first[:, 3])
    root, parent = np.unique(keys & np.uint64(0xFF), return_inverse=True)
    level0 = _Level(root, *(np.bincount(parent, x, len(root)) for x in (level1.zeros, level1.ones, level1.ln)))
    top = spark.sparkContext.broadcast((level1.keys, level1.weight, level1.one, level0.keys, level0.weight, level0.one))

    def predict(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        packed = table.column("key").to_numpy().view(np.uint64)
        levels, parents, leaf, bit = _levels(packed, table.column("n").to_numpy(), depth, 2)
        one, at = levels[0].one, np.arange(len(levels[0].keys))
        for parent, level in zip(parents, levels[1:], strict=True):
            at = parent[at]
            one = level.weight[at] * level.one[at] + (1 - level.weight[at]) * one
        keys1, weight1, one1, keys0, weight0, one0 = top.value
        for mask, keys, weight, own in ((0xFFFF, keys1, weight1, one1), (0xFF, keys0, weight0, one0)):
            at = np.searchsorted(keys, levels[0].keys & np.uint64(mask))
            one = weight[at] * own[at] + (1 - weight[at]) * one
        chance = np.where(bit == 1, one[leaf], 1 - one[leaf])
        return pa.table({"key": table.column("key"), "seen": table.column("seen"), "score": np.log10(chance).sum(axis=1)})

    return materialize(rows.groupBy("near").applyInArrow(predict, "key long, seen long, score double"))


def _frequent(rows: DataFrame, most: int) -> tuple[int, DataFrame]:
    """The least ``seen`` (a power of two; 1 if all fit) that at most so many rows reach, and those rows."""
    sizes = rows.groupBy(F.floor(F.log2("seen")).alias("size")).count().collect()  # at most 63 rows
    least, total = 62, 0
    for row in sorted(sizes, key=lambda r: -r["size"]):
        total += row["count"]
        if total > most:
            break
        least = row["size"]
    else:
        least = 0
    return 1 << least, rows.where(F.col("seen") >= (1 << least))


def score(docs: DataFrame, train, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, held_out (not trained on), n_tokens, n_known, train_tokens, base_score,
    score. ``train`` is a boolean column expression; where it is null the row is held out.

    Null text: empty, scored by its end symbol. Nothing to train on: all words unknown, all bits even.
    Repeated ids and rows each give a row. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(train, F.lit(False)).alias("train"), "text")
    counted = count_corpus(rows, depth)
    words = counted.where((F.col("kind") == _WORD) & (F.col("n") > 0)).select("key", "n", "seen")
    texts = counted.where(F.col("kind") == _DOCS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + texts, distinct + (texts > 0)
    rest = 0.5 * (distinct + 1)
    value = lambda c: np.log10((c + 0.5) / (total + rest))
    least, frequent = _frequent(words, WORDS_SENT)
    frequent = frequent.toArrow()
    tables = [HashTable(frequent.column("key").to_numpy().view(np.uint64), value(frequent.column("n").to_numpy()))]
    model = fit(counted, depth)
    least_gram, frequent = _frequent(model, GRAMS_SENT)
    frequent = frequent.select("key", "score").toArrow()
    tables.append(HashTable(frequent.column("key").to_numpy().view(np.uint64), frequent.column("score").to_numpy()))
    sent = spark.sparkContext.broadcast(tables)
    end_score, end_known = float(value(texts)), int(texts > 0)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        common, common_grams = sent.value
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(2)):
                size = len(offsets) - 1
                found = find_words(data, offsets)
                hashes = word_hashes(data, found)
                scores, known = common.find(hashes)
                rare = ~known
                packed, bounds = grams(data, offsets, depth)
                values, there = common_grams.find(packed)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number + np.arange(size)),
                        batch.column(0).slice(first, size),
                        batch.column(1).slice(first, size),
                        pa.array(np.bincount(found.row, minlength=size) + 1),
                        pa.array(np.bincount(found.row[known], minlength=size) + end_known),
                        pa.array(np.bincount(found.row, scores, size) + end_score),
                        pa.array(np.add.reduceat(values, bounds[:-1])),
                        _lists(hashes[rare], np.bincount(found.row[rare], minlength=size)),
                        _lists(packed[~there], np.add.reduceat((~there).astype(np.int64), bounds[:-1])),
                    ],
                    ["row", "doc_id", "train", "n_tokens", "n_known", "base_score", "score", "rare", "grams"],
                )
                number += size

    schema = """row long, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double,
    rare array<bigint>, grams array<bigint>"""
    scored = materialize(rows.mapInArrow(look_up, schema))
    tail = scored.where(F.size("rare") > 0).select("row", F.explode("rare").alias("key")).groupBy("row", "key").count()
    tail = tail.join(words.where(F.col("seen") < least).drop("seen"), "key", "left").groupBy("row").agg(
        F.sum(F.col("count") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / (total + rest))).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("count")).otherwise(0)).alias("known"),
    )
    full = scored.join(tail, "row", "left")
    if least_gram > 1:  # no key is hot here: all texts together have each of these grams fewer than least_gram times
        parts = scored.where(F.size("grams") > 0).select("row", F.explode("grams").alias("key"))
        parts = parts.join(model.where(F.col("seen") < least_gram).select("key", F.col("score").alias("each")), "key")
        full = full.join(parts.groupBy("row").agg(F.sum("each").alias("sum")), "row", "left")
        full = full.withColumn("score", F.col("score") + F.coalesce("sum", F.lit(0.0)))
    return full.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))


def document_scores(docs: DataFrame, held_out: int = 1) -> DataFrame:
    """Scores of all documents by a model of those whose crc32 of the id modulo 5 is not ``held_out``. A row
    without an id is trained on."""
    return score(docs, F.coalesce(~fold("doc_id", held_out), F.lit(True)))
