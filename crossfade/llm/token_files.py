"""Token ids of documents in ORC files.

Documents are dealt out by ranges of doc_id and sorted, so that the files hold them in ascending order; each
row is a document with its ids as an integer list, which ORC writes run-length encoded in stripes, with row
indexes, minima and maxima and a Bloom filter on doc_id. A reader takes stripes side by side, and a lookup
of one id skips the stripes that cannot hold it. A second, narrow table in the same format gives the start
of each document in the stream of all ids.

Encoding uses the tokenizers library. The byte-level vocabulary's own splitting rule never joins what stands
before and after a single space, on either side of a single line end, or a letter and the mark that follows;
a text is therefore the concatenation of its runs between such cuts, and each distinct run of a worker is
encoded once. The tokenizer's file is a parameter; the workers read it from their own disks.
"""

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crossfade.llm.hashtable import HashTable
from crossfade.llm.words import hash_spans, hash_sums, ragged, text_blocks
from crossfade.session import shared_dir

END_ID = 0
RUNS_KEPT = 1_200_000  # distinct runs that a worker remembers before it starts anew

ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(64 << 20),
}


class _Runs:
    """Ids of the runs already seen: one long array, and a table from a run's hash to its place there."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids whose piece begins with a space
        for piece, number in vocabulary.items():
            self.opens[number] = piece.startswith("Ġ")
        self.special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.old = self.new = HashTable(np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.old_keys, self.new_keys = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.ids, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def look_up(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of these distinct runs of the block's bytes."""
        if len(self.sizes) > RUNS_KEPT:
            self.clear()
        place, known = self.old.find(keys)
        recent, also = self.new.find(keys)
        place, known = np.where(also, recent, place), known | also
        missing = np.flatnonzero(~known)
        if len(missing):
            missing = missing[np.argsort(~self._plain(data, start[missing], end[missing]), kind="stable")]
            place[missing] = len(self.sizes) + np.arange(len(missing))
            sizes, ids = self._encode(data, start[missing], end[missing])
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, ids])
            self.new_keys = np.concatenate([self.new_keys, keys[missing]])
            if len(self.new_keys) > 50_000 + len(self.old_keys) // 4:
                self.old_keys = np.concatenate([self.old_keys, self.new_keys])
                self.old = HashTable(self.old_keys, np.arange(len(self.old_keys)))
                self.new_keys = self.new_keys[:0]
            self.new = HashTable(self.new_keys, len(self.old_keys) + np.arange(len(self.new_keys)))
        return place

    @staticmethod
    def _plain(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Runs of a space and then only characters that are no white space and open no special token."""
        odd = ~((data > 0x20) & (data < 0x7F) & (data != ord("<")))
        letters = np.flatnonzero(_ends_letter(data))
        odd[letters] = odd[letters - 1] = False
        odd = np.concatenate([[0], np.cumsum(odd)])
        return (data[start] == 0x20) & (end - start > 1) & (odd[end] == odd[start + 1])

    def _encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of runs. Plain ones, which come first, are encoded many at a time and told apart by
        the pieces that open with a space."""
        plain = int(self._plain(data, start, end).sum())
        sizes, ids = [], []
        for lo in range(0, plain, 2000):
            hi = min(lo + 2000, plain)
            text = data[ragged(start[lo:hi], end[lo:hi] - start[lo:hi])].tobytes().decode()
            found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
            heads = np.flatnonzero(self.opens[found])
            if len(heads) != hi - lo:
                raise ValueError("this tokenizer does not begin a piece at each single space")
            sizes.append(np.diff(heads, append=len(found)))
            ids.append(found)
        rest = [data[a:b].tobytes().decode() for a, b in zip(start[plain:], end[plain:], strict=True)]
        for found in self.tokenizer.encode_batch(rest, add_special_tokens=False):
            sizes.append([len(found.ids)])
            ids.append(np.array(found.ids, np.int32))
        return np.concatenate(sizes).astype(np.int64), np.concatenate(ids)


@cache
def _runs(path: str) -> _Runs:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return _Runs(Tokenizer.from_file(path))


def encode_block(runs: _Runs, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows of a block, and how many each row has."""
    rows = len(offsets) - 1
    solid = (data > 0x20) & (data < 0x7F)
    ends, opens = solid | _ends_letter(data), solid | _opens_letter(data)
    capital = data & 0xDF
    word = (capital >= 0x41) & (capital <= 0x5A) & solid  # A-Z and a-z
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        between = ends[:-2] & opens[2:]  # a single white space character in the middle is no other's neighbour
        cut[1:-2] |= (data[1:-1] == 0x20) & between
        line = (data[1:-1] == 0x0A) & between
        cut[1:-2] |= line
        cut[2:-1] |= line
        mark = solid & ~word & ~((data >= 0x30) & (data <= 0x39))
        cut[1:-1] |= mark[1:] & word[:-1]
    cut = cut[:-1]
    raw = data.tobytes()
    for token in runs.special:  # a text that holds one is a single run
        at = raw.find(token)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            cut[offsets[row] : offsets[row + 1]] = False
            at = raw.find(token, int(offsets[row + 1]))
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))
    row = np.searchsorted(offsets, start, "right") - 1
    hashes = hash_spans(hash_sums(data, fold_case=False), start, end)
    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    place = runs.look_up(distinct, data, start[first], end[first])[inverse]
    sizes = runs.sizes[place]
    return runs.ids[ragged(runs.starts[place], sizes)], np.bincount(row, sizes, rows).astype(np.int64)


def _opens_letter(data: np.ndarray) -> np.ndarray:
    """First bytes of U+00C0 to U+04FF: Latin, Greek and Cyrillic letters, two bytes each."""
    return (data >= 0xC3) & (data <= 0xD3)


def _ends_letter(data: np.ndarray) -> np.ndarray:
    """Last bytes of such letters; none of these is white space."""
    out = np.zeros(len(data), bool)
    out[1:] = (data[1:] >= 0x80) & (data[1:] < 0xC0) & _opens_letter(data)[:-1]
    return out


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Write ``path``/tokens.orc (part, place, doc_id, n_tokens, ids) and ``path``/index.orc (doc_id, part,
    place, start). ``tokenizer`` is a file that all executors have at this place.

    Every row is kept: null and empty texts have only the end id, repeated ids follow each other, null ids
    come first. ``start`` counts the ids of all rows before.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, runs = TaskContext.get().partitionId(), 0, _runs(tokenizer)
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(1), 1 << 20):
                ids, sizes = encode_block(runs, data, offsets)
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                ends = np.concatenate([[0], np.cumsum(sizes + 1)])
                yield pa.record_batch(
                    {
                        "part": np.full(len(sizes), part, np.int32),
                        "place": np.arange(place, place + len(sizes)),
                        "doc_id": batch.column(0).slice(first, len(sizes)),
                        "n_tokens": sizes + 1,
                        "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                    }
                )
                place += len(sizes)

    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.mapInArrow(encode, "part int, place long, doc_id long, n_tokens long, ids array<int>")
    rows.write.options(**ORC_OPTIONS).orc(f"{path}/tokens.orc")
    sizes = docs.sparkSession.read.orc(f"{path}/tokens.orc").select("part", "place", "doc_id", "n_tokens")
    with_starts(sizes, sizes).select("doc_id", "part", "place", "start").write.options(**ORC_OPTIONS).orc(f"{path}/index.orc")


def with_starts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add ``start``, from (part, place, n_tokens): a running sum within each part, and one over the parts of
    ``sizes``, which has at least part and n_tokens of the same rows and should be cheap to read."""
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task of the write
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return rows.withColumn("start", inside).join(parts, "part").withColumn("start", F.col("start") + F.col("base")).drop("base")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids as written; filters on doc_id reach the stripes."""
    return spark.read.orc(f"{path}/tokens.orc").select("doc_id", "ids")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per document in the files: doc_id, start, n_tokens, ids_crc32."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends, ids = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [batch.column("part"), batch.column("place"), batch.column("doc_id"), pa.array(np.diff(ends).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(crc, pa.int64())], ["part", "place", "doc_id", "n_tokens", "ids_crc32"])

    files = spark.read.orc(f"{path}/tokens.orc")
    rows = files.select("part", "place", "doc_id", "ids").mapInArrow(digest, "part int, place long, doc_id long, n_tokens long, ids_crc32 long")
    return with_starts(rows, files.select("part", "n_tokens")).select("doc_id", "start", "n_tokens", "ids_crc32")


def document_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the documents' ids to the shared folder, and what the files then hold of each."""
    path = f"{shared_dir(docs.sparkSession)}/crossfade/{uuid.uuid4().hex}"
    write_tokens(docs, tokenizer, path)
    return file_digests(docs.sparkSession, path)
