"""Benchmark decontamination with a distributed positional inverted index.

The index holds every word of every document: a row per segment (a quarter of a megabyte of
consecutive texts) with its sorted terms, their counts and their positions. It does not depend on the benchmark and
can be kept. A phrase is looked up from its rarest term, by the counts of the whole index: the rarest
term's list gives candidate starts (position less the term's offset in the phrase), and each further
list, in the order of rarity, keeps the starts it confirms at its own offset. Segments that lack a term
of a phrase are passed over without reading their positions.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, kept as 64-bit hashes.
Phrases go to the tasks in blocks of a fixed number, so nothing that is broadcast grows with the data.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfade.llm.tables import gives_back, materialize, small_side, without_keys
from crossfade.llm.words import WORD, find_words, hash_text, ragged, text_blocks, word_hashes

PHRASES_AT_ONCE = 50_000  # phrases looked up by one pass over the index
SEGMENT_BYTES = 1 << 18  # text of a segment, so that an index row stays well below a megabyte

_INDEX = """segment long, keys array<bigint>, doc_ids array<bigint>, ends array<bigint>,
terms binary, counts binary, positions binary"""


def row_key():
    """Tells rows apart by id and text, nulls included."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def build_index(docs: DataFrame) -> DataFrame:
    """The positional index of all texts, written once. Null text: no words."""

    @gives_back
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(2), SEGMENT_BYTES):
                rows = len(offsets) - 1
                words = find_words(data, offsets, WORD)
                hashes = word_hashes(data, words)
                order = np.argsort(hashes, kind="stable")
                hashes = hashes[order]
                heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else order
                steps = np.diff(order, prepend=0)
                steps[heads] = order[heads]  # each term's list starts anew
                yield pa.record_batch(
                    {
                        "segment": pa.array([segment], pa.int64()),
                        "keys": _list(batch.column(0).slice(first, rows)),
                        "doc_ids": _list(batch.column(1).slice(first, rows)),
                        "ends": _list(pa.array(np.searchsorted(words.row, np.arange(1, rows + 1)))),
                        "terms": pa.array([hashes[heads].tobytes()], pa.binary()),
                        "counts": pa.array([pack(np.diff(heads, append=len(order)).astype(np.uint32).tobytes())], pa.binary()),
                        "positions": pa.array([pack(steps.astype(np.uint32).tobytes())], pa.binary()),
                    }
                )
                segment += 1

    rows = docs.select(row_key().alias("key"), F.col("doc_id").cast("long"), "text")
    return materialize(rows.mapInArrow(build, _INDEX))


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _unpack(cell: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell.as_buffer()), kind)


class _Segment:
    """One index row; positions are read when they are first asked for."""

    def __init__(self, batch: pa.RecordBatch, i: int) -> None:
        self.row = {name: batch.column(name)[i] for name in batch.schema.names}
        self.terms = np.frombuffer(self.row["terms"].as_buffer(), np.uint64)
        counts = _unpack(self.row["counts"], np.uint32).astype(np.int64)
        self.starts, self.counts = np.cumsum(counts) - counts, counts
        self.ends = self.row["ends"].values.to_numpy()

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the terms in the segment's list, and whether they are there."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
        return at, (self.terms[at] == terms) if len(self.terms) else np.zeros(len(terms), bool)

    def load(self) -> None:
        steps = _unpack(self.row["positions"], np.uint32).astype(np.int64)
        sums = np.cumsum(steps)
        base = sums[self.starts] - steps[self.starts]
        self.positions = sums - np.repeat(base, self.counts)
        self.postings = (np.repeat(np.arange(len(self.terms)), self.counts) << 32) | self.positions

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        wanted = (term << 32) | position
        at = np.minimum(np.searchsorted(self.postings, wanted), len(self.postings) - 1)
        return (position >= 0) & (self.postings[at] == wanted)


class _Phrases:
    """Phrases of a block as a matrix of terms, padded on the right, with the rarest term's column first
    in ``order``, and the items that each phrase stands for."""

    def __init__(self, terms: list[np.ndarray], items: list[list[int]], counts: dict[int, int]) -> None:
        self.length = np.array([len(t) for t in terms], np.int64)
        self.terms = np.zeros((len(terms), int(self.length.max(initial=0))), np.uint64)
        for i, t in enumerate(terms):
            self.terms[i, : len(t)] = t
        seen = np.array([[counts.get(int(t), 0) for t in row] for row in self.terms.view(np.uint64)], np.float64)
        seen = seen.reshape(self.terms.shape)
        seen[np.arange(self.terms.shape[1])[None, :] >= self.length[:, None]] = np.inf
        self.order = np.argsort(seen, axis=1, kind="stable")
        self.possible = (seen > 0).all(axis=1)
        self.items = items
        self.distinct, flat = np.unique(self.terms, return_inverse=True)
        self.index = flat.reshape(self.terms.shape)


def _starts(segment: _Segment, phrases: _Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first position) of all occurrences in the segment."""
    at, there = segment.find(phrases.distinct)
    pad = np.arange(phrases.terms.shape[1])[None, :] >= phrases.length[:, None]
    phrase = np.flatnonzero(phrases.possible & (there[phrases.index] | pad).all(axis=1))
    if not len(phrase):
        return phrase, phrase
    segment.load()
    rarest = phrases.order[phrase, 0]
    term = at[phrases.index[phrase, rarest]]
    sizes = segment.counts[term]
    start = segment.positions[ragged(segment.starts[term], sizes)] - np.repeat(rarest, sizes)
    phrase = np.repeat(phrase, sizes)
    for rank in range(1, phrases.terms.shape[1]):
        offset = phrases.order[phrase, rank]
        more = rank < phrases.length[phrase]
        kept = ~more | segment.holds(at[phrases.index[phrase, offset]], start + offset)
        phrase, start = phrase[kept], start[kept]
    last = start + phrases.length[phrase] - 1
    inside = np.searchsorted(segment.ends, start, "right") == np.searchsorted(segment.ends, last, "right")
    inside &= (start >= 0) & (last < len(segment.positions))
    return phrase[inside], start[inside]


def _windows(items: DataFrame, width: int | None) -> DataFrame:
    """Distinct phrases (hash, terms) with the items they come from; width None: whole texts."""

    @gives_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = hash_text(text or "", WORD).view(np.int64)
                size = min(width or len(words), len(words))
                for i in range(len(words) - size + 1 if size else 0):
                    ids.append(item)
                    terms.append(words[i : i + size])
            yield pa.record_batch({"item_id": pa.array(ids, pa.int64()), "terms": pa.array(terms, pa.list_(pa.int64()))})

    rows = items.where("item_id is not null").select(F.col("item_id").cast("long"), "text")
    rows = rows.mapInArrow(cut, "item_id long, terms array<bigint>")
    return materialize(rows.groupBy("terms").agg(F.sort_array(F.collect_set("item_id")).alias("items")))


def _blocks(index: DataFrame, phrases: DataFrame) -> Iterator[_Phrases]:
    """The phrases in blocks of bounded size, with the counts of their terms in the whole index."""
    n = phrases.count()
    blocks = -(-n // PHRASES_AT_ONCE)
    for block in range(blocks):
        rows = phrases.where(F.pmod(F.xxhash64("terms"), F.lit(blocks)) == block).collect()
        terms = [np.array(row["terms"], np.int64).view(np.uint64) for row in rows]
        wanted = np.unique(np.concatenate(terms)) if terms else np.zeros(0, np.uint64)

        @gives_back
        def count(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(wanted), np.int64)
            for batch in batches:
                for cell, packed in zip(batch.column(0), batch.column(1), strict=True):
                    own = np.frombuffer(cell.as_buffer(), np.uint64)
                    if len(own):
                        at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                        total += np.where(own[at] == wanted, _unpack(packed, np.uint32)[at], 0)
            yield pa.record_batch({"term": pa.array(wanted.view(np.int64)), "n": pa.array(total)}).filter(pa.array(total > 0))

        counted = index.select("terms", "counts").mapInArrow(count, "term long, n long")
        counts = {row["term"] & 0xFFFFFFFFFFFFFFFF: row["n"] for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        yield _Phrases(terms, [row["items"] for row in rows], counts)


def exact_matches(index: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """One row per document: key, doc_id, n_words, spans (array of struct first, end: word positions inside
    an occurrence of any ``width`` consecutive words of an item, merged) and items (sorted distinct ids).

    An item with fewer words, but not none, is one phrase; null texts have none; items without an id are
    passed over. Occurrences do not reach over documents.
    """
    found = None
    for phrases in _blocks(index, _windows(items, width)):
        sent = index.sparkSession.sparkContext.broadcast(phrases)
        part = _matched(index, sent, found is None)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return _matched(index, index.sparkSession.sparkContext.broadcast(_Phrases([], [], {})), True).drop("segment", "row")
    if found is not part:
        found = found.groupBy("segment", "row").agg(
            F.first("key").alias("key"), F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    return found.drop("segment", "row")


def _matched(index: DataFrame, sent, everywhere: bool) -> DataFrame:
    @gives_back
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: _Phrases = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                segment = _Segment(batch, i)
                phrase, start = _starts(segment, phrases)
                rows = len(segment.ends)
                begins = np.concatenate([[0], segment.ends[:-1]])
                edge = np.zeros(int(segment.ends[-1]) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + phrases.length[phrase], -1)
                covered = np.cumsum(edge)[:-1] > 0
                owner = np.repeat(np.arange(rows), segment.ends - begins)
                new_row = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
                head = covered & (new_row | ~np.concatenate([[False], covered[:-1]]) if len(covered) else covered)
                tail = covered & np.concatenate([new_row[1:] | ~covered[1:], [True]]) if len(covered) else covered
                first, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
                row_of = owner[first]
                spans = [[] for _ in range(rows)]
                for r, a, b in zip(row_of, first - begins[row_of], end - begins[row_of], strict=True):
                    spans[r].append({"first": int(a), "end": int(b)})
                held = [set() for _ in range(rows)]
                for p, r in {*zip(phrase.tolist(), owner[start].tolist() if len(start) else [], strict=True)}:
                    held[r].update(phrases.items[p])
                rows_out = [r for r in range(rows) if everywhere or spans[r]]
                take = pa.array(rows_out, pa.int64())
                yield pa.record_batch(
                    {
                        "segment": pa.array([segment.row["segment"].as_py()] * len(rows_out), pa.int64()),
                        "row": take,
                        "key": segment.row["keys"].values.take(take),
                        "doc_id": segment.row["doc_ids"].values.take(take),
                        "n_words": pa.array(segment.ends - begins).take(take),
                        "spans": pa.array([spans[r] for r in rows_out], pa.list_(pa.struct({"first": pa.int64(), "end": pa.int64()}))),
                        "items": pa.array([sorted(held[r]) for r in rows_out], pa.list_(pa.int64())),
                    }
                )

    schema = """segment long, row long, key long, doc_id long, n_words long,
    spans array<struct<first: bigint, end: bigint>>, items array<bigint>"""
    return index.mapInArrow(match, schema)


def hit_words(spans: str = "spans"):
    """Words in a sorted list of spans, overlaps counted once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(
        F.col(spans),
        start,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["first"], a["reach"]))).alias("n"),
            F.greatest(a["reach"], s["end"]).alias("reach"),
        ),
        lambda a: a["n"],
    )


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    matched = exact_matches(build_index(docs), items, width)
    names = F.concat_ws(",", F.sort_array(F.transform("items", lambda i: i.cast("string"))))
    return matched.withColumn("n_hit", hit_words()).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The documents in which no ``width`` consecutive words of an item occur, by row: rows of one id, or
    without one, are judged by their own texts. Columns as given, whatever their names."""
    matched = exact_matches(build_index(docs), items, width)
    hit = materialize(matched.where(F.size("spans") > 0).select("key").distinct())
    return without_keys(docs, row_key(), hit)


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = 20) -> DataFrame:
    """(doc_id, item_id, position): occurrences of an item's rarest word that have every other word of the
    item within ``slop`` words in the same document, in any order. Null or wordless items match nothing."""
    found = None
    for phrases in _blocks(index, _windows(items, None)):
        sent = index.sparkSession.sparkContext.broadcast(phrases)

        @gives_back
        def near(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            phrases: _Phrases = sent.value
            for batch in batches:
                for i in range(batch.num_rows):
                    segment, docs, items, places = _Segment(batch, i), [], [], []
                    at, there = segment.find(phrases.distinct)
                    for p in np.flatnonzero(phrases.possible):
                        terms = phrases.index[p, : phrases.length[p]]
                        if not there[terms].all():
                            continue
                        if not hasattr(segment, "positions"):
                            segment.load()
                        lists = [segment.positions[segment.starts[t] : segment.starts[t] + segment.counts[t]] for t in at[terms[phrases.order[p, : len(terms)]]]]
                        anchor = lists[0]
                        doc = np.searchsorted(segment.ends, anchor, "right")
                        low = np.maximum(anchor - slop, np.concatenate([[0], segment.ends])[doc])
                        high = np.minimum(anchor + slop, segment.ends[doc] - 1)
                        for other in lists[1:]:
                            kept = np.searchsorted(other, low) < np.searchsorted(other, high, "right")
                            anchor, doc, low, high = anchor[kept], doc[kept], low[kept], high[kept]
                        ids = segment.row["doc_ids"].values.take(pa.array(doc)).to_pylist()
                        begins = np.concatenate([[0], segment.ends])[doc]
                        for item in phrases.items[p]:
                            docs += ids
                            items += [item] * len(ids)
                            places += (anchor - begins).tolist()
                    yield pa.record_batch(
                        {"doc_id": pa.array(docs, pa.int64()), "item_id": pa.array(items, pa.int64()), "position": pa.array(places, pa.int64())}
                    )

        part = index.mapInArrow(near, "doc_id long, item_id long, position long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return index.sparkSession.createDataFrame([], "doc_id long, item_id long, position long")
    return found
