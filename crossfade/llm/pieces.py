"""Sampled SentencePiece segmentations, and their lossless decoding.

A text's pieces are drawn from all its segmentations by forward filtering and backward sampling: going
forward, every position of the piece lattice sums the weights of the segmentations that reach it; going
backward from the end, each piece is drawn in proportion to what leads to it. The draws come from a counter
hashed with the row's key, so a row has the same pieces on every run, in any partition and order.

The lattice falls apart at places that no piece of the vocabulary crosses: before a run of spaces, and on
both sides of a line end. Forward sums are kept for each distinct part, and all parts of a block of texts go
backward together, a piece a step.

Spaces are handled as in the library: one is put before a text, and pieces spell it U+2581. Characters
without a piece, U+2581 itself among them, are spelt by byte pieces, so decoding gives back every text.
Weights are the scores of a unigram model; a BPE model has only ranks, and a piece of rank r weighs
``-theta * ln(r + 10)``.
"""

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfade.llm.hashtable import HashTable
from crossfade.llm.tables import gives_back
from crossfade.llm.words import hash_spans, hash_sums, mix, ragged, text_blocks

SEED = 17
THETA = 2.0
BYTE_WEIGHT = -30.0
BLOCK = 1 << 18  # bytes of texts that are encoded at once; the arrays made for them take some hundred times that
EDGES_KEPT = 1_250_000  # lattice edges that a worker remembers before it starts anew

_TOKEN, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


class Pieces:
    """The vocabulary as tables, and the lattices of the parts seen so far."""

    def __init__(self, model: str, theta: float = THETA) -> None:
        import sentencepiece

        spm = sentencepiece.SentencePieceProcessor(model_file=model)
        size = spm.get_piece_size()
        self.byte_ids = np.zeros(256, np.int32)
        self.weights = np.full(size, BYTE_WEIGHT)
        spelt: list[bytes] = [b""] * size
        ranked = min(spm.get_score(i) for i in range(size)) < -1000
        whole, longest = {}, 1
        for i in range(size):
            if spm.is_byte(i):
                value = int(spm.id_to_piece(i)[3:5], 16)
                self.byte_ids[value] = i
                spelt[i] = bytes([value])
            elif not (spm.is_control(i) or spm.is_unknown(i) or spm.is_unused(i)):
                piece = spm.id_to_piece(i).replace("▁", " ")
                if " " in piece.lstrip(" ") or "\n" in piece:
                    raise ValueError(f"piece {piece!r} crosses a space or a line end")
                spelt[i] = piece.encode()
                whole[spelt[i]] = i
                longest = max(longest, len(spelt[i]))
                score = spm.get_score(i)
                self.weights[i] = -theta * np.log(max(0.0, -score) + 10) if ranked else score
        if len({*self.byte_ids.tolist()}) < 256:
            raise ValueError("the model has no byte pieces")
        self.longest = longest
        beginnings = {piece[:n]: -1 for piece in whole for n in range(1, len(piece))} | whole
        data = np.frombuffer(b"".join(beginnings), np.uint8)
        sizes = np.array([len(x) for x in beginnings])
        ends = np.cumsum(sizes)
        keys = hash_spans(hash_sums(data, fold_case=False), ends - sizes, ends)
        self.table = HashTable(keys, np.array(list(beginnings.values()), np.int32))
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        self.spelt_size = np.array([len(x) for x in spelt], np.int64)
        self.spelt_start = np.cumsum(self.spelt_size) - self.spelt_size
        self.clear()

    def clear(self) -> None:
        self.known = HashTable(np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.keys = np.zeros(0, np.uint64)
        self.last = np.zeros(0, np.int64)  # of each part, its end node
        self.first = np.zeros(0, np.int64)
        # edges by end node, likeliest first: chance of an edge and those before, start node, piece
        self.nodes = self.edges = 0
        self.draws, self.source, self.piece = np.zeros(0, np.float32), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.into = np.zeros(0, np.int32)  # of each node, its first edge

    def parts(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of these distinct parts of the block's bytes, added if new."""
        if self.edges > EDGES_KEPT:
            self.clear()
        place, there = self.known.find(keys)
        new = np.flatnonzero(~there)
        if len(new):
            place[new] = len(self.keys) + np.arange(len(new))
            self._add(data, start[new], end[new])
            self.keys = np.concatenate([self.keys, keys[new]])
            self.known = HashTable(self.keys, np.arange(len(self.keys)))
        return place

    def _edges(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first byte, length, piece) of all pieces in parts that follow each other in ``data``."""
        sums = hash_sums(data, fold_case=False)
        opens = (data & 0xC0) != 0x80
        opens[np.concatenate([[0], ends[:-1]])] = True
        at = np.flatnonzero(opens)
        limit = np.repeat(ends, np.diff(ends, prepend=0))[at]
        character = np.diff(at, append=len(data))
        spelt = np.zeros(len(at), bool)
        live = np.arange(len(at))
        found = []
        for length in range(1, self.longest + 1):
            live = live[at[live] + length <= limit[live]]
            if not len(live):
                break
            piece, there = self.table.find(hash_spans(sums, at[live], at[live] + length))
            live, piece = live[there], piece[there]
            hit = piece >= 0
            found.append((at[live[hit]], np.full(int(hit.sum()), length), piece[hit]))
            spelt[live[hit & (character[live] == length)]] = True
        bytes_at = ragged(at[~spelt], character[~spelt])
        found.append((bytes_at, np.ones(len(bytes_at), np.int64), self.byte_ids[data[bytes_at]]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _add(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        sizes = end - start
        data = data[ragged(start, sizes)]
        ends = np.cumsum(sizes)
        at, length, piece = self._edges(data, ends)
        part = np.searchsorted(ends, at, "right")
        # nodes: a part of n bytes has n + 1 of them
        source = at + part
        target = source + length
        local = target - (ends - sizes + np.arange(len(sizes)))[part]
        weight = self.weights[piece]
        order = np.lexsort((target, local))
        source, target, piece, weight, local = (x[order] for x in (source, target, piece, weight, local))
        ln = np.full(len(data) + len(sizes), -np.inf)
        ln[ends - sizes + np.arange(len(sizes))] = 0
        steps = np.flatnonzero(np.diff(local, prepend=-1, append=-1))
        chance = np.zeros(len(source))
        for lo, hi in zip(steps[:-1], steps[1:], strict=True):  # all edges that end at one distance from their part's start
            heads = np.flatnonzero(np.diff(target[lo:hi], prepend=-1))
            value = ln[source[lo:hi]] + weight[lo:hi]
            counts = np.diff(heads, append=hi - lo)
            top = np.maximum.reduceat(value, heads)
            share = np.exp(value - np.repeat(top, counts))
            total = np.add.reduceat(share, heads)
            ln[target[lo:hi][heads]] = top + np.log(total)
            chance[lo:hi] = share / np.repeat(total, counts)
        # likeliest first, then shortest: nothing here may depend on what else is in the block
        order = np.lexsort((target - source, -chance, target))
        source, target, piece, chance = (x[order] for x in (source, target, piece, chance))
        heads = np.flatnonzero(np.diff(target, prepend=-1))
        counts = np.diff(heads, append=len(target))
        running = chance.copy()
        for rank in range(1, int(counts.max(initial=0))):
            later = heads[counts > rank] + rank
            running[later] += running[later - 1]
        running[heads + counts - 1] = 2  # the last takes what rounding leaves
        into = np.zeros(len(ln), np.int32)
        into[target[heads]] = self.edges + heads
        self.draws = _append(self.draws, self.edges, running)
        self.source = _append(self.source, self.edges, self.nodes + source)
        self.piece = _append(self.piece, self.edges, piece)
        self.into = _append(self.into, self.nodes, into)
        self.edges += len(source)
        self.first = np.concatenate([self.first, self.nodes + ends - sizes + np.arange(len(sizes))])
        self.last = np.concatenate([self.last, self.nodes + ends + np.arange(len(sizes))])
        self.nodes += len(ln)

    def encode(self, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and how many each has; ``keys`` seed the rows' draws. Empty rows have none."""
        rows = len(offsets) - 1
        filled = np.diff(offsets) > 0
        before = np.cumsum(filled)
        stream = np.full(len(data) + int(before[-1] if rows else 0), 0x20, np.uint8)
        stream[np.arange(len(data)) + np.repeat(before, np.diff(offsets))] = data
        bounds = offsets + np.concatenate([[0], before])
        space, line = stream == 0x20, stream == 0x0A
        cut = np.zeros(len(stream) + 1, bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        cut[:-1] |= line
        cut[1:] |= line
        cut = cut[:-1]
        cut[bounds[:-1][filled]] = True
        start = np.flatnonzero(cut)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(rows, np.int64)
        end = np.append(start[1:], len(stream))
        row = np.searchsorted(bounds, start, "right") - 1
        hashes = hash_spans(hash_sums(stream, fold_case=False), start, end)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        part = self.parts(distinct, stream, start[first], end[first])[inverse]
        # draw backward, all parts at once
        number = np.arange(len(start)) - np.searchsorted(row, np.arange(rows))[row]
        counter = mix(keys.view(np.uint64) ^ np.uint64(SEED))[row] + number.astype(np.uint64) * _TOKEN
        node, goal, alive = self.last[part], self.first[part], np.arange(len(start))
        drawn = []
        taken = np.zeros(len(start), np.int64)
        while len(alive):
            even = (mix(counter[alive]) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            counter[alive] += _STEP
            edge = self.into[node]
            open_ = np.flatnonzero(self.draws[edge] <= even)
            while len(open_):
                edge[open_] += 1
                open_ = open_[self.draws[edge[open_]] <= even[open_]]
            drawn.append((alive, self.piece[edge]))
            taken[alive] += 1
            node = self.source[edge].astype(np.int64)
            more = node != goal[alive]
            alive, node = alive[more], node[more]
        behind = np.cumsum(taken)
        ids = np.zeros(int(behind[-1]), np.int32)
        for step, (which, piece) in enumerate(drawn):
            ids[behind[which] - 1 - step] = piece
        return ids, np.bincount(row, taken, rows).astype(np.int64)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the texts of rows of ids, without the space put before each."""
        lengths = self.spelt_size[ids]
        data = self.spelt[ragged(self.spelt_start[ids], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(sizes)]
        starts = np.concatenate([[0], ends[:-1]])
        filled = ends > starts
        kept = np.ones(len(data), bool)
        kept[starts[filled]] = False
        return data[kept], np.concatenate([[0], ends - np.cumsum(filled)])


def _append(room: np.ndarray, used: int, values: np.ndarray) -> np.ndarray:
    """``room`` with the values behind its ``used`` first ones, grown by half if they don't fit."""
    if used + len(values) > len(room):
        room = np.concatenate([room[:used], np.empty(max(used // 2, len(values)), room.dtype)])
    room[used : used + len(values)] = values
    return room


@cache
def load(model: str) -> Pieces:
    return Pieces(model)


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, model: str, into: str = "pieces", decoded: str | None = None) -> DataFrame:
    """The rows with a column of sampled piece ids; null and empty texts have none. ``model`` is a file that
    all executors have at this place. Rows are seeded by doc_id; rows with one id and text get one answer.

    With ``decoded``, that column (``text``, if you like) holds what the ids decode to, without a second pass.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(1), BLOCK):
                rows = batch.slice(first, len(offsets) - 1)
                ids, sizes = pieces.encode(data, offsets, rows.column(0).to_numpy())
                out = [*rows.columns[2:], _lists(ids, sizes)]
                if decoded:
                    out.append(_strings(*pieces.decode(ids, sizes)))
                yield pa.RecordBatch.from_arrays(out, schema.names)
        pieces.clear()  # a worker that goes on to other work should not hold lattices

    names = [c for c in docs.columns if c not in (into, decoded)]
    kept = docs.select(F.xxhash64(F.col("doc_id").cast("long")), F.col("text").cast("string"), *names)
    kept = kept.toDF(*(f"c{i}" for i in range(len(names) + 2)))  # given names may clash with any of ours
    schema = T.StructType([*docs.select(*names).schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add(decoded, T.StringType())
    return kept.mapInArrow(run, schema)


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data.tobytes()))


def decode(rows: DataFrame, model: str, ids: str = "pieces", into: str = "text") -> DataFrame:
    """The rows with the text that their piece ids spell; null ids give an empty text."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            lists = batch.column(0)
            data, offsets = pieces.decode(lists.flatten().to_numpy(), np.array(lists.value_lengths().fill_null(0)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], _strings(data, offsets)], [*names, into])

    names = [c for c in rows.columns if c != into]
    kept = rows.select(F.col(ids), *names).toDF(*(f"c{i}" for i in range(len(names) + 1)))
    return kept.mapInArrow(run, rows.select(*names).schema.add(into, "string"))


def round_trips(docs: DataFrame, model: str) -> DataFrame:
    """One row per document: doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit integers),
    n_bytes (of the decoded text) and lossless (whether that is the text)."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(2), BLOCK):
                rows = batch.slice(first, len(offsets) - 1)
                ids, sizes = pieces.encode(data, offsets, rows.column(0).to_numpy())
                back, ends = pieces.decode(ids, sizes)
                ids, at = ids.astype("<u4"), np.concatenate([[0], np.cumsum(sizes)])
                same = [
                    np.array_equal(back[a:b], data[c:d])
                    for a, b, c, d in zip(ends[:-1], ends[1:], offsets[:-1], offsets[1:], strict=True)
                ]
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
                columns = [rows.column(1), pa.array(sizes), pa.array(crc, pa.int64()), pa.array(np.diff(ends)), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "ids_crc32", "n_bytes", "lossless"])
        pieces.clear()  # a worker that goes on to other work should not hold lattices

    rows = docs.select(F.xxhash64(F.col("doc_id").cast("long")).alias("key"), F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, n_bytes long, lossless boolean")
