"""Words, word hashes and shingles of Arrow text columns, vectorised with numpy.

Texts are read as UTF-8 bytes; only A-Z are lower-cased, so a byte decides alone whether it
belongs to a word. Word hashes are 64 bits wide: equal words always have equal hashes, and two
different words of one corpus share one with a chance of about (distinct words)^2 / 2^65.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19  # texts are handled in blocks of about this size; a longer text is one block

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# [^\x20\x09-\x0D]+ : everything but ASCII white space
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing: digits, letters and all bytes of other scripts
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = True
WORD[0x41:0x5B] = True
WORD[0x61:0x7B] = True
WORD[0x80:] = True

_PRIME = 0x2545F4914F6CDD1D
_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_LOWER_CODE = _BYTE_CODE[LOWER]


class _Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            base, inverse = (np.full(size, x, np.uint64) for x in (_PRIME, pow(_PRIME, -1, 1 << 64)))
            base[0] = inverse[0] = 1
            self.up, self.down = np.cumprod(base), np.cumprod(inverse)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Words(NamedTuple):
    """The words of a block in order: first byte, end byte, row within the block."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def text_blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in these bytes) of consecutive rows; null is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def find_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NON_SPACE) -> Words:
    """Maximal runs of bytes of this kind; a run ends where its row ends."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none)
    inside = kind[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    starts = offsets[:-1]
    before[starts[starts < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end, np.searchsorted(offsets, start, "right") - 1)


def hash_sums(data: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """Running sums (from 0) that ``hash_spans`` takes differences of."""
    up, _ = _POWERS.get(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER_CODE if fold_case else _BYTE_CODE)[data] * up, out=sums[1:])
    return sums


def hash_spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash per byte span, the same wherever the span stands."""
    _, down = _POWERS.get(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * _STEP)


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    return hash_spans(hash_sums(data), words.start, words.end)


def hash_text(text: str, kind: np.ndarray = NON_SPACE) -> np.ndarray:
    """Hashes of the words of one text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return word_hashes(data, find_words(data, np.array([0, len(data)]), kind))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each run of ``width`` words; ``bounds`` are the word positions where rows begin
    and end. A row with fewer words, but not none, has its whole sequence as its one shingle."""
    counts = np.diff(bounds)
    if len(hashes) >= width:
        whole = np.zeros(len(hashes) - width + 1, np.uint64)
        for i in range(width):
            whole += hashes[i : len(whole) + i] * _U((2 * i + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF)
        row = np.repeat(np.arange(len(counts)), counts)
        fits = row[: len(whole)] == row[width - 1 :]
        value, row = mix(whole[fits]), row[: len(whole)][fits]
    else:
        value, row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.array(
            [
                sum(int(h) * (2 * i + 3) * 0xD1342543DE82EF95 for i, h in enumerate(hashes[bounds[r] : bounds[r + 1]]))
                + int(counts[r])
                & 0xFFFFFFFFFFFFFFFF
                for r in short
            ],
            np.uint64,
        )
        value, row = np.concatenate([value, mix(extra)]), np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        value, row = value[order], row[order]
    return value, row


def shingle_sets(column: pa.Array, width: int, kind: np.ndarray = NON_SPACE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row in turn; no words, no shingles."""
    for _, data, offsets in text_blocks(column):
        words = find_words(data, offsets, kind)
        bounds = np.searchsorted(words.row, np.arange(len(offsets)))
        value, row = shingles(word_hashes(data, words), bounds, width)
        ends = np.searchsorted(row, np.arange(len(offsets)))
        for i in range(len(offsets) - 1):
            yield np.unique(value[ends[i] : ends[i + 1]])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all spans (start, length) one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
