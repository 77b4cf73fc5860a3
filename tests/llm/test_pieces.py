from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from crossfade.llm import pieces, queries
from crossfade.llm.words import text_blocks

MODEL = queries.tokenizer_file("piece_bpe_32k.model")
TEXTS = [
    "Hello world", "", None, " ", "   three   spaces  ", "\n\n a\n", "tab\there\r\n", "▁ literal ▁▁mark", "日本語 текст ünï 🙂 é",
    "x" * 3000, "https://example.org/a?b=c&d=%20", "\x00\x01 \x7f", "word " * 2000, "",
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(MODEL)


def test_round_trip_is_lossless_and_reproducible(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "y"), (0, TEXTS[0], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __key string")
    coded = pieces.encode(df.repartition(3), MODEL)
    back = pieces.decode(coded.withColumnRenamed("text", "original"), MODEL)
    got = {(r["doc_id"], r["original"]): r for r in back.collect()}
    assert all(r["text"] == (r["original"] or "") for r in got.values())
    assert {r["__key"] for r in got.values()} <= {"x", "y", "z"}
    again = {(r["doc_id"], r["text"]): r["pieces"] for r in pieces.encode(df.coalesce(1), MODEL).collect()}
    assert all(again[key] == r["pieces"] for key, r in got.items())
    facts = pieces.round_trips(df, MODEL).collect()
    assert len(facts) == len(rows) and all(r["lossless"] for r in facts)
    assert pieces.round_trips(df.limit(0), MODEL).count() == 0


def test_random_texts(vocabulary):
    rng = np.random.default_rng(3)
    parts = ["a", "the", " ", "  ", "\n", "▁", "é", "日", "🙂", ".", "ing", "\t", "12", "\x00", "​"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(3000)]
    for first, data, offsets in text_blocks(pa.array(texts)):
        ids, sizes = vocabulary.encode(data, offsets, np.arange(len(offsets) - 1))
        back, ends = vocabulary.decode(ids, sizes)
        got = [back[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert got == texts[first : first + len(got)]


def test_draws_follow_the_weights(vocabulary):
    text = "these"
    spelt = {}
    for i in range(len(vocabulary.spelt_size)):
        a = vocabulary.spelt_start[i]
        if vocabulary.weights[i] > pieces.BYTE_WEIGHT:
            spelt[vocabulary.spelt[a : a + vocabulary.spelt_size[i]].tobytes().decode()] = i
    whole, ways = " " + text, {}
    for cuts in product([0, 1], repeat=len(whole) - 1):
        places = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(whole)]
        parts = [whole[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
        if all(p in spelt for p in parts):
            ids = tuple(spelt[p] for p in parts)
            ways[ids] = np.exp(sum(vocabulary.weights[i] for i in ids))
    n = 40_000
    data = np.frombuffer((text * n).encode(), np.uint8)
    ids, sizes = vocabulary.encode(data, np.arange(n + 1) * len(text), np.arange(n))
    seen = Counter(tuple(x.tolist()) for x in np.split(ids, np.cumsum(sizes)[:-1]))
    assert set(seen) <= set(ways)
    total = sum(ways.values())
    for way, weight in ways.items():
        p = weight / total
        assert abs(seen[way] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4


def test_draws_do_not_depend_on_neighbours():
    rng = np.random.default_rng(8)
    letters = list("aaabl ")  # many segmentations of equal weight
    texts = ["".join(rng.choice(letters, rng.integers(1, 300))) for _ in range(400)]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    together, sizes = pieces.Pieces(MODEL).encode(np.concatenate(data), offsets, np.arange(len(texts)))
    alone, split = pieces.Pieces(MODEL), np.split(together, np.cumsum(sizes)[:-1])
    for i in rng.permutation(len(texts)):
        ids, _ = alone.encode(data[i], np.array([0, len(data[i])]), np.array([i]))
        assert np.array_equal(ids, split[i])
