import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossfade.llm import context_tree as C

TEXTS = ["the cat sat", "the cat  sat", "The hat", "", None, "a rat that sat on the mat", "ünï the", "zz", "the cat sat"]


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def brute(texts, train, depth):
    """Scores by counting every node of every tree in dictionaries."""
    counts = [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]
    children = [defaultdict(set) for _ in range(depth + 1)]

    def steps(text):
        data = bytes([0xFF] * depth) + lower(text).encode() + b"\xff"
        for i in range(depth, len(data)):
            for k in range(8):
                yield data[i - depth : i], (1 << k) | (data[i] >> (8 - k)), (data[i] >> (7 - k)) & 1

    for text, own in zip(texts, train, strict=True):
        for context, node, bit in steps(text) if own else ():
            for d in range(depth + 1):
                near = context[depth - d :]
                counts[d][near, node][bit] += 1
                if d:
                    children[d - 1][near[1:], node].add((near, node))

    def kt(pair):
        a, b = pair
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    weighted = [{} for _ in range(depth + 1)]
    for d in range(depth, -1, -1):
        for key, pair in counts[d].items():
            below = sum(weighted[d + 1][c] for c in children[d][key]) if d < depth else 0
            weighted[d][key] = kt(pair) if d == depth else np.logaddexp(kt(pair), below) - math.log(2)

    def chance(context, node, bit):
        p = None
        for d in range(depth, -1, -1):
            key = context[depth - d :], node
            pair = counts[d].get(key, [0, 0])
            own = (pair[1] + 0.5) / (sum(pair) + 1)
            if p is None:
                p = own
                continue
            w = math.exp(kt(pair) - math.log(2) - weighted[d].get(key, 0.0))
            p = w * own + (1 - w) * p
        return p if bit else 1 - p

    return [sum(math.log10(chance(*s)) for s in steps(t)) for t in texts]


def brute_base(texts, train):
    counts = Counter()
    for text, own in zip(texts, train, strict=True):
        if own:
            counts.update([*lower(text).split(), 0])
    n, v = sum(counts.values()), len(counts)
    for text in texts:
        tokens = [*lower(text).split(), 0]
        yield len(tokens), sum(counts[t] > 0 for t in tokens), n, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)


@pytest.mark.parametrize("sizes", [(C.GRAMS_SENT, C.WORDS_SENT), (0, 2)])
def test_scores_equal_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(C, "GRAMS_SENT", sizes[0])
    monkeypatch.setattr(C, "WORDS_SENT", sizes[1])
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in C.score(df, F.col("doc_id") % 3 != 1).collect()}
    train = [i % 3 != 1 for i in range(len(TEXTS))]
    expected = brute(TEXTS, train, C.DEPTH)
    for i, (tokens, known, total, base) in enumerate(brute_base(TEXTS, train)):
        row = got[i]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (not train[i], tokens, known, total)
        assert row["base_score"] == pytest.approx(base, abs=1e-9)
        assert row["score"] == pytest.approx(expected[i], abs=1e-9)


def test_held_out_fold_and_edge_rows(spark):
    df = spark.createDataFrame([(None, "a"), (7, "b"), (7, "b"), (1, "x" * 50_000)], "doc_id long, text string")
    got = C.document_scores(df).collect()
    assert len(got) == 4
    for row in got:
        assert row["held_out"] == (row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 1)
    assert C.document_scores(df.limit(0)).count() == 0


def test_code_length_beats_even_bits(spark):
    line = "all work and no play makes jack a dull boy "
    df = spark.createDataFrame([(i, line * 5) for i in range(20)], "doc_id long, text string")
    for row in C.document_scores(df).collect():
        assert -row["score"] / math.log10(2) / len(line * 5) < 1


def test_only_rare_grams_leave_a_text(spark, monkeypatch):
    """Of a model larger than the table sent out, grams that stand in many texts are in the table, held-out texts too."""
    line = "all work and no play makes jack a dull boy "
    texts = [line * 5 + (f"{i} only here {i * 7919}" if i % 4 else "QUITE another story") for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = F.col("doc_id") % 4 != 0
    whole = {r["doc_id"]: r["score"] for r in C.score(df, train).collect()}
    written, write = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda rows: written.append(write(rows)) or written[-1])
    monkeypatch.setattr(C, "GRAMS_SENT", 150)
    got = {r["doc_id"]: r["score"] for r in C.score(df, train).collect()}
    assert got == pytest.approx(whole, abs=1e-9)
    left = Counter(k for table in written if "grams" in table.columns for r in table.select("grams").collect() for k in r["grams"] or ())
    assert left and sum(left.values()) < sum(map(len, texts)) / 10
    assert max(left.values()) < 15
