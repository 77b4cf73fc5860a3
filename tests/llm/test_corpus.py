"""Toxicity, decontamination, the Jaccard join and the pipeline on small corpora with planted cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crossfade.llm import decontaminate as D
from crossfade.llm import ngram_join as N
from crossfade.llm import tables, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def letter_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], SCHEMA)


def shingle_set(text, width):
    words = low(text).split()  # the test texts hold no other white space
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def components(texts, width, percent):
    sets = [shingle_set(t, width) for _, t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if texts[i][0] is None or texts[j][0] is None or not sets[i]:
                continue
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    out = []
    for i, (doc, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if group[j] == group[i] and texts[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if doc is not None else None))
    return out


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_jaccard_components_equal_brute_force(spark, width, percent):
    rng = random.Random(width)
    texts = []
    common = prose(rng, 14)
    for family in range(12):
        words = prose(rng, rng.choice([3, 6, 40, 120])).split()
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = prose(rng, 1)
            texts.append((len(texts) * 3 % 997, " ".join(copy) + (" " + common if family % 3 == 0 else "")))
    texts += [(2000, ""), (2001, None), (2002, "One"), (2003, "one"), (2004, "a b"), (2005, " \t\n"), (None, texts[0][1]), texts[0], (2006, common), (2007, "w " * 9000)]
    got = N.jaccard_components(frame(spark, texts).withColumn("node", F.lit(1)), width, percent).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(components(texts, width, percent), key=repr)


def test_keep_one_goes_by_row(spark):
    a, b, c = (prose(random.Random(k), 60) for k in (11, 12, 13))
    rows = [(2, a), (2, b), (1, a + " x"), (4, b + " y"), (None, b + " z"), (None, c), (None, c), (None, c + " q"), (6, ""), (6, ""), (None, None)]
    df = frame(spark, rows).withColumn("__key", F.lit(7)).withColumn("row_key", F.lit("mine")).withColumn("Row_Key_", F.lit(1))
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    got = kept.collect()
    # one of each family: id 2 stands in two of them, and the last has no ids at all
    assert sorted((r["doc_id"], r["text"]) for r in got if r["doc_id"] not in (None, 6)) == sorted([(1, a + " x"), (2, b)])
    assert sum((r["text"] or "").startswith(c[:40]) for r in got) == 1
    assert sum(r["text"] in ("", None) for r in got) == 3 and len(got) == 6
    assert {(r["__key"], r["row_key"], r["Row_Key_"]) for r in got} == {(7, "mine", 1)}


def test_stages_keep_columns_whatever_their_names(spark):
    texts, labels = toxic_corpus(300)
    df = frame(spark, texts).withColumn("__key", F.col("doc_id") + 1).withColumn("key", F.lit(3)).withColumn("row_key", F.lit(4))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    item = texts[0][1]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    for kept in (toxicity.drop_toxic(df, known, D.row_key()), D.drop_contaminated(df, bench)):
        assert kept.columns == df.columns
        rows = kept.collect()
        assert 0 < len(rows) < len(texts)
        assert all((r["__key"], r["key"], r["row_key"]) == (r["doc_id"] + 1, 3, 4) for r in rows)


def test_sketch_does_not_grow_with_the_partitions(spark):
    rng = random.Random(5)
    df = frame(spark, [(i, prose(rng, 30)) for i in range(500)])
    few, many = (N.token_sketch(df.repartition(n), 3) for n in (8, 400))
    assert (few == many).all() and few.sum() > 0
    parts = df.repartition(400).select("text").coalesce(spark.sparkContext.defaultParallelism)
    assert parts.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_keep_one_and_empty(spark):
    base = prose(random.Random(1), 60)
    df = frame(spark, [(5, base), (3, base + " tail"), (3, base + " tail"), (9, prose(random.Random(2), 30)), (None, base), (7, ""), (8, None)])
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 8, 9]
    assert N.keep_one(df.limit(0)).count() == 0 and N.jaccard_components(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    nodes = rng.sample(range(10**6), 300)
    edges = [(nodes[i], nodes[i + 1]) for i in range(120)] + [(nodes[200], n) for n in nodes[201:]] + [(nodes[0], nodes[0])]
    got = dict(map(tuple, tables.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    for part in (nodes[:121], nodes[200:]):
        assert all(got.get(n, n) == min(part) for n in part)
    assert len(got) == 120 + 99


def contamination(texts, items, width=10):
    windows = []
    for item, text in items:
        words = letter_words(text)
        size = min(width, len(words))
        if item is not None and words:
            windows += [(item, words[i : i + size]) for i in range(len(words) - size + 1)]
    for doc, text in texts:
        words, hit, held = letter_words(text), set(), set()
        for item, w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    held.add(item)
        names = ",".join(sorted(map(str, held)))
        yield doc, len(words), len(hit), len(held), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [D.PHRASES_AT_ONCE, 7])
def test_contamination_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(D, "PHRASES_AT_ONCE", block)
    rng = random.Random(8)
    items = [(i, prose(rng, rng.choice([1, 4, 10, 25]))) for i in range(12)] + [(50, None), (51, "..."), (None, "a b"), (2, "x y x y x y x y x y x y")]
    texts = [(i, prose(rng, 30)) for i in range(20)]
    for i, text in items[:12]:
        words = (text or "").split()
        cut = words[: rng.choice([len(words), 9, 12])]
        texts.append((100 + i, prose(rng, 5) + ". " + ", ".join(cut).upper() + " " + prose(rng, 5) + " " + " ".join(cut[2:])))
    texts += [(300, None), (301, ""), (302, "x y " * 30), (None, items[0][1]), (0, items[3][1]), (303, prose(rng, 4000))]
    df = frame(spark, texts).withColumn("terms", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(df, bench).collect()
    expected = list(contamination(texts, items))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    kept = [r["text"] for r in D.drop_contaminated(df, bench).collect()]
    assert sorted(map(repr, kept)) == sorted(repr(t) for (_, t), e in zip(texts, expected, strict=True) if not e[5])
    assert D.contamination(df.limit(0), bench).count() == 0
    assert not any(r["contaminated"] for r in D.contamination(df, bench.limit(0)).collect())


def test_proximity(spark):
    df = frame(spark, [(1, "alpha x x beta y gamma"), (2, "alpha " + "x " * 30 + "beta gamma"), (3, "gamma, beta. ALPHA"), (4, None)])
    index = D.build_index(df)
    items = spark.createDataFrame([(7, "alpha beta gamma"), (8, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.proximity_matches(index, items, slop=5).collect()}
    assert got == {(1, 7), (3, 7)}


def toxic_corpus(n=900):
    rng = random.Random(11)
    insults, groups = ["vile", "scum", "trash"], ["zorbs", "quints"]
    texts, labels = [], []
    for i in range(n):
        words = prose(rng, 60).split()
        kind = i % 6
        if kind in (0, 1):  # an insult and a group together are toxic, either alone is not
            words[rng.randrange(60)] = rng.choice(insults)
        if kind in (0, 2):
            words[rng.randrange(60)] = rng.choice(groups)
        bad = bool({*words} & {*insults}) and bool({*words} & {*groups})
        texts.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return texts, labels


def test_toxicity_on_held_out_rows(spark):
    texts, labels = toxic_corpus()
    texts += [(5000, None), (5001, ""), (None, "scum zorbs"), (0, texts[0][1])]
    df = frame(spark, texts).withColumn("score", F.lit(9))
    got = toxicity.document_scores(df, spark.createDataFrame(labels + [(5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(texts)
    truth = {d: t for d, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.document_scores(df, none).collect()} == {0.5}
    assert toxicity.document_scores(df.limit(0), none).count() == 0


def test_pipeline(spark, folder):
    rng = random.Random(3)
    texts, labels = toxic_corpus(600)
    truth = {d for d, _, t in labels if t}
    item = prose(rng, 20)
    near = prose(rng, 80)
    texts += [(1000, near), (1001, near + " x"), (1002, near), (1003, prose(rng, 10) + " " + item), (1004, ""), (1005, None)]
    frame(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert not {1001, 1002, 1003} & set(got) and {1000, 1004, 1005} <= set(got)
    clean = {d for d, _ in texts if d < 1000} - truth
    assert len(truth & set(got)) < 0.05 * len(truth) and len(clean - set(got)) < 0.02 * len(clean)
    text = dict(texts)
    assert all(r["text"] == (text[d] or "") and r["n_pieces"] == len(r["pieces"]) for d, r in got.items())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
