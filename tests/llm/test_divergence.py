import random
import re
from collections import Counter

import pytest

from crossfade.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, term string, p int, q int, value int, rank int, group_id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, l, s, "mine", 1, 2, 3, 4, "g") for i, (t, l, s) in enumerate(rows)], SCHEMA)


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_force(rows, least=10):
    rows = [(terms(t), l or "", s or "") for t, l, s in rows]
    out = []
    for lang in {l for _, l, _ in rows}:
        mine = [(t, s) for t, l, s in rows if l == lang]
        known = {t for t, n in Counter(t for ts, _ in mine for t in set(ts)).items() if n >= least}
        v = len(known)
        count = {s: Counter(t for ts, z in mine if z == s for t in ts if t in known) for s in {s for _, s in mine}}
        whole = sum(count.values(), Counter())

        def rate(c):
            n = sum(c.values())
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * v) for t in known}

        rates, q = {s: rate(c) for s, c in count.items()}, rate(whole)

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in count:
            pairs = [(sum(gap(rates[s][t], rates[o][t]) for t in known), o) for o in count if o != s]
            single = [(gap(rates[s][t], q[t]), t) for t in known if count[s][t] > 0 and rates[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", single, 10)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def made(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("wort", "Mot", "été", "ПРИВЕТ", "x", "日本") for b in "abcdefghij"]
    rows = []
    for _ in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "", None, "é", "日"])
        skew = rng.choice([5, 20, 60])
        text = rng.choice([" ", "-", "3", ", "]).join(rng.choice(vocabulary[:skew]) for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "de", None, ""]), source))
    rows += [(None, "en", "none"), ("", "fr", "a"), ("seldom words", "fr", "b"), ("12 34", "xx", "only"), ("THE the\x85the", "en", "a")] + [("same text Same", "en", "copy")] * 30
    return rows


@pytest.mark.parametrize("block, open_bytes, parts", [(D.BLOCK, D.OPEN, 3), (2000, 3000, 7), (1, 1, 2)])
def test_equals_brute_force(spark, block, open_bytes, parts):
    rows = made(parts)
    found = D.divergence(frame(spark, rows).repartition(parts), block=block, open_bytes=open_bytes)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert result(found) == brute_force(rows)


def test_no_rows_and_no_terms(spark):
    assert result(D.divergence(frame(spark, []).limit(0))) == []
    rows = [(None, "en", "a"), ("rare", "en", "b"), ("", None, None), ("x", None, "c")]
    assert result(D.divergence(frame(spark, rows))) == brute_force(rows) == [
        ("", "", "pair", "c", 0, 1), ("", "c", "pair", "", 0, 1), ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)
    ]


def test_ties_go_by_bytes(spark):
    rows = [(w, "en", s) for s, w in (("a", "zeta beta"), ("a", "￿\U00010000"), ("b", "other"), ("c", "other")) for _ in range(10)]
    rows += [(" ".join(["￿x", "\U00010000x"]), "en", "a")] * 10
    assert result(D.divergence(frame(spark, rows))) == brute_force(rows)


def test_a_very_long_text_and_a_very_long_term(spark):
    rng = random.Random(4)
    long_text = " ".join(rng.choice(["eins", "zwei", "drei"]) for _ in range(300_000))
    rows = [(long_text, "de", "a")] + [("x" * 100_000 + " eins zwei drei", "de", "b")] * 11 + [("drei", "de", "c")]
    assert result(D.divergence(frame(spark, rows))) == brute_force(rows)


def test_runs_are_sorted_and_cut_by_shard(spark):
    df = frame(spark, made(1)).selectExpr("text", "hash(lang) * 1L lang_id", "hash(lang, source) * 1L group_id").repartition(3)
    chunks = D.spilled_runs(df, 5, block=4000).collect()
    assert {c.shard for c in chunks} == set(range(5))
    of = {}
    for c in chunks:
        encoded = [t.encode() for t in c.terms]
        assert encoded == sorted(encoded) and c.first == c.terms[0] and len(c.terms) <= D.CHUNK
        assert len(c.terms) == len(c.group_ids) == len(c.counts) == len(c.documents)
        for t in c.terms:
            assert of.setdefault(t, c.shard) == c.shard


def test_many_sources_of_a_term(spark):
    rows = [(f"common {'mine' if k % 3 else 'other'}", "en", f"s{k % 70:02d}") for k in range(700)]
    assert result(D.divergence(frame(spark, rows))) == brute_force(rows)
    pairs = D.pair_corrections
    D.divergence.__globals__["pair_corrections"] = lambda lists: pairs(lists, pairs=10)
    try:
        assert result(D.divergence(frame(spark, rows))) == brute_force(rows)
    finally:
        D.divergence.__globals__["pair_corrections"] = pairs
