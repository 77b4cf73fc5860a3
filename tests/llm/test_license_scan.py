import re

from crossfade.llm import license_scan as L

TEXTS = [
    "Licensed under CC BY-NC 4.0.", "cc by cc by, all RIGHTS\nreserved", "", None, "Released under the very MIT License. x",
    "Released under the MIT License, Released under the MIT license", "GNU General Public License", "general public", "cc", "...", "ÜBER cc·by cc-by",
    "This work is licensed under the new GNU General Public License, version 3. " * 3, "word " * 5000 + "All rights reserved", "under the mit license",
]


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def places(w):
    return sorted(i for p in L.BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split())


def licenses(w):
    """Labels by voting over dictionaries."""
    out = {}
    for label, text in L.TEMPLATES:
        t = text.split()
        grams = [t[i : i + 3] for i in range(len(t) - 2)]
        votes = sorted((p - i, i, p) for p in range(len(w) - 2) for i, g in enumerate(grams) if w[p : p + 3] == g)
        while votes:
            span = [votes.pop(0)]
            while votes and votes[0][0] - span[-1][0] <= L.GAP:
                span.append(votes.pop(0))
            share = len({i for _, i, _ in span}) / len(grams)
            length = max(p for *_, p in span) - min(p for *_, p in span) + 3
            if share >= L.LEAST_SHARE and length <= len(t) + 2 * L.GAP:
                out[label] = max(share, out.get(label, 0))
    return out


def test_scan_equals_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "y"), (None, TEXTS[1], "z")]
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string, label string")).collect()
    assert len(got) == len(rows)
    expected = []
    for i, text, _ in rows:
        w = words(text)
        at, found = places(w), licenses(w)
        base = sorted({label for p, label in L.BASE.items() if any(w[j : j + len(p.split())] == p.split() for j in range(len(w)))})
        score = 1.0 if at else max(found.values(), default=0.0)
        expected.append((i, len(w), len(at), at[0] if at else None, at[-1] if at else None, ",".join(base), ",".join(sorted({*base, *found})), score))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_spans_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b Released under the MIT License c")], "doc_id long, text string")
    row = L.find_licenses(df).first()
    assert (row["label"], row["first_word"], row["last_word"], row["share"]) == ("mit", 2, 6, 1.0)
    assert L.scan(df.limit(0)).count() == 0


def test_only_ascii_is_lower_cased(spark):
    text = "This wor\u212a IS \u00c9"  # KELVIN SIGN is no k
    words = spark.createDataFrame([(text,)], "text string").select(L.words_of()).first()[0]
    assert words == ["this", "wor\u212a", "is", "\u00c9"]
