import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from crossfade.llm import url_filter as U
from crossfade.llm.words import text_blocks

URLS = [
    "http://A.Example.NET/en/x?y=1&z=2#f", "https://example.net/en", "ftp://net/", "http://net", "x.net/", None, "", "://", "http://www.Example.com/de/1",
    "http://examplexcom/de/", "http://e.org/fr/?a/b", "http://org/fr/", "http://É.net/ü%20", "http://borg/fr/", "http://e.org?x=/fr/", "a://b://c.net/",
]


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fits = [(len(r), r, v) for v, r in U.RULES for n, _, p in [r.partition("/")] if (host == n or host.endswith("." + n)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def test_rules_and_parts(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[0], "y"), (0, URLS[0], "x")]
    got = U.verdicts(spark.createDataFrame(rows, "page_id long, url string, score string")).collect()
    assert len(got) == len(rows)
    for row in got:
        host, path = split(URLS[row["page_id"] or 0])
        name, verdict = rule(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, name)
        assert row["verdict"] == (verdict or ("block" if row["score"] >= 0.5 else "allow"))
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.verdicts(none).count() == 0


def test_features():
    for lo, data, offsets in text_blocks(pa.array(URLS)):
        values = U._features(data, offsets)
        for url, row in zip(URLS[lo:], values, strict=True):
            url = (url or "").encode()
            at = url.find(b"://")
            rest = url[at + 3 :] if at >= 0 else b""
            host = re.match(rb"[^/?#]*", rest)[0]
            path = re.match(rb"[^?#]*", rest[len(host) :])[0]
            tail = rest[len(host) + len(path) :]
            named = dict(zip(U.LEXICAL, row, strict=True))
            assert (named["host_length"], named["path_length"], named["query_length"]) == (len(host), len(path), len(tail))
            assert (named["depth"], named["parameters"]) == (path.count(b"/"), tail.count(b"="))
            n = Counter(url)
            assert named["entropy"] == pytest.approx(-sum(c / len(url) * math.log2(c / len(url)) for c in n.values()))
            assert (named["secure"], named["fragment"]) == (float(at == 5), float(b"#" in url))


def test_held_out_accuracy(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(1500):
        bad = i % 2
        name = "".join(rng.choice(list("abcdefgh0123456789" if bad else "abcdefgh"), 12))
        rows.append((i, f"http://{name}.info/" + ("/".join("x" * rng.integers(1, 4)) if bad else "page") + ("?a=1&b=2" if rng.random() < 0.5 else ""), bad))
    df = spark.createDataFrame(rows, "page_id long, url string, label int")
    got = U.verdicts(df, labels=df.where("page_id < 1000").select("url", "label")).where("page_id >= 1000").collect()
    assert sum((r["verdict"] == "block") == bool(r["page_id"] % 2) for r in got) / len(got) > 0.95
