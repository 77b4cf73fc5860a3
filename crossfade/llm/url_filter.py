"""URL verdicts: rules where they fit, gradient-boosted trees on lexical features elsewhere.

The trees are Spark MLlib's. They see lengths, depth, digit ratio, entropy, counts of parameters and marks,
and statistics of the host's suffixes (how common, and how often blocked among labelled URLs). They learn from
labelled URLs, by default those that the rules judge: at most about ``FIT_ROWS`` of them, chosen by a hash of the
URL. A labelled URL's own suffix statistic is taken from the other half of the labels, so that the trees do
not learn to read a label off it.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfade.llm.html_text import host_of
from crossfade.llm.tables import materialize
from crossfade.llm.words import text_blocks

FIT_ROWS = 20_000  # labelled URLs that a fit takes, in expectation
PRIOR = 5.0  # labels' worth of the overall share that smooths a suffix's own

# The rules of the query; the longest that fits wins.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

LEXICAL = [
    "length", "host_length", "path_length", "query_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio", "capital_ratio",
    "entropy", "host_entropy", "parameters", "hyphens", "host_hyphens", "marks", "escapes", "secure", "fragment",
]
SUFFIX = ["suffix_common", "suffix_blocked", "domain_common", "domain_blocked"]


def path_of(url: str = "url") -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules=RULES, host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one. Of equal rules, the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    distinct = {text: decision for decision, text in reversed(rules)}
    for text, decision in sorted(distinct.items(), key=lambda r: len(r[0])):
        name, _, rest = text.partition("/")
        fits = ((F.col(host) == name) | F.col(host).endswith("." + name)) & F.col(path).startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The lexical features of each URL, a row each."""
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(offsets))
    place = np.arange(len(data)) - offsets[row]
    far = np.iinfo(np.int64).max

    def first(mask: np.ndarray) -> np.ndarray:
        at = np.full(rows, far)
        np.minimum.at(at, row[mask], place[mask])
        return at

    size = np.diff(offsets)
    colon = np.zeros(len(data), bool)
    if len(data) > 2:
        colon[:-2] = (data[:-2] == 58) & (data[1:-1] == 47) & (data[2:] == 47) & (row[:-2] == row[2:])
    scheme = first(colon)
    begin = np.where(scheme < far, scheme + 3, size)
    after = place >= begin[row]
    end = np.minimum(first(after & np.isin(data, [47, 63, 35])), size)
    tail = np.minimum(first(after & np.isin(data, [63, 35])), size)
    in_host, in_path, in_tail = after & (place < end[row]), after & (place >= end[row]) & (place < tail[row]), place >= tail[row]
    digit, capital = (data >= 48) & (data <= 57), (data >= 65) & (data <= 90)

    def count(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row[mask], minlength=rows).astype(float)

    def entropy(mask: np.ndarray) -> np.ndarray:
        cell, n = np.unique(row[mask] * 256 + data[mask], return_counts=True)
        total = np.maximum(count(mask), 1)
        share = n / total[cell // 256]
        return np.bincount(cell // 256, -share * np.log2(share), rows)

    host, path = count(in_host), count(in_path)
    every = np.ones(len(data), bool)
    columns = [
        size, host, path, count(in_tail), count(in_path & (data == 47)), count(in_host & (data == 46)) + (host > 0),
        count(digit) / np.maximum(size, 1), count(digit & in_host) / np.maximum(host, 1), count(capital) / np.maximum(size, 1),
        entropy(every), entropy(in_host), count(in_tail & (data == 61)), count(data == 45), count(in_host & (data == 45)),
        count(np.isin(data, [95, 126, 64, 58])), count(data == 37),
        (scheme == 5).astype(float), (first(data == 35) < far).astype(float),
    ]
    return np.column_stack(columns).astype(np.float64)


def lexical(urls: DataFrame) -> DataFrame:
    """The rows (key, url, host, path, ...) with the lexical features as columns. Null is the empty URL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, data, offsets in text_blocks(batch.column("url")):
                values = _features(data, offsets)
                rows = batch.slice(lo, len(values))
                yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(v) for v in values.T.copy())], [*batch.schema.names, *LEXICAL])

    fields = [T.StructField(name, T.DoubleType()) for name in LEXICAL]
    return urls.mapInArrow(run, T.StructType([*urls.schema.fields, *fields]))


def _suffix_statistics(labelled: DataFrame, every: DataFrame, by: str) -> DataFrame:
    """(by, common, n0, b0, n1, b1): log count of URLs with the suffix, and labels and blocks by half."""
    half = F.col("half")
    stats = labelled.groupBy(by).agg(
        *(F.sum((half == h).cast("double")).alias(f"n{h}") for h in (0, 1)),
        *(F.sum(F.when(half == h, F.col("label")).otherwise(0.0)).alias(f"b{h}") for h in (0, 1)),
    )
    return every.groupBy(by).agg(F.log1p(F.count("*")).alias("common")).join(stats, by, "left").fillna(0.0, ["n0", "n1", "b0", "b1"])


def verdicts(pages: DataFrame, rules=RULES, labels: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (the trees' probability of block).

    ``labels`` (url, label 1 for block) are further labelled URLs; URLs under a rule are always labelled by it. With one
    class or none to learn from, every score is the share of blocks (0 without labels). Null URLs and URLs without
    ``://`` have an empty host and path and are judged by the trees. Repeated rows each give a row.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"))
    rows = _parts(rows.select("page_id", "url", host_of().alias("host"), path_of().alias("path")))
    rule, verdict = rule_of(rules)
    rows = materialize(rows.withColumn("rule", rule).withColumn("ruled", verdict))
    known = rows.where("ruled is not null").select("url", "suffix", "domain", (F.col("ruled") == "block").cast("double").alias("label"))
    if labels is not None:
        more = labels.where("url is not null and label in (0, 1)").select("url", F.col("label").cast("double").alias("label"))
        more = _parts(more.withColumn("host", host_of()))
        known = known.unionByName(more.select("url", "suffix", "domain", "label"))
    known = known.withColumn("half", F.pmod(F.xxhash64("url"), F.lit(2)))
    n, blocked = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    share = blocked / n if n else 0.0
    if blocked in (0, n):
        scored = rows.withColumn("score", F.lit(float(share)))
        return _answer(scored)
    by_suffix, by_domain = (_suffix_statistics(known, rows, by) for by in ("suffix", "domain"))

    def with_statistics(df: DataFrame, own_half: bool) -> DataFrame:
        for name, stats in (("suffix", by_suffix), ("domain", by_domain)):
            df = df.join(stats, name, "left").fillna(0.0, ["common", "n0", "n1", "b0", "b1"])
            other = [F.when(F.col("half") == 0, F.col(f"{c}1")).otherwise(F.col(f"{c}0")) if own_half else F.col(f"{c}0") + F.col(f"{c}1") for c in "nb"]
            df = df.withColumn(f"{name}_common", F.col("common")).withColumn(f"{name}_blocked", (other[1] + PRIOR * share) / (other[0] + PRIOR))
            df = df.drop("common", "n0", "n1", "b0", "b1")
        return df

    kept = min(1.0, FIT_ROWS / n)
    chosen = known.where(F.pmod(F.xxhash64("url", F.lit("fit")), F.lit(1 << 20)) < int(kept * (1 << 20)) + 1)
    vector = VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="features")
    fitting = vector.transform(materialize(with_statistics(lexical(chosen), True))).select("label", "features").coalesce(8).cache()
    if fitting.select("label").distinct().count() < 2:
        return _answer(rows.withColumn("score", F.lit(float(share))))
    trees = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, maxBins=64, seed=5, cacheNodeIds=False).fit(fitting)
    fitting.unpersist()
    scored = trees.transform(vector.transform(with_statistics(lexical(rows), False)))
    return _answer(scored.withColumn("score", vector_to_array("probability")[1]))


def _parts(rows: DataFrame) -> DataFrame:
    """With the host's last label and last two labels."""
    return rows.withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("domain", F.substring_index("host", ".", -2))


def _answer(scored: DataFrame) -> DataFrame:
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
