"""Toxicity scores from a factorization machine over hashed terms.

Terms are the hashes of a text's words and of the first five bytes of longer words (compounds of one stem
share a term). Their presence is scored by linear weights and by inner products of factors, so that pairs of
terms count beyond their sum. The machine is Spark MLlib's, fitted on at most about ``FIT_ROWS`` labelled
texts (chosen by a hash of the id) and on the ``TERMS`` terms that tell the labels apart best by the
likelihood-ratio statistic. All texts are then scored in whole, without a shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfade.llm.hashtable import HashTable
from crossfade.llm.tables import fold, gives_back, materialize, small_side, without_keys
from crossfade.llm.words import WORD, find_words, hash_spans, hash_sums, mix, text_blocks

FIT_ROWS = 20_000  # labelled texts that a fit takes, in expectation; a bound, whatever the labels table holds
TERMS = 4096  # terms that the machine weighs
LEAST_EVIDENCE = 15.0  # of the likelihood-ratio statistic, about four standard deviations
PREFIX = 5

_PREFIX_MARK = np.uint64(0xD6E8FEB86659FD93)


def text_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term, row), words first, then prefixes."""
    words = find_words(data, offsets, WORD)
    sums = hash_sums(data)
    long = words.end - words.start > PREFIX
    heads = hash_spans(sums, words.start[long], words.start[long] + PREFIX)
    term = np.concatenate([hash_spans(sums, words.start, words.end), mix(heads ^ _PREFIX_MARK)])
    return term, np.concatenate([words.row, words.row[long]])


def _distinct(value: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), by row."""
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return value[new], row[new]


def _term_counts(labelled: DataFrame) -> DataFrame:
    """(term, toxic, n): texts with and without the label that hold a term."""

    @gives_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy()
            for first, data, offsets in text_blocks(batch.column(1)):
                term, row = _distinct(*text_terms(data, offsets))
                for value in (0, 1):
                    found, n = np.unique(term[label[first + row] == value], return_counts=True)
                    yield pa.record_batch({"term": found.view(np.int64), "toxic": np.full(len(found), value, np.int32), "n": n})

    return labelled.select("toxic", "text").mapInArrow(count, "term long, toxic int, n long")


def _telling_terms(labelled: DataFrame, negatives: int, positives: int) -> np.ndarray:
    counts = _term_counts(labelled).groupBy("term").agg(
        F.sum(F.col("n") * (1 - F.col("toxic"))).cast("double").alias("n0"), F.sum(F.col("n") * F.col("toxic")).cast("double").alias("n1")
    )
    total = float(negatives + positives)
    both = F.col("n0") + F.col("n1")

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    evidence = 2 * (
        part(F.col("n0"), both * negatives / total)
        + part(F.col("n1"), both * positives / total)
        + part(negatives - F.col("n0"), (total - both) * negatives / total)
        + part(positives - F.col("n1"), (total - both) * positives / total)
    )
    best = counts.withColumn("evidence", evidence).where(F.col("evidence") >= LEAST_EVIDENCE)
    rows = best.orderBy(F.desc("evidence"), "term").limit(TERMS).select("term").collect()  # TERMS rows at most
    return np.array([r["term"] for r in rows], np.int64).view(np.uint64)


class Machine:
    """A fitted factorization machine, small enough to be sent anywhere."""

    def __init__(self, terms: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray) -> None:
        self.table = HashTable(terms, np.arange(len(terms), dtype=np.int64))
        self.bias, self.linear, self.factors = bias, linear, factors

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        term, row = text_terms(data, offsets)
        term, known = self.table.find(term)
        term, row = _distinct(term[known], row[known])
        rows = len(offsets) - 1
        total = self.bias + np.bincount(row, self.linear[term], rows)
        for factor in self.factors.T:
            each = factor[term]
            total += 0.5 * (np.bincount(row, each, rows) ** 2 - np.bincount(row, each**2, rows))
        return 1 / (1 + np.exp(-np.clip(total, -700, 700)))


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine for ``labels`` (doc_id, toxic 0 or 1; other values and null ids are passed over, an id with
    several labels is toxic if any is). Without both classes every text gets the share of label 1."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    kept = min(1.0, FIT_ROWS / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(kept * (1 << 20)) + 1)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(materialize(known)), "doc_id")
    labelled = materialize(texts.select("toxic", F.coalesce("text", F.lit("")).alias("text")))
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    negatives, positives = sizes.get(0, 0), sizes.get(1, 0)
    terms = _telling_terms(labelled, negatives, positives) if negatives and positives else np.zeros(0, np.uint64)
    if not len(terms):
        share = (positives + 1) / (negatives + positives + 2)
        return Machine(terms, float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, 0)))
    table = HashTable(terms, np.arange(len(terms), dtype=np.int64))

    @gives_back
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, data, offsets in text_blocks(batch.column(1)):
                term, row = text_terms(data, offsets)
                term, found = table.find(term)
                term, row = _distinct(term[found], row[found])
                rows += [part.astype(str).tolist() for part in np.split(term, np.searchsorted(row, np.arange(1, len(offsets) - 1)))]
            yield pa.record_batch({"toxic": batch.column(0), "terms": pa.array(rows, pa.list_(pa.string()))})

    chosen = labelled.select("toxic", "text").mapInArrow(choose, "toxic int, terms array<string>")
    vector = CountVectorizerModel.from_vocabulary([str(i) for i in range(len(terms))], inputCol="terms", outputCol="features", minTF=1.0)
    chosen = vector.setBinary(True).transform(materialize(chosen)).coalesce(8).cache()
    machine = FMClassifier(
        labelCol="toxic", featuresCol="features", factorSize=4, initStd=0.01, regParam=1e-4, maxIter=120, stepSize=0.1, tol=1e-5, seed=7
    ).fit(chosen)
    chosen.unpersist()
    return Machine(terms, machine.intercept, machine.linear.toArray(), machine.factors.toArray())


def score(docs: DataFrame, machine: Machine, key) -> DataFrame:
    """(key, score) of every row; null and empty texts get the bias."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sent.value.score(data, offsets) for _, data, offsets in text_blocks(batch.column(1))]
            yield pa.record_batch({"key": batch.column(0), "score": np.concatenate([np.zeros(0), *scores])})

    return docs.select(key.cast("long").alias("key"), "text").mapInArrow(run, "key long, score double")


def document_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Labels of held-out rows (crc32 of the id
    modulo 5 is 0) are not learnt from. A row without an id is scored, and not held out. Repeated rows each
    give a row; other columns are ignored."""
    machine = fit(docs, labels.where(~fold("doc_id", 0)))
    scored = score(docs, machine, F.col("doc_id"))
    return scored.select(
        F.col("key").alias("doc_id"),
        F.coalesce(fold("key", 0), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, row_key) -> DataFrame:
    """The documents that score below 0.5, by row: rows of one id are judged by their own texts. Columns as given,
    whatever their names."""
    machine = fit(docs, labels.where(~fold("doc_id", 0)))
    toxic = score(docs, machine, row_key).where("score >= 0.5").select("key").distinct()
    return without_keys(docs, row_key, materialize(toxic))
