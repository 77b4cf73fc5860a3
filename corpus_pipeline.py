"""The corpus pipeline: documents in; toxic, near-duplicate and benchmark-holding ones out; the rest encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows the one before it kept. All but the last return
the columns of ``documents``; the last adds ``pieces`` (sampled SentencePiece ids) and ``n_pieces``, and its
``text`` is what the pieces decode to.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfade.llm import decontaminate, ngram_join, pieces, toxicity
from crossfade.llm.queries import tokenizer_file
from crossfade.llm.tables import materialize, small_batches, table

ROWS = 250  # handed to a worker at once: batches of about 1 MB, which both sides take from what they hold already


def _begin(spark: SparkSession) -> None:
    """Small batches, and no broadcasts of the stage before: executors hold those until the driver collects what
    it no longer refers to, and by itself it does so after half an hour."""
    small_batches(spark, ROWS)
    spark.sparkContext._jvm.System.gc()


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below 0.5."""
    labels = table(spark, sf_dir, "labels")
    _begin(spark)
    return toxicity.drop_toxic(docs, labels, decontaminate.row_key())


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles with a Jaccard similarity of 0.8 or more, the smallest id."""
    _begin(spark)
    return ngram_join.keep_one(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    benchmark = table(spark, sf_dir, "benchmark")
    _begin(spark)
    return decontaminate.drop_contaminated(docs, benchmark)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of each text, and the text they decode to."""
    model = tokenizer_file("piece_bpe_32k.model")
    _begin(spark)
    return pieces.encode(docs, model, decoded="text").withColumn("n_pieces", F.size("pieces").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pieces", encode_pieces),
]

# The first stage's learnt scores and the last one's draws have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
