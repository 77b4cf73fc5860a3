"""The named queries of this subpackage and their SQL, for the driver's entry module."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crossfade.llm import (
    context_tree,
    decontaminate,
    divergence,
    html_text,
    license_scan,
    mixing,
    ngram_join,
    pieces,
    token_files,
    toxicity,
    url_filter,
    vectors,
    whitening,
)
from crossfade.llm.tables import table


def tokenizer_file(name: str) -> str:
    """Where the installed package of public vocabularies keeps this file."""
    import public_tokenizers

    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.document_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op3_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op10_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.document_scores(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_token_files": op2_token_files,
        "op3_contamination": op3_contamination,
        "op4_near_vectors": op4_near_vectors,
        "op5_main_text": op5_main_text,
        "op6_url_filter": op6_url_filter,
        "op7_license_scan": op7_license_scan,
        "op8_pieces": op8_pieces,
        "op9_ngram_jaccard": op9_ngram_jaccard,
        "op10_context_tree": op10_context_tree,
        "op11_source_divergence": op11_source_divergence,
        "op12_source_mix": op12_source_mix,
        "op13_whitening": op13_whitening,
    }


def all_sql() -> dict[str, str]:
    from crossfade.llm import oracles

    return oracles.SQL
