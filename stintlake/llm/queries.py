"""The registered queries of this subpackage, over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, jaccard_join, langid, licenses, multiset_hash, prefix_trie, quality, spelling, substring_dedup, suffix_dedup, token_files, toxicity
from .common import table


def _vocab(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and what they decode to."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), _vocab("byte_bpe_50k.json"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices in every document, by canonical digest."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by nearest centroid."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers, units or names."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that no repeated string of 400 bytes covers."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as Simple-8b files and read back."""
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), _vocab("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(files)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality probability of every document, learned from its labelled part."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprints of every document and of its edited text."""
    return multiset_hash.with_edited(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that no earlier document's 13 words cover."""
    return substring_dedup.dedup_digests(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, with totals over subtrees."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity probability of every document, learned from its labelled part."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, the words one edit away, and the form they are variants of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_licenses": op2_licenses,
    "op3_language": op3_language,
    "op4_decontaminate": op4_decontaminate,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_token_files": op6_token_files,
    "op7_quality": op7_quality,
    "op8_jaccard": op8_jaccard,
    "op9_fingerprints": op9_fingerprints,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_toxicity": op12_toxicity,
    "op13_spelling_variants": op13_spelling_variants,
}

#: DuckDB twins; the other queries are tested against brute force in tests/llm.
SQL: dict[str, str] = {
    "op2_licenses": licenses.oracle_sql(),
    "op10_substring_dedup": substring_dedup.oracle_sql(),
    "op11_prefix_trie": prefix_trie.oracle_sql(),
    "op13_spelling_variants": spelling.oracle_sql(),
}
