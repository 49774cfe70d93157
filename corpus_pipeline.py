"""The corpus pipeline: language identification, exact dedup, SimHash near-dedup, benchmark decontamination, SentencePiece ids.

Each stage works on what its predecessor wrote and read back as Parquet, in the folder that the cluster shares. The first four
return the columns of documents; the last one returns token ids.

All stages keep extra columns, whatever their names, give an empty table for an empty one, and take texts of any length. Rows that are equal
in all columns are rows of their own to the first and the fourth stage; of such copies the second keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventweir.llm._shared import materialise, table
from eventweir.llm.decontaminate import drop_contaminated
from eventweir.llm.exact_dedup import drop_exact_copies
from eventweir.llm.language_id import keep_identified
from eventweir.llm.near_copies import one_of_alike
from eventweir.llm.unigram import encode


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, null and empty ones among them, and those no language of which reaches the threshold go. Null and repeated ids
    don't matter; a null language or source says nothing."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays, a null id being smaller than any; of several such rows the one with the smallest hash of its
    columns. Null and empty texts are equal."""
    return drop_exact_copies(docs, keep="largest")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by five-word Jaccard similarities of 0.8 or more the row with the smallest id stays, null ids last. Texts without words
    are alike. Candidates come from SimHash fingerprints by pigeonring chains; each is verified on its shingles."""
    return one_of_alike(docs, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go. Null texts stay, as do all if the benchmark has no
    words."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), n=10)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, n_bytes_spelt and lossless of each row; a null text has no ids."""
    import public_tokenizers

    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Fingerprints, Viterbi paths and a fitted classifier can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
