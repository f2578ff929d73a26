"""The corpus cleaning pipeline: toxicity, SimHash near-duplicates, repeated
passages, benchmark contamination, tokens.

Every stage reads the whole table that its predecessor left, written as
Parquet, and drops or changes documents for good."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewgate.llm.bpe import encode_texts
from reviewgate.llm.common import stored, table
from reviewgate.llm.decontaminate import drop_contaminated
from reviewgate.llm.queries import VOCABULARY
from reviewgate.llm.simhash_dedup import drop_near_duplicates
from reviewgate.llm.substring_dedup import drop_repeated_units
from reviewgate.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3; labels of held-out rows are not read."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (four-word shingles, four bits)."""
    return drop_near_duplicates(docs, shingle_words=4, max_bits=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines and passages stay only where they come first, word for word."""
    return drop_repeated_units(docs, min_words=5, extend=True)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``token_ids`` and ``decoded_sha256``, the digest of the text decoded from them."""
    return encode_texts(docs, VOCABULARY, decoded=True)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", contamination),
    ("bpe", tokens),
]

#: Learned scores, XXH64 fingerprints and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, f"pipeline-{name}")
    return docs
