"""A corpus from raw documents to token ids: five stages, each stored before the next one reads it.

Every stage works on all rows that the one before kept. All but the last return documents with the columns they came
with. Defined results: null texts go through as empty texts do; rows that share an id are one document where a stage
keeps one of a group; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkledger.llm import byte_bpe, covering, decontaminate, exact_dedup, quality
from sparkledger.llm.common import key_of, lower_ascii, prepare, store, table
from sparkledger.llm.queries import BYTE_PATTERN, BYTE_RANKS

# SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """These names with underscores before them until no column of `docs` has them."""
    taken, before = {c.lower() for c in docs.columns}, "_"
    while any(before + n in taken for n in names):
        before += "_"
    return [before + n for n in names]


def _of(docs: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """Rows of `docs` whose id is (left_semi) or is not (left_anti) among the chosen ones, with all their columns."""
    one, right = _unused(docs, "chosen", "right")
    ids = chosen.select(F.col("doc_id").alias(one)).distinct()
    ids = ids.withColumn(right, key_of(one))
    here = (key_of() == F.col(right)) & F.col("doc_id").eqNullSafe(F.col(one))
    return docs.join(ids.hint("shuffle_hash"), here, how)


def quality_filter(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality.fit_quality(docs, table(prepare(spark), folder, "labels"))
    return docs.filter(model.column(F.col("text")) >= quality.THRESHOLD)


def exact_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal ones."""
    found = exact_dedup.exact_dedup(docs)
    one, sha, right = _unused(docs, "kept", "sha", "right")
    kept = found.filter("kept").select(F.col("doc_id").alias(one), F.col("text_sha256").alias(sha), key_of().alias(right))
    same = (key_of() == F.col(right)) & F.col("doc_id").eqNullSafe(F.col(one))
    texts = docs.join(kept.hint("shuffle_hash"), same)
    texts = texts.filter(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256) == F.col(sha))
    # Rows that repeat both id and text are one document; they are side by side already.
    return texts.dropDuplicates([right, one, sha]).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id."""
    found = covering.near_duplicates(docs)
    return _of(docs, found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))), "left_semi")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    found = decontaminate.decontaminate(docs, table(spark, folder, "benchmark"))
    return _of(docs, store(found.filter("contaminated").select("doc_id"), "contaminated"), "left_anti")


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents' token ids (`ids`, little-endian unsigned 32-bit integers), their counts and digests, and the digest of what they decode to."""
    return byte_bpe.bpe_round_trip(docs, BYTE_RANKS, BYTE_PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level bpe", token_ids),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(prepare(spark), folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, folder), "pipeline-" + name.split()[0])
    return STAGES[-1][1](spark, docs, folder)
