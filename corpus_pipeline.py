"""From raw documents to packed training sequences, in five stages.

Every stage works on all that the one before it kept; all but the last return the columns
of ``documents``, with n_chars brought up to date where the text changes.

Defined edge cases: a null or empty text has no words, so the quality rules reject it; null ids are
kept as they are; of repeated rows one stays; extra columns of any name pass through; an empty table,
also one that a stage has emptied, gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from siteweave.llm import decontaminate, packing, pii, quality, simhash
from siteweave.llm.queries import pseudonym_key
from siteweave.plans.store import written


def _measured(docs, columns):
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(columns) if "n_chars" in columns else docs.select(columns)


def quality_stage(spark, docs, sf_dir):
    """Documents that a quality rule rejects go."""
    return quality.keep_good(docs)


def near_copy_stage(spark, docs, sf_dir):
    """One document of each group of near copies stays (five-word shingles, similarity 0.8)."""
    return simhash.keep_one(docs)


def decontamination_stage(spark, docs, sf_dir):
    """Passages of the benchmark are taken out of the texts."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _measured(decontaminate.cleaned(docs, benchmark), docs.columns)


def private_data_stage(spark, docs, sf_dir):
    """Private values are replaced by pseudonyms of the same format."""
    return _measured(pii.pseudonymised(docs, pseudonym_key(spark)), docs.columns)


def packing_stage(spark, docs, sf_dir):
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicate documents", near_copy_stage),
    ("benchmark decontamination", decontamination_stage),
    ("private data", private_data_stage),
    ("packing", packing_stage),
]

#: The near-copy, pseudonym and packing stages can't be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after the other over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
