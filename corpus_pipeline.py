"""The corpus pipeline: toxicity, near-duplicates, personal data, mixing, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import bpe, mixing, pii, simhash, toxicity
from loomtext.llm.common import discard, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled ones among ``docs``."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest doc_id."""
    return simhash.keep_one(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes format-preserving pseudonyms; every document stays."""
    return pii.pseudonymise(docs, count=None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's copies, cut at each source's word budget; a row for each copy."""
    return mixing.mix_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and digests of the ids and of what they decode to."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, ids="ids", decoded="decoded")
    ids, decoded = map(F.col, coded.columns[-2:])
    return coded.withColumns({
        "n_tokens": F.size(ids).cast("long"),
        "ids_sha256": F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256),
        "decoded_sha256": F.sha2(decoded, 256),
    }).drop(coded.columns[-1])


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", near_dedup),
    ("pii_pseudonyms", mask_pii),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenise),
]

#: Learned scores and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again before the next."""
    docs, paths = table(spark, sf_dir, "documents"), []
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name, paths)
            discard(spark, *paths[:-1])  # what the stage before has written
            paths = paths[-1:]
    return docs
