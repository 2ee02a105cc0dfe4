"""A training corpus from `documents`: toxic documents go, one of each group of near copies stays, repeated passages are
cut, sources are mixed to their weights, and what is left is encoded.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.  run() writes each stage's
rows as Parquet in the shared folder and reads them back as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellspark.llm import bpe, mixing, neardup, substrings, toxicity
from cellspark.llm.common import stored, table

#: The toxicity model and the suffix arrays have no SQL form.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.dedup(docs, size_col="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a taken copy: doc_id, n_tokens, digests of ids and of the decoded bytes, ids."""
    import public_tokenizers

    return bpe.encode_documents(docs, bpe.tokenizer_path(), public_tokenizers.PATTERN, ids=True, tight=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i + 1}")
    return docs
