"""The corpus pipeline: documents to training tokens in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. All
but the last return rows with the columns of ``documents``; the last returns the
packed tokens, read back. Between stages the rows are written as Parquet, so a
lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundlake.llm.common import write_once
from fundlake.llm.decontaminate import decontaminate
from fundlake.llm.mixing import apply_mix, mix_copies
from fundlake.llm.quality import classify, graded, train
from fundlake.llm.simhash import keep_one, simhash_groups
from fundlake.llm.tokens import read_tokens, write_tokens


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the ordinal classifier rejects (toxic or poor)."""
    model = train(docs, graded(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return classify(docs, model, docs.columns).where("kept").select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each SimHash group, that of the smallest id."""
    return keep_one(docs, simhash_groups(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark, docs.columns).where("not contaminated").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat, cut and drop documents as the mix of their sources takes them, in
    training order. The packed tokens of the next stage stand by id again."""
    return apply_mix(docs, mix_copies(docs))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode, write bit-packed token files and read them back: doc_id, start,
    n_tokens, ids_crc32."""
    import public_tokenizers
    return read_tokens(write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), 49_408, 2))


STAGES = [("quality classifier", quality_classifier), ("simhash near-dedup", simhash_near_dedup),
          ("benchmark decontamination", benchmark_decontamination), ("mixing sources", mix_sources), ("token output", token_output)]
#: The classifier's weights and the fingerprints have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
