"""A corpus cleaned and packed by five of the operators, one after the other.

Each stage gets what its predecessor kept, written as Parquet and read again. All but
the last return the columns of their input, so further columns survive up to packing.
Edge cases are those of the operators: see their modules.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import linededup, minhash, packing, quality, toxicity
from tillflow.session import shared_path


def _same(docs: DataFrame, out: DataFrame) -> DataFrame:
    return out.select(*[f"`{c}`" for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current rule policy keeps."""
    return _same(docs, quality.keep_good(docs))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model is learned from the labelled ones among them."""
    return _same(docs, toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that other documents repeat."""
    rest = [c for c in docs.columns if c != "text"]
    packed = docs.select("doc_id", "text", F.struct(*[f"`{c}`" for c in rest]).alias("__own"))
    out = linededup.line_dedup(packed)
    return out.select(*[F.col("text") if c == "text" else F.col(f"__own.`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return _same(docs, minhash.keep_one(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("toxicity", toxicity_filter), ("line dedup", line_dedup),
          ("minhash near-dedup", near_dedup), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        path = shared_path(spark, "pipeline", str(k))
        out.write.parquet(path)
        docs = spark.read.parquet(path)


#: Toxicity and packing have no SQL; tests/llm hold the pipeline against a brute-force version.
ORACLE_SQL = None
