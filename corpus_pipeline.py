"""The corpus pipeline: documents to a mixed training set, each stage one operator.

``run`` chains the stages lazily; a scheduler that writes each stage's rows as Parquet and reads them again gets the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markbook.llm.decontaminate import decontaminate
from markbook.llm.frames import Shared, read
from markbook.llm.jaccard_join import keep_one_of_each
from markbook.llm.line_dedup import line_dedup
from markbook.llm.mixing import mix_sources
from markbook.llm.quality import quality_scores


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled rows outside the held-out fold."""
    scored = quality_scores(spark, docs, read(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines, short ones included. One that loses every line goes, as all of it stands in earlier ones."""
    deduped = line_dedup(spark, docs, short_repeats=True)
    left = deduped.where("n_dropped = 0 or n_dropped < n_lines")
    return left.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id."""
    return keep_one_of_each(spark, docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(spark, docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents and their order in the mix."""
    return mix_sources(spark, docs)


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("ngram_jaccard", near_duplicates), ("decontamination", benchmark), ("source_mixing", mixing)]

# Neither the trained classifier nor the edit matching can be stated in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = Shared(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
