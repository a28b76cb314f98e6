"""A corpus pipeline: language, lines, near copies, benchmark passages, mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindrift.llm.decontaminate import decontaminate
from spindrift.llm.language import keep_identified
from spindrift.llm.lines import drop_lines
from spindrift.llm.mixing import mix
from spindrift.llm.simhash import near_dedup
from spindrift.plans.scratch import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents hold stay in the newest one only."""
    return drop_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_dedup(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mix(docs)[0]


STAGES = [
    ("language id", identify_language),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_documents),
    ("benchmark decontamination", remove_benchmark),
    ("source mix", mix_sources),
]

#: SQL can't express the language model or the mix's schedule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read back by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
