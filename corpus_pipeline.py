"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.arrow_rows import free_name
from tillcast.llm.decontaminate import drop_contaminated
from tillcast.llm.language import fit_languages, in_languages, language_sample
from tillcast.llm.mixing import in_mixed_order
from tillcast.llm.near_dedup import near_duplicates
from tillcast.llm.queries import table
from tillcast.llm.sharding import shard_documents
from tillcast.session import ensure_checkpoint_dir

#: A document goes if its best language leads by less than this share of the sample's median lead.
LEAST_MARGIN = 0.025


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; those without letters, or that no language claims, go.
    Each row is judged by its own text, so rows without doc_id, or with one in common, are too."""
    return in_languages(docs, fit_languages(language_sample(docs)), LEAST_MARGIN)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one of the smallest doc_id.

    Texts without a doc_id take part under a number made of their text, above all others; repeated
    rows (same doc_id, same text) are one document.  Texts without a word are linked with nothing."""
    name, digest = free_name(docs, "dedup_name"), free_name(docs, "dedup_digest")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    stand_in = F.shiftrightunsigned(text, 2).bitwiseOR(F.lit(1 << 62))
    named = docs.withColumns({name: F.coalesce(F.col("doc_id").cast("long"), stand_in), digest: text})
    gone = (near_duplicates(named.select(F.col(name).alias("doc_id"), "text"), size=5, percent=80).where("not kept")
            .select(F.col("doc_id").alias(name)).distinct())
    return named.join(gone, name, "left_anti").dropDuplicates([name, digest]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item, each row judged by its own text."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the files written hold it row by row."""
    return in_mixed_order(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its slot there; slots follow the order of the mix,
    which is the order of the rows in the files (by doc_id if ``docs`` is not read from files)."""
    try:
        ordered = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("_file"),
                              F.col("_metadata.row_index").alias("_row"))
        order = ["_file", "_row", "doc_id"]
    except AnalysisException:
        ordered, order = docs.select("doc_id", "text"), ["doc_id"]
    placed = shard_documents(ordered, slot_order=order)
    return placed


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("shard", shard)]

#: Kernel classification, minhash classes and edit distance are beyond SQL: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each writes lies in the shared checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
