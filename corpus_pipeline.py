"""The corpus pipeline: quality, line dedup, near-dedup, decontamination and packing, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.llm import common as C
from leadflow.llm.decontaminate import decontaminated
from leadflow.llm.line_dedup import line_dedup
from leadflow.llm.order_minhash import one_of_each
from leadflow.llm.packing import pack
from leadflow.llm.quality import accepted, train
from leadflow.llm.tokens import default_vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No SQL: the quality model is trained, and classes of near copies and packing are iterative.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of ids whose crc32 is not 1 modulo 3."""
    C.ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(C.crc_mod(F.col("doc_id"), 3) != 1)
    return accepted(docs, train(docs, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller document holds; ``n_chars`` follows the text."""
    C.ship(spark)
    out = line_dedup(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each class of copies and near copies."""
    C.ship(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without windows of benchmark items."""
    C.ship(spark)
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of the documents stand in the training sequences."""
    C.ship(spark)
    packed = pack(docs, default_vocabulary())
    return packed.select(C.public_id(), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = C.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
