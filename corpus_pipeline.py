"""From raw documents to packed training bins, in five stages.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.language import predicted_language
from marlstone.llm.mixing import mixed_documents
from marlstone.llm.packing import pack_documents
from marlstone.llm.quality import quality_score
from marlstone.llm.queries import QUALITY_THRESHOLD, language_model, quality_model
from marlstone.llm.simhash import without_near_copies
from marlstone.llm.storage import store


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    labels = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/labels.parquet")
    model = quality_model(docs, labels)
    return docs.where(quality_score(model, F.col("text")) >= QUALITY_THRESHOLD)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to the centroid of a language."""
    model = language_model(docs)
    return docs.where(~predicted_language(model, F.col("text"))["rejected"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of every piece of every document."""
    return pack_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("language", keep_known_languages),
    ("near_copies", drop_near_copies),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = store(docs)
    return docs


# SimHash values and learnt models have no SQL form.
ORACLE_SQL = None
