"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsieve.llm import decontaminate, language, line_dedup, near_dedup, packing
from netsieve.llm.columns import free_name
from netsieve.llm.store import stored


def _beside(docs: DataFrame, *results: str) -> tuple[DataFrame, list]:
    """``docs`` with its columns named like a result moved out of the way, and what restores them all."""
    moved, back = docs, []
    for name in docs.columns:
        own = name
        if name.lower() in results:
            own = free_name(moved, f"own_{name}")
            moved = moved.withColumnRenamed(name, own)
        back.append(F.col(f"`{own}`").alias(name))
    return moved, back


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those without text or letters go.

    Those of which the filters know no n-gram go too, unless no language was learned.
    """
    return language.drop_unrecognised(docs, language.fit_languages(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of three-line passages; texts that lose all their lines go.

    ``n_chars`` follows the text, all other columns stay as they are, whatever their names.
    """
    rows, back = _beside(docs, "n_lines", "n_removed")
    cut = line_dedup.drop_repeated_lines(rows)
    kept = cut.where("n_removed = 0 or n_removed < n_lines").withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*back)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates.

    Rows are told apart by a stored number, so of rows that repeat an id each is judged by its
    own text, and of exact repeats one stays; a row without an id gives way to one with an id.
    """
    row = free_name(docs, "row_id")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    gone = near_dedup.near_duplicates(rows, row_col=row).where("not chosen").select(row)
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item; their columns stay as they are."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, back = _beside(docs, "n_words", "hit_words", "items", "spans")
    return decontaminate.find_passages(rows, items).where(F.size("hit_words") == 0).select(*back)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Language models and signatures are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
