"""Documents to packed training sequences: language, lines, near copies, benchmark, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and read again as the next one's ``docs``. All but the last return
the columns of their input; ``n_chars``, where it exists, follows the text.

Cases are those of the operators: a null text, or one without a letter, has
no language and goes; empty tables pass through all stages; other columns stay
as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricekit.llm import decontaminate, language, line_dedup, packing, prob_minhash
from pricekit.llm._stage import staged


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language learned from the labelled ones; ``und`` and those as far from all as random letters go."""
    learned = language.prototypes(docs)
    whole = docs.select(F.struct("*").alias("doc"))
    found = whole.withColumn("found", language.predict_language(learned, F.col("doc.text")))
    near = language.is_near(F.col("doc.text"), F.col("found.score"))
    return found.filter((F.col("found.lang_pred") != language.UNKNOWN) & near).select("doc.*")


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that resemble each other only the first stays; documents that lose every line go."""
    left = line_dedup.keep_first_lines(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return left


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return prob_minhash.one_of_each(prob_minhash.near_duplicate_classes(docs))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in training sequences."""
    return packing.pack(packing.tokenised_pieces(docs))


STAGES = [
    ("language", known_language),
    ("lines", distinct_lines),
    ("near copies", distinct_documents),
    ("benchmark", no_benchmark),
    ("packing", packed),
]

# Signatures, language vectors and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"), texts=True)
    return docs
