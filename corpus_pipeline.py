"""A corpus pipeline over ``documents``: each stage is written and read again before the next.

Toxic documents go, repeated lines go, one document of each near-duplicate group stays, documents
with benchmark passages go, and what is left is packed into training sequences.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import decontamination, jaccard, lines, packing, toxicity
from salesflow.llm.queries import table, tokenizer_path, toxicity_model
from salesflow.session import stage

# SQL can't express the trained classifier of the first stage; tests compare every stage with
# brute force instead.
ORACLE_SQL = None

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model does not reject; the model learns from the labels."""
    corpus = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(corpus, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(*COLUMNS), model)
    return scored.filter(F.col("__score") < toxicity.THRESHOLD).drop("__score")


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with a place per row (__file, __row): doc_ids may be null or repeated.

    Rows of stored tables have one already, the file and the row's number in it, which every scan gives alike.
    Other rows are numbered and stored.
    """
    try:
        return docs.select(*COLUMNS, F.xxhash64("_metadata.file_path").alias("__file"),
                           F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:  # no stored table
        own = docs.select(*COLUMNS, F.lit(0).cast("long").alias("__file"), F.monotonically_increasing_id().alias("__row"))
        return stage(own, "numbered")


PLACE = ["__file", "__row"]


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that stand in three or more of them, but for the last one.

    Every row is a document of its own, also where doc_ids are null or repeated; the line stays in the largest doc_id
    (null is smaller than any other). A document that loses every line stays, with an empty text.
    """
    rows = numbered(docs).select(*COLUMNS, F.xxhash64(*PLACE).alias("__key"))
    kept = lines.drop_lines(rows, row="__key").select(*COLUMNS)
    return kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                           .otherwise(F.length("text").cast("bigint")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles: the one with the smallest doc_id.

    A null doc_id is larger than any other; of equal doc_ids one row stays. Documents without a
    word are linked to nothing and stay.
    """
    rows = numbered(docs)
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", *PLACE)
    groups = jaccard.near_duplicates(rows.select(key.alias("doc_id"), "text"))
    others = groups.filter("doc_id.__file <> component_id.__file OR doc_id.__row <> component_id.__row").select(
        *[F.col(f"doc_id.{c}").alias(c) for c in PLACE])
    return rows.join(others, PLACE, "left_anti").select(*COLUMNS)


def drop_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any passage of the benchmark, row by row."""
    rows = numbered(docs)
    found = decontamination.contamination(rows.select(F.struct(*PLACE).alias("doc_id"), "text"),
                                          table(spark, sf_dir, "benchmark"))
    hit = found.filter("contaminated").select(*[F.col(f"doc_id.{c}").alias(c) for c in PLACE])
    return rows.join(hit, PLACE, "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences, in token ids."""
    return packing.pack_documents(docs, tokenizer=tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_benchmark_documents),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``; what lies between two stages is stored."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
