"""From raw documents to packed training bins, in five stages.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``; other
columns of ``docs``, whatever their names, are left out. Null ids, sources,
languages and texts and repeated rows go through as any other rows; every stage
gives an empty result for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starforge.llm.classifier import score_quality
from starforge.llm.line_dedup import drop_common_lines
from starforge.llm.mixing import mix_sources
from starforge.llm.near_dup import drop_near_duplicates
from starforge.llm.packing import pack_documents
from starforge.session import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def with_length(docs: DataFrame) -> DataFrame:
    """The columns of documents, ``n_chars`` being the length of the text."""
    return docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score >= 0.3), in one pass.

    Null and empty texts are scored as texts without features. Labels that are
    missing or not 0 or 1 are not learned from; without any that can be, all
    documents have one score and share one verdict."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = score_quality(docs, labels, carry=COLUMNS[1:])
    return judged.filter("predicted = 1").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents are dropped; every document stays.

    A text that loses all its lines, and a null one, comes back empty, with
    ``n_chars`` 0."""
    return with_length(drop_common_lines(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id.

    Null ids come last; of rows that repeat an id one stays. Documents without
    words are no copies of each other and all stay."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes of it: the words taken
    over its size, rounded. Documents without words stay out; those without a
    source are a source of their own, served last."""
    mixed = mix_sources(docs.select(*COLUMNS))
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    mixed = mixed.filter("size > 0").withColumn("copies", copies).filter("copies > 0")
    return mixed.select(*COLUMNS, F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document, copies in different bins: a row per piece of at
    most a bin's capacity, as ``pack_documents`` returns it."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_lines),
    ("near_dedup", one_of_each_group),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Neither the classifier nor the near-duplicate search can be said in SQL.
ORACLE_SQL = None
