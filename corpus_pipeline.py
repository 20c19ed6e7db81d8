"""From raw documents to packed training sequences, one operator a stage.

Each stage reads what the one before it wrote. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditpath.config import shared_dir
from creditpath.llm import langid, near_dups, packing, pii, quality
from creditpath.llm.common import cut, read_table
from creditpath.llm.queries import RANKS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep.

    Null, empty and short texts fail the base rules and go; repeated rows and
    those without an id are judged by their texts. No documents give none.
    """
    judged = quality.judge_documents(docs.select(*COLUMNS), read_table(spark, sf_dir, "labels"))
    return judged.where(F.col("kept")).select(*COLUMNS)


#: A language's probability from which on a document is kept.
MIN_LANGUAGE_SCORE = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; lang becomes the predicted one.

    The trees learn from the texts and languages of this stage's own input. A
    text without a letter, between languages, or unlike any of them goes;
    without a language to learn from, all do. Repeated rows and null ids stay.
    """
    found = langid.identify(docs.select(*COLUMNS), langid.learn(docs.select("text", "lang")))
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; repeated rows count as one.

    Of a group's documents without an id one stays too, the first by a hash of
    its text; those without words all stay. Different texts with one id stay if
    any of them does.
    """
    groups = cut(near_dups.grouped_rows(docs))
    first = groups.where(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    named = docs.select(*COLUMNS).where(F.col("doc_id").isNotNull())
    kept = named.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*COLUMNS)
    lone = groups.where(F.col("doc_id").isNull())
    nameless = docs.select(*COLUMNS).where(F.col("doc_id").isNull()).withColumn("_at", near_dups.text_hash())
    of_group = lone.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("at").alias("_at")).select("_at")
    wordless = lone.where(F.col("root").isNull()).select(F.col("at").alias("_at")).distinct()
    once = nameless.join(of_group, "_at", "left_semi").dropDuplicates(["text"])
    alone = nameless.join(wordless, "_at", "left_semi")
    return kept.unionByName(once.select(*COLUMNS)).unionByName(alone.select(*COLUMNS))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind.

    Null texts stay null, empty ones empty; repeated rows and null ids stay; no
    documents give none.
    """
    return pii.redact_documents(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents with their sequence and offset.

    A null or empty text is its end token alone; repeated rows and those
    without an id are packed each; no documents give no pieces.
    """
    return packing.pack(docs, RANKS)


STAGES = [
    ("quality rules", keep_quality),
    ("language ID", keep_known_language),
    ("n-gram Jaccard join", keep_one_of_group),
    ("PII", redact_personal_data),
    ("packing", pack_sequences),
]

#: Learned models and approximate search can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = shared_dir(spark, f"pipeline-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
