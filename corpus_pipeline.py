"""A corpus from raw documents to token ids: quality, near-duplicates, benchmark passages, personal data, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. Rows
move through the filters in place: no stage joins texts back to its decisions, save where a decision is about groups.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_batches, fresh, store_folder, stored, table
from shelfcast.llm.decontaminate import contaminated, find_benchmark
from shelfcast.llm.nearcopies import row_key, survivors
from shelfcast.llm.pieces import encode_documents
from shelfcast.llm.privacy import find_personal, redacted
from shelfcast.llm.quality import THRESHOLD, fit_quality, score_quality


def _columns(df: DataFrame) -> list[F.Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score below the threshold go; the field learns from the stage's own documents.

    Null and empty texts have the score of an empty text; a text of any length is scored whole; repeated rows have one
    score and go or stay together; null ids are scored and never learnt from; an empty table gives no rows.
    """
    bounded_batches(spark)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "quality")
    scored = score_quality(docs, model, keep=tuple(docs.columns), name=name)
    return scored.where(F.col(name)["score"] >= THRESHOLD).select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays: that of the smallest id, then text hash, then row hash.

    Different texts under one id are documents of their own, and of whole rows that repeat one stays. Null, empty and
    wordless texts are copies of each other. A document with a null id is in no group and stays. A text of any length
    is compared whole; an empty table gives no rows.
    """
    bounded_batches(spark)
    key, kept_id, kept_key, again = (fresh(docs, name) for name in ("row_key", "kept_id", "kept_key", "repeated"))
    stays = stored(survivors(docs).toDF(kept_id, kept_key, again), "near-dedup-stays")
    keyed = docs.withColumn(key, row_key(docs))
    same = (F.col("doc_id") == F.col(kept_id)) & (F.col(key) == F.col(kept_key))
    once = keyed.join(stays.where(~F.col(again)), same, "left_semi")
    # Rows that repeat as a whole are few as a rule; only they are brought together.
    single = keyed.join(stays.where(F.col(again)), same, "left_semi").dropDuplicates(["doc_id", key])
    return once.unionByName(single).select(*_columns(docs)).unionByName(docs.where(F.col("doc_id").isNull()))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated by the rule of the operator go.

    A null or wordless text has no hit and stays; a text of any length is searched whole; repeated rows go or stay
    together; with an empty benchmark all stay; an empty table gives no rows.
    """
    bounded_batches(spark)
    name = fresh(docs, "found")
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns), name=name)
    return found.where(~contaminated(F.col(name))).select(*_columns(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms are replaced by labels; n_chars follows the new text.

    No row goes. A null text stays null and keeps its n_chars, an empty one stays empty; a text of any length is treated
    whole; repeated rows are treated alike; null ids are treated too; an empty table gives no rows.
    """
    base = fresh(docs, "base_spans")
    added = fresh(docs, "added_spans")
    found = find_personal(docs, base=base, added=added)
    text = redacted(F.coalesce(F.col("text"), F.lit("")), F.col(base), F.col(added))
    clean = found.withColumn("text", F.when(F.col("text").isNotNull(), text))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))
    return clean.select(*_columns(docs))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the pieces, their number, and whether decoding gives the text back.

    A row for every row: a null text counts as empty and has no ids; a text of any length is encoded whole; repeated
    rows and null ids give a row each; an empty table gives no rows.
    """
    bounded_batches(spark)
    name = fresh(docs, "pieces")
    found = encode_documents(docs, keep=("doc_id",), name=name)
    return found.select("doc_id", F.col(name)["ids"].alias("ids"), F.col(name)["n_pieces"].alias("n_pieces"),
                        F.col(name)["restored"].alias("restored"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("pieces", pieces),
]

#: No SQL: the field, the fingerprints and the piece model are beyond it. tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = f"{store_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
