"""A document pipeline of the training-data operators; each stage's rows are written and reread.

Order: keep texts whose language is recognised, keep one document of each near-duplicate
class, drop documents that hold a benchmark item, mask personal data, encode to token ids.
Rows without a doc_id have no near-duplicate class; equal texts among them become one.  ORACLE_SQL is None: language
models, sketches and byte-pair merges have no SQL twin; tests compare with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.llm import bpe, decontaminate, language, near_duplicates, pii
from modlake.llm.common import table
from modlake.session import scratch_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ORACLE_SQL = None


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; models learn from the stage's own labelled rows.

    Other columns travel under numbers, so they may have any names.
    """
    model = language.train(language.held_out(docs).filter(~F.col("held_out")))
    inner = {c: "text" if c == "text" else f"column {i}" for i, c in enumerate(docs.columns)}
    kept = language.identify(docs.withColumnsRenamed(inner), model).filter("accepted")
    return kept.select(*[F.col(f"`{n}`").alias(c) for c, n in inner.items()])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each near-duplicate class, and one row of each of its texts.

    Rows move once, by id; the sides are merged at every size, as both grow with the input.
    """
    classes = near_duplicates.classes(docs, scratch_folder(spark, "near"))
    others = classes.filter("doc_id <> class_id").select(F.col("doc_id").alias("key")).distinct()
    row = F.struct(*[f"`{c}`" for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col("doc_id").cast("bigint").alias("key"), F.xxhash64("text").alias("digest"))
    kept = rows.join(others.hint("merge"), "key", "left_anti").dropDuplicates(["key", "digest"])
    return kept.select(*[f"row.`{c}`" for c in docs.columns])


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redact(docs, scratch_folder(spark, "mask"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", recognised), ("near_duplicates", one_of_each), ("decontamination", uncontaminated),
    ("personal_data", masked), ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from ``documents``; each one's result is written and reread."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_folder(spark, "pipeline")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
