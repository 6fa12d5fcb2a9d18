"""Labelled comments and tuning or error-sample files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("comment_text", T.StringType()),
    *[
        T.StructField(c, T.DoubleType())
        for c in ("toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate")
    ],
])


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """``id, comment_text, toxic`` from CSV (also .gz) or Parquet, rows with gaps dropped."""
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        raw = (
            spark.read.schema(CSV_SCHEMA)
            .option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .csv(path)
        )
    else:
        raw = spark.read.parquet(path)
    return clean_labelled(raw)


def clean_labelled(raw: DataFrame, text: str = "comment_text", label: str = "toxic") -> DataFrame:
    extra = ["id"] if "id" in raw.columns else []
    kept = raw.select(*extra, text, label).dropna(subset=[text, label])
    return kept.withColumn(label, F.col(label).cast("int"))


def load_summary(df: DataFrame, label: str = "toxic") -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"), F.avg(label).alias("toxic_rate"))


def error_sample(spark: SparkSession, path: str, limit: int = 5, descending: bool = True) -> DataFrame:
    """The first rows of an error-sample CSV (``text, score``) by score."""
    schema = "text string, score double"
    rows = spark.read.schema(schema).option("header", True).option("multiLine", True).option(
        "escape", '"'
    ).csv(path)
    return rows.orderBy(F.desc("score") if descending else F.asc("score"), "text").limit(limit)
