"""Inputs of the registered queries, derived by Spark from the shared tables.

The shared text has no links, few capitals and no second person, so every
comment is varied by a fixed rule on its id before features are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.functions.moderation import comment_id, decide
from modlake.operators.linear import LinearModel
from modlake.plans.features import FEATURES, dense_features
from modlake.session import dealt, scratch_folder

LOWER = "abcdefghijklmnopqrstuvwxyz"
PLAIN_FEATURES = tuple(f for f in FEATURES if not f.startswith("vader_"))

# A fixed scorer, so that scores can be computed by SQL as well.
MODEL = LinearModel(
    intercept=-1.1,
    terms={
        # feature: (mean, std, coefficient)
        "profanity_count": (0.2, 0.8, 1.4),
        "obfuscated_profanity_count": (0.0, 0.5, 0.6),
        "uppercase_ratio": (0.2, 0.4, 0.9),
        "slang_count": (0.2, 0.4, 0.7),
        "second_person_count": (0.2, 0.4, -0.5),
        "unique_word_ratio": (0.8, 0.1, -0.3),
        "char_count": (2000.0, 3000.0, 0.2),
        "negation_count": (0.4, 0.8, 0.1),
        "consecutive_punct_count": (0.5, 1.0, 0.25),
    },
)
MANUAL, AUTO = 0.55, 0.75


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def varied_text() -> Column:
    text, kind = F.col("text"), F.col("doc_id") % 5
    return (
        F.when(kind == 0, text)
        .when(kind == 1, F.translate(text, LOWER, LOWER.upper()))
        .when(kind == 2, F.concat(text, F.lit(" you're www.example.com !!!")))
        .when(kind == 3, F.replace(text, F.lit("idiot"), F.lit("1d10t")))
        .otherwise(
            F.concat(text, F.lit(" I can't. No! soooo KYS, black women: not so good idea"))
        )
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comment_columns(dealt(table(spark, sf_dir, "documents")))


def comment_columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.col("source").alias("article_id"),
        F.when(F.col("doc_id") % 6 == 0, "").otherwise(
            F.concat(F.lit("user"), (F.col("doc_id") % 7).cast("string"))
        ).alias("author"),
        F.date_format(
            F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 4321),
            "yyyy-MM-dd'T'HH:mm:ss",
        ).alias("timestamp"),
        varied_text().alias("text"),
    )


def featured(spark: SparkSession, sf_dir: str, only=PLAIN_FEATURES) -> DataFrame:
    """Every comment with its features."""
    return dense_features(
        comments(spark, sf_dir), "text",
        keep=["doc_id", "article_id", "author", "timestamp", "text"], only=only,
    )


def labelled(spark: SparkSession, sf_dir: str, only=PLAIN_FEATURES) -> DataFrame:
    """Features of the labelled comments; the join comes before the text work."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    joined = dealt(comments(spark, sf_dir).join(labels, "doc_id"))
    return dense_features(joined, "text", keep=["doc_id", "toxic"], only=only)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of the shared folder: features are computed once for all passes."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def model_features() -> tuple[str, ...]:
    return tuple(MODEL.terms)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment with score, decision, flag and the stored columns."""
    base = featured(spark, sf_dir, only=model_features())
    probability = F.round(MODEL.probability(), 6)
    base = base.withColumn("toxicity", probability)
    return base.select(
        "doc_id",
        comment_id(F.col("timestamp"), F.col("author"), F.col("text")).alias("id"),
        "article_id",
        F.when(F.col("author") == "", "unsigned").otherwise(F.col("author")).alias("author"),
        "timestamp",
        "text",
        "toxicity",
        decide(F.col("toxicity"), AUTO, MANUAL).alias("decision"),
        (F.col("toxicity") >= MANUAL).alias("is_flagged"),
        F.when(F.col("doc_id") % 3 == 0, 0.0)
        .otherwise((F.col("doc_id") % 50) * 0.5 + 1.25)
        .alias("inference_ms"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``y_true, y_pred, y_score`` of the labelled comments."""
    base = labelled(spark, sf_dir, only=model_features())
    score = F.round(MODEL.probability(), 6)
    return base.withColumn("y_score", score).select(
        "doc_id",
        F.col("toxic").alias("y_true"),
        (F.col("y_score") >= 0.5).cast("int").alias("y_pred"),
        "y_score",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a numeric table with a binary label."""
    return dealt(table(spark, sf_dir, "lineitem")).select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
    )


LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def line_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a score in [0, 1], for the curve operators."""
    score = F.round(
        (F.col("l_extendedprice") % 1000) / 2000 + F.col("l_discount") * 4, 6
    )
    return dealt(table(spark, sf_dir, "lineitem")).select(
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        score.alias("y_score"),
        (score >= 0.5).cast("int").alias("y_pred"),
    )
