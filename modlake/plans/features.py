"""The 32 text features as one narrow projection.

Shared sub-results (cleaned text, lower text, word array) are computed in inner
projections and read by many outputs; Catalyst keeps these projections apart
because the expressions are not cheap, so each is evaluated once per row.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.functions import sentiment as S
from modlake.functions import text as X
from modlake.functions.lexicons import DEFAULT, Lexicons
from modlake.operators.sentiment import valence_lookup

# feature -> category, in output order (fixed names and order)
CATALOGUE: dict[str, tuple[str, ...]] = {
    "sentiment": (
        "vader_compound", "vader_neg", "vader_pos", "vader_is_negative",
        "vader_intensity", "vader_pos_minus_neg",
    ),
    "second_person": (
        "has_second_person", "second_person_count", "second_person_density",
    ),
    "profanity": ("profanity_count", "obfuscated_profanity_count"),
    "slang": ("slang_count",),
    "text_shape": (
        "char_count", "word_count", "exclamation_count", "uppercase_ratio",
    ),
    "unique_words": ("unique_word_ratio",),
    "elongation": ("elongated_token_count", "consecutive_punct_count"),
    "urls_ips": ("url_count", "ip_count", "has_url_or_ip"),
    "syntactic": ("negation_count", "sentence_count", "avg_sentence_length"),
    "identity": (
        "identity_mention_count", "identity_race", "identity_gender",
        "identity_sexuality", "identity_religion", "identity_disability",
        "identity_nationality",
    ),
}
FEATURES: tuple[str, ...] = tuple(f for names in CATALOGUE.values() for f in names)
BINARY_FEATURES = (
    "vader_is_negative", "has_second_person", "has_url_or_ip",
    "identity_race", "identity_gender", "identity_sexuality",
    "identity_religion", "identity_disability", "identity_nationality",
)
IDENTITY_FLAGS = tuple(f"identity_{c}" for c in DEFAULT.identity)


def category_of(feature: Column) -> Column:
    """Catalogue category of a feature name column."""
    pick = None
    for category, names in CATALOGUE.items():
        hit = feature.isin(list(names))
        pick = F.when(hit, category) if pick is None else pick.when(hit, category)
    return pick


def feature_catalogue(spark: SparkSession) -> DataFrame:
    rows = [(f, c) for c, names in CATALOGUE.items() for f in names]
    return spark.createDataFrame(rows, "feature string, category string")


def _counts(lex: Lexicons) -> dict[str, Column]:
    """Features read straight from the shared parts."""
    text, low, word_array = F.col("_text"), F.col("_low"), F.col("_words")
    return {
        "char_count": F.length(text).cast("long"),
        "word_count": F.size(word_array).cast("long"),
        "exclamation_count": X.exclamations(text),
        "_upper": X.upper_word_count(text),
        "_distinct": F.size(F.array_distinct(word_array)).cast("long"),
        "elongated_token_count": X.elongated_count(text),
        "consecutive_punct_count": X.punctuation_runs(text),
        "url_count": X.url_count(low),
        "ip_count": X.ip_count(text),
        "second_person_count": X.count_matches(low, X.term_pattern(lex.second_person)),
        "profanity_count": X.profanity_count(low, lex.profanity),
        "obfuscated_profanity_count": X.obfuscated_count(text, lex.profanity),
        "slang_count": X.slang_count(low, lex.slang),
        "negation_count": X.count_in(X.contraction_tokens(low), lex.negation),
        "sentence_count": X.sentence_count(text),
        "_sentence_words": X.sentence_words(text),
        "identity_mention_count": X.count_matches(
            low, X.term_pattern(lex.identity_terms())
        ),
    }


def _ratio(top: str, bottom: str) -> Column:
    safe = F.col(top).cast("double") / F.col(bottom)
    return F.when(F.col(bottom) > 0, safe).otherwise(F.lit(0.0))


def _derived(lex: Lexicons) -> dict[str, Column]:
    """Flags and ratios over the counts."""
    per_word = F.col("second_person_count") / F.greatest(F.col("word_count"), F.lit(1))
    out = {
        "has_second_person": (F.col("second_person_count") > 0).cast("int"),
        "second_person_density": F.round(per_word.cast("double"), 6),
        "uppercase_ratio": _ratio("_upper", "word_count"),
        "unique_word_ratio": _ratio("_distinct", "word_count"),
        "has_url_or_ip": (F.col("url_count") + F.col("ip_count") > 0).cast("int"),
        "avg_sentence_length": _ratio("_sentence_words", "sentence_count"),
    }
    for category, terms in lex.identity.items():
        # No mention at all means no category can match: skip the search.
        found = F.col("_low").rlike(X.term_pattern(terms))
        out[f"identity_{category}"] = F.when(
            (F.col("identity_mention_count") > 0) & found, 1
        ).otherwise(0)
    return out


def _sentiment_stages(df: DataFrame, lookup) -> DataFrame:
    df = df.withColumn("_tokens", S.sentiment_tokens(F.col("_text")))
    df = df.withColumns({
        "_lows": F.transform("_tokens", F.lower),
        "_caps": X.upper_word_count(F.col("_text"), shortest=1),
        "_emphasis": S.punctuation_emphasis(F.col("_text")),
    })
    df = df.withColumn("_vals", F.transform("_lows", lookup))
    mixed = (F.col("_caps") > 0) & (F.col("_caps") < F.size("_tokens"))
    df = df.withColumn(
        "_hits",
        S.weigh_around_but(
            F.col("_lows"),
            S.hit_valences(F.col("_tokens"), F.col("_lows"), F.col("_vals"), mixed),
        ),
    )
    hits, amp = F.col("_hits"), F.col("_emphasis")
    df = df.withColumns({
        "_sum": S.array_total(hits),
        "_up": S.array_total(F.transform(hits, lambda v: F.when(v > 0, v + 1.0).otherwise(0.0))),
        "_down": S.array_total(F.transform(hits, lambda v: F.when(v < 0, 1.0 - v).otherwise(0.0))),
        "_neutral": F.size("_tokens") - F.size(F.filter(hits, lambda v: v != 0.0)),
    })
    total, up, down = F.col("_sum"), F.col("_up"), F.col("_down")
    df = df.withColumns({
        "_sum": F.when(total > 0, total + amp).when(total < 0, total - amp).otherwise(total),
        "_up": F.when(up > down, up + amp).otherwise(up),
        "_down": F.when(up < down, down + amp).otherwise(down),
    })
    mass = up + down + F.col("_neutral")
    norm = total / F.sqrt(total * total + S.NORM_ALPHA)

    def share(part: Column) -> Column:
        return F.when(mass > 0, F.round(part / mass, 3)).otherwise(F.lit(0.0))

    return df.withColumns({
        "vader_compound": F.round(F.greatest(F.least(norm, F.lit(1.0)), F.lit(-1.0)), 4),
        "vader_neg": share(down),
        "vader_pos": share(up),
    })


def sentiment_derived(compound: Column, neg: Column, pos: Column) -> dict[str, Column]:
    return {
        "vader_is_negative": (compound < S.NEGATIVE_CUT).cast("int"),
        "vader_intensity": F.abs(compound),
        "vader_pos_minus_neg": F.round(pos - neg, 6),
    }


def dense_features(
    df: DataFrame,
    text_col: str = "comment_text",
    *,
    keep: list[str] | None = None,
    lexicons: Lexicons = DEFAULT,
    sentiment: dict[str, float] | DataFrame | None = None,
    only: tuple[str, ...] | None = None,
) -> DataFrame:
    """All features of ``text_col`` (NULL counts as empty text).

    ``keep`` names input columns to carry along; by default only features come
    out.  ``only`` restricts the output, and Catalyst then prunes the unused
    work.  ``sentiment`` is the valence lexicon as a dict or a
    ``(term, valence)`` table.
    """
    wanted = FEATURES if only is None else tuple(f for f in FEATURES if f in set(only))
    keep = list(keep or [])
    base = df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    base = base.withColumns({
        "_low": X.folded(F.col("_text")),
        "_words": X.words(F.col("_text")),
    })
    base = base.withColumns(_counts(lexicons)).withColumns(_derived(lexicons))
    if any(f.startswith("vader_") for f in wanted):
        base, lookup = valence_lookup(base, "_text", S.SEED_LEXICON if sentiment is None else sentiment)
        base = _sentiment_stages(base, lookup)
        base = base.withColumns(
            sentiment_derived(
                F.col("vader_compound"), F.col("vader_neg"), F.col("vader_pos")
            )
        )
    return base.select(*keep, *wanted)


class DenseFeatures(
    Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """The same features as a pipeline stage; input columns are kept."""

    keepInput = Param(
        Params._dummy(), "keepInput", "carry the input columns along",
        typeConverter=TypeConverters.toBoolean,
    )

    @keyword_only
    def __init__(self, *, inputCol: str = "comment_text", keepInput: bool = True):
        super().__init__()
        self._setDefault(inputCol="comment_text", keepInput=True)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keep = dataset.columns if self.getOrDefault(self.keepInput) else []
        return dense_features(dataset, self.getInputCol(), keep=keep)
