"""Registered queries for scalar text rules and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from modlake.checks import inputs as I
from modlake.checks import sql as Q
from modlake.checks.registry import query
from modlake.plans.features import dense_features

_FEATURE_KEYS = {
    "feat_text_shape": ("char_count", "word_count", "exclamation_count"),
    "feat_uppercase": ("uppercase_ratio",),
    "feat_unique_words": ("unique_word_ratio",),
    "feat_elongation": ("elongated_token_count",),
    "feat_punct_runs": ("consecutive_punct_count",),
    "feat_url_ip": ("url_count", "ip_count", "has_url_or_ip"),
    "feat_second_person": (
        "has_second_person", "second_person_count", "second_person_density",
    ),
    "feat_profanity": ("profanity_count",),
    "feat_obfuscated": ("obfuscated_profanity_count",),
    "feat_slang": ("slang_count",),
    "feat_negation": ("negation_count",),
    "feat_sentences": ("sentence_count", "avg_sentence_length"),
    "feat_identity": (
        "identity_mention_count", "identity_race", "identity_gender",
        "identity_sexuality", "identity_religion", "identity_disability",
        "identity_nationality",
    ),
}
_ROUNDED = {
    "uppercase_ratio", "unique_word_ratio", "avg_sentence_length", "second_person_density",
}


def _rounded(names):
    return [F.round(n, 6).alias(n) if n in _ROUNDED else F.col(n) for n in names]


def _rounded_sql(names):
    return ", ".join(f"round({n}, 6) AS {n}" if n in _ROUNDED else n for n in names)


def _register_feature(key, names):
    @query(key, f"{Q.FEATS} SELECT doc_id, {_rounded_sql(names)} FROM feats")
    def run(spark, sf_dir):
        df = dense_features(I.comments(spark, sf_dir), "text", keep=["doc_id"], only=names)
        return df.select("doc_id", *_rounded(names))


for _key, _names in _FEATURE_KEYS.items():
    _register_feature(_key, _names)
_register_feature("dense_features", I.PLAIN_FEATURES)
