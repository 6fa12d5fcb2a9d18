"""Profiling of numeric columns against a binary label.

Inputs are wide tables; outputs are tidy tables, one per report section.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modlake.functions.moderation import risk_tier
from modlake.operators import prefix
from modlake.operators.columns import column_stats, correlation, correlation_matrix, long_form
from modlake.operators.histogram import all_bins, bin_index, edge

# Never treated as features (fixed names).
NOT_FEATURES = (
    "id", "comment_text", "severe_toxic", "obscene", "threat", "insult", "identity_hate",
)


def numeric_features(df: DataFrame, label: str) -> list[str]:
    skip = {*NOT_FEATURES, label}
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def _is(label: str, value: int) -> Column:
    return F.col(label) == value


def _largest(name: str) -> Column:
    """Descending by magnitude; rounding keeps equal columns in name order."""
    return F.desc_nulls_last(F.round(F.abs(name), 12))


def _absent(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    missing = F.col(name).isNull()
    return missing | F.isnan(name) if isinstance(kind, (T.DoubleType, T.FloatType)) else missing


def missing_report(df: DataFrame) -> DataFrame:
    """``(column, missing_count, missing_pct)`` of the columns with missing values."""
    counts = F.array(*[
        F.struct(F.lit(c).alias("column"), F.count_if(_absent(df, c)).alias("missing_count"))
        for c in df.columns
    ])
    one = df.agg(F.count("*").alias("n"), counts.alias("c"))
    return (
        one.select("n", F.inline("c"))
        .filter("missing_count > 0")
        .select(
            "column", "missing_count",
            (F.col("missing_count") * 100.0 / F.col("n")).alias("missing_pct"),
        )
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each distinct row (NULLs are equal)."""
    distinct = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return distinct.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


#: Whole-text patterns of the values of a column, narrowest first.
WHOLE_NUMBER = r"[+-]?[0-9]+"
NUMBER = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[+-]?[iI]nf(inity)?"


def _value_type(df: DataFrame, name: str) -> Column:
    """Type of one column from the kinds of value seen in it (an aggregate)."""
    value = F.trim(F.col(f"`{name}`").cast("string"))
    missing = value.isNull() | (value == "") | (F.lower(value) == "nan")
    flag = F.lower(value).isin("true", "false")
    whole, number = (value.rlike(rf"\A(?:{p})\z") for p in (WHOLE_NUMBER, NUMBER))

    def seen(kind: Column) -> Column:
        return F.coalesce(F.bool_or(kind), F.lit(False))

    holes, flags = seen(missing), seen(~missing & flag)
    numbers, fractions, texts = seen(~missing & number), seen(~missing & number & ~whole), seen(~missing & ~flag & ~number)
    return (
        F.when(texts | (F.count("*") == 0) | (flags & (numbers | holes)), "object")
        .when(flags, "bool")
        .when(fractions | holes, "float64")
        .otherwise("int64")
    )


def dtype_counts(df: DataFrame) -> DataFrame:
    """How many columns each type has, by the values a reader of text files would find.

    Whole numbers without a gap are int64; numbers with a fraction or a gap, and columns
    without any value, float64; true and false without a gap bool; all else, and tables
    without rows, object.  Flags of the kinds seen are combined inside tasks: one scan, one
    row per task shuffled.  Arrays and structs count as object.
    """
    plain = [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct", "binary"))]
    other = [F.lit("object")] * (len(df.columns) - len(plain))
    types = df.agg(F.array(*[_value_type(df, c) for c in plain], *other).alias("t"))
    return types.select(F.explode("t").alias("dtype")).groupBy("dtype").agg(F.count("*").alias("columns"))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("count"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return counts.select(
        "label", "count", F.round(F.col("count") * 100.0 / total, 2).alias("pct")
    )


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Two ratios: largest/smallest class, and negatives/positives."""
    per_class = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    ones = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0))
    zeros = F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0))
    return per_class.agg(
        F.when(F.count("*") > 1, F.max("n") / F.min("n")).alias("majority_minority_ratio"),
        F.when(zeros > 0, F.try_divide(zeros, ones)).otherwise(F.lit(0.0)).alias(
            "negative_positive_ratio"
        ),
    )


def overview(df: DataFrame, label: str) -> DataFrame:
    ones, zeros = F.count_if(_is(label, 1)), F.count_if(_is(label, 0))
    missing = sum((F.count_if(_absent(df, c)) for c in df.columns), F.lit(0))
    rate = F.try_divide(ones, F.count("*"))
    return df.agg(
        F.count("*").alias("total_rows"),
        ones.alias("toxic_count"),
        zeros.alias("nontoxic_count"),
        F.round(rate, 4).alias("toxic_rate"),
        F.round(F.lit(1.0) - rate, 4).alias("nontoxic_rate"),
        F.round(
            F.when(zeros > 0, F.try_divide(zeros, ones)).otherwise(F.lit(0.0)), 2
        ).alias("imbalance_ratio"),
        missing.alias("missing_values"),
        F.lit(len(df.columns)).alias("total_features"),
    )


def split_report(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    def rows(part):
        return F.count_if(F.col(split) == part)

    def rate(part):
        return F.avg(F.when(F.col(split) == part, F.col(label)))

    return df.agg(
        rows("train").alias("train_rows"), rate("train").alias("train_rate"),
        rows("test").alias("test_rows"), rate("test").alias("test_rate"),
        F.abs(rate("train") - rate("test")).alias("absolute_rate_gap"),
    )


def occurrence(df: DataFrame, label: str, features: Iterable[str]) -> DataFrame:
    """How often a feature is non-zero, overall and per class."""

    # A missing value counts as "not equal to zero", as it does in a data frame.
    def nonzero(x):
        return F.coalesce(x != 0, F.lit(True))

    stats = column_stats(df, features, {
        "n": lambda x: F.count("*"),
        "n0": lambda x: F.count_if(_is(label, 0)),
        "n1": lambda x: F.count_if(_is(label, 1)),
        "non_zero_count": lambda x: F.count_if(nonzero(x)),
        "non_zero_count_non_toxic": lambda x: F.count_if(nonzero(x) & _is(label, 0)),
        "non_zero_count_toxic": lambda x: F.count_if(nonzero(x) & _is(label, 1)),
    })

    def pct(part, whole):
        return F.round(F.col(part) * 100.0 / F.greatest(F.col(whole), F.lit(1)), 2)

    return stats.select(
        "feature", "non_zero_count", pct("non_zero_count", "n").alias("non_zero_pct"),
        "non_zero_count_non_toxic", "non_zero_count_toxic",
        pct("non_zero_count_non_toxic", "n0").alias("non_zero_pct_non_toxic"),
        pct("non_zero_count_toxic", "n1").alias("non_zero_pct_toxic"),
    ).orderBy(F.desc("non_zero_count"), "feature")


def label_correlation(df: DataFrame, label: str, features: Iterable[str]) -> DataFrame:
    y = F.col(label).cast("double")
    stats = column_stats(df, features, {"correlation": lambda x: correlation(x, y)})
    return stats.orderBy(_largest("correlation"), "feature")


def class_means(df: DataFrame, label: str, features: Iterable[str]) -> DataFrame:
    stats = column_stats(df, features, {
        "non_toxic": lambda x: F.avg(F.when(_is(label, 0), x)),
        "toxic": lambda x: F.avg(F.when(_is(label, 1), x)),
    })
    diff = (F.col("toxic") - F.col("non_toxic")).alias("toxic_minus_non_toxic")
    return stats.select("feature", "non_toxic", "toxic", diff).orderBy(
        _largest("toxic_minus_non_toxic"), "feature"
    )


def _cohens_d() -> Column:
    m1, m0, v1, v0 = (F.col(c) for c in ("m1", "m0", "v1", "v0"))
    n1, n0 = F.col("n1"), F.col("n0")
    pooled = F.sqrt(F.try_divide((n1 - 1) * v1 + (n0 - 1) * v0, n1 + n0 - 2))
    return F.when((v1 + v0 == 0) | (pooled == 0), F.lit(0.0)).otherwise((m1 - m0) / pooled)


def effect_size(df: DataFrame, label: str, features: Iterable[str]) -> DataFrame:
    """Cohen's d with the class moments and the label correlation it comes with."""
    y = F.col(label).cast("double")
    one, zero = _is(label, 1), _is(label, 0)
    stats = column_stats(df, features, {
        "m1": lambda x: F.avg(F.when(one, x)),
        "m0": lambda x: F.avg(F.when(zero, x)),
        "v1": lambda x: F.var_samp(F.when(one, x)),
        "v0": lambda x: F.var_samp(F.when(zero, x)),
        "n1": lambda x: F.count(F.when(one, x)),
        "n0": lambda x: F.count(F.when(zero, x)),
        "correlation": lambda x: correlation(x, y),
    })
    return stats.select(
        "feature", _cohens_d().alias("effect_size"), "correlation",
        F.col("m1").alias("toxic_mean"), F.col("m0").alias("nontoxic_mean"), "n1", "n0",
    )


def category_summary(
    df: DataFrame, label: str, features: Iterable[str], category: Column
) -> DataFrame:
    """Class means and effect size per feature, under its category."""
    return effect_size(df, label, features).select(
        category.alias("category"), "feature",
        F.round("toxic_mean", 6).alias("toxic_mean"),
        F.round("nontoxic_mean", 6).alias("nontoxic_mean"),
        F.round("effect_size", 4).alias("effect_size"),
    )


def class_counts(df: DataFrame, label: str, features: Iterable[str]) -> DataFrame:
    """``(label, feature, value, n)`` - the input of all exact distributions."""
    both = df.filter(F.col(label).isin(0, 1))
    return prefix.value_counts(
        long_form(both.withColumnRenamed(label, "label"), features, ["label"]),
        ["label", "feature"], "value",
    )


def top_features(
    df: DataFrame, label: str, features: Iterable[str], category: Column, top: int = 15
) -> DataFrame:
    """Features ranked by absolute effect size, with means and exact medians."""
    features = list(features)
    medians = (
        prefix.exact_quantiles(
            class_counts(df, label, features), {"median": 0.5}, keys=["label", "feature"]
        )
        .groupBy("feature")
        .agg(
            F.max(F.when(F.col("label") == 1, F.col("median"))).alias("toxic_median"),
            F.max(F.when(F.col("label") == 0, F.col("median"))).alias("nontoxic_median"),
        )
    )
    sizes = effect_size(df, label, features).filter("n1 > 0 AND n0 > 0").withColumn(
        "effect_size", F.round("effect_size", 4)
    )
    # One row per feature column, so ranking in one place is bounded by the schema.
    best = sizes.orderBy(F.desc(F.abs("effect_size")), "feature").limit(top)
    ranked = best.agg(
        F.array_sort(F.collect_list(F.struct(
            (-F.abs("effect_size")).alias("k"), "feature", "effect_size", "correlation",
            "toxic_mean", "nontoxic_mean",
        ))).alias("rows")
    ).select(F.posexplode("rows").alias("pos", "r"))
    return ranked.select((F.col("pos") + 1).alias("rank"), "r.*").join(
        F.broadcast(medians), "feature"
    ).select(
        "rank", F.col("feature").alias("name"), category.alias("category"), "effect_size",
        F.round("correlation", 4).alias("correlation"),
        *[F.round(c, 6).alias(c) for c in (
            "toxic_mean", "nontoxic_mean", "toxic_median", "nontoxic_median")],
    )


def top_correlations(
    df: DataFrame, label: str, features: Iterable[str], top: int = 12
) -> DataFrame:
    """Correlation matrix of the ``top`` features nearest to the label, plus the label."""
    features = list(features)
    matrix = correlation_matrix(df, [*features, label])
    best = (
        label_correlation(df, label, features)
        .limit(top)
        .agg(F.collect_set("feature").alias("f"))
        .scalar()
    )
    keep = F.array_union(best, F.array(F.lit(label)))
    return matrix.filter(
        F.array_contains(keep, F.col("feature_a")) & F.array_contains(keep, F.col("feature_b"))
    )


def class_histograms(
    df: DataFrame, label: str, features: Iterable[str], binary: Iterable[str] = (), bins: int = 30
) -> DataFrame:
    """Per-class percentages in equal bins between the 1st and 99th percentile.

    Binary features use the edges -0.5, 0.5, 1.5.  Percentages are of the whole
    class, so values outside the range lower the sum.
    """
    features, binary = list(features), list(binary)
    # One exchange of counts serves limits, bins and class sizes.  Missing values are
    # counted too, for the sizes; a filter on the value would be pushed below the counts,
    # as would the IS NOT NULL of a join on a name that may be NULL.
    by_class = long_form(
        df.filter(F.col(label).isin(0, 1)).withColumnRenamed(label, "label"), features, ["label"]
    ).groupBy("label", F.coalesce("feature", F.lit("")).alias("feature"), "value").agg(F.count("*").alias("n"))
    held = F.when(prefix.present("value"), F.col("n")).otherwise(0)
    overall = by_class.groupBy("feature", "value").agg(F.sum(held).alias("n")).filter("n > 0")
    limits = prefix.exact_quantiles(overall, {"low": 0.01, "high": 0.99}, keys=["feature"])
    is_binary = F.col("feature").isin(binary) if binary else F.lit(False)
    limits = limits.select(
        "feature", is_binary.alias("is_binary"),
        F.when(is_binary, F.lit(-0.5)).otherwise(F.col("low")).alias("low"),
        F.when(is_binary, F.lit(1.5))
        .when(F.col("high") <= F.col("low"), F.col("low") + 1.0)
        .otherwise(F.col("high")).alias("high"),
    )
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    place = F.when(F.col("is_binary"), bin_index(value, low, high, 2)).otherwise(
        bin_index(value, low, high, bins)
    )
    # At most ``bins`` cells and one for values outside per feature.
    cell = F.struct("bin", F.struct("c0", "c1").alias("c"))
    filled = (
        by_class.join(F.broadcast(limits), "feature", "left")
        .groupBy("feature", F.when(prefix.present("value"), place).alias("bin"))
        .agg(
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("c0"),
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("c1"),
        )
        .groupBy("feature")
        .agg(
            F.sum("c0").alias("s0"), F.sum("c1").alias("s1"),
            F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), cell))).alias("cells"),
        )
    )
    last = F.when(F.col("is_binary"), 1).otherwise(bins - 1)
    grid = limits.join(F.broadcast(filled), "feature").withColumn("bin", F.explode(F.sequence(F.lit(0), last)))
    count_bins = F.when(F.col("is_binary"), edge(F.col("bin"), low, high, 2)).otherwise(
        edge(F.col("bin"), low, high, bins)
    )
    here = F.try_element_at("cells", F.col("bin"))

    def share(count: str, size: str) -> Column:
        part = F.coalesce(here[count], F.lit(0)) * 100.0
        return F.round(F.try_divide(part, F.col(size)), 4)

    return grid.select(
        "feature", "bin", F.round(count_bins, 6).alias("left_edge"),
        share("c0", "s0").alias("non_toxic"), share("c1", "s1").alias("toxic"),
        "is_binary",
    )


def feature_histograms(
    df: DataFrame, label: str, features: Iterable[str], bins: int = 40
) -> DataFrame:
    """Per class, counts in equal bins over that class's own range."""
    counts = class_counts(df, label, list(features))
    limits = counts.groupBy("label", "feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    flat = F.col("lo") == F.col("hi")
    limits = limits.select(
        "label", "feature",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("low"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("high"),
    )
    low, high = F.col("low"), F.col("high")
    filled = (
        counts.join(F.broadcast(limits), ["label", "feature"])
        .groupBy("label", "feature", bin_index(F.col("value"), low, high, bins).alias("bin"))
        .agg(F.sum("n").alias("count"))
    )
    grid = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    centre = (edge(F.col("bin"), low, high, bins) + edge(F.col("bin") + 1, low, high, bins)) / 2
    return grid.join(F.broadcast(filled), ["label", "feature", "bin"], "left").select(
        "feature", "label", "bin", centre.alias("bin_center"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def class_summary(df: DataFrame, label: str, features: Iterable[str]) -> DataFrame:
    """Per class: min, max, mean, exact median and sample deviation."""
    features = list(features)
    both = df.filter(F.col(label).isin(0, 1)).withColumnRenamed(label, "label")
    stats = column_stats(both, features, {
        "min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp,
    }, by=("label",))
    medians = prefix.exact_quantiles(
        class_counts(df, label, features), {"median": 0.5}, keys=["label", "feature"]
    )
    return stats.join(F.broadcast(medians), ["label", "feature"], "left").select(
        "feature", "label", "min", "max", "mean", "median", "std"
    )


def word_list_summary(df: DataFrame, features: Iterable[str]) -> DataFrame:
    """Comments affected, mean and maximum of count features."""
    return column_stats(df, features, {
        "comments": lambda x: F.count_if(x > 0),
        "mean_count": lambda x: F.round(F.avg(x), 4),
        "max_count": lambda x: F.max(x).cast("long"),
    })


def identity_analysis(df: DataFrame, label: str, flags: Iterable[str]) -> DataFrame:
    """Toxicity rate and relative risk of comments that mention a group."""
    hit = _is(label, 1)
    stats = column_stats(df, flags, {
        "n": lambda x: F.count("*"),
        "all_toxic": lambda x: F.count_if(hit),
        "mention_count": lambda x: F.count_if(x == 1),
        "toxic_with_mention": lambda x: F.count_if((x == 1) & hit),
    }).filter("mention_count > 0")
    rate = F.col("toxic_with_mention") / F.col("mention_count")
    base = F.col("all_toxic") / F.col("n")
    return stats.select(
        F.regexp_replace("feature", "^identity_", "").alias("category"), "mention_count",
        F.round(F.col("mention_count") * 100.0 / F.col("n"), 2).alias("mention_pct"),
        "toxic_with_mention", F.round(rate, 4).alias("toxicity_rate"),
        F.round(base, 4).alias("baseline_toxicity_rate"),
        F.round(F.when(base > 0, F.try_divide(rate, base)).otherwise(0.0), 2).alias("relative_risk"),
    )


def identity_risk(
    df: DataFrame, label: str, flags: Iterable[str], hate: str | None = None
) -> DataFrame:
    """Relative risk per group at three places, with tier, riskiest first."""
    hate_col = F.col(hate).cast("double") if hate else F.lit(0.0)
    y = F.col(label).cast("double")
    stats = column_stats(df, flags, {
        "n": lambda x: F.count("*"),
        "base": lambda x: F.avg(y),
        "count": lambda x: F.count_if(x == 1),
        "rate": lambda x: F.avg(F.when(x == 1, y)),
        "hate": lambda x: F.avg(F.when(x == 1, hate_col)),
    }).filter("count > 0")
    risk = F.round(F.when(F.col("base") > 0, F.try_divide("rate", "base")).otherwise(0.0), 3)
    return stats.select(
        F.col("feature").alias("key"), "count",
        F.round(F.col("count") * 100.0 / F.col("n"), 2).alias("pct_of_dataset"),
        F.round("rate", 4).alias("toxic_rate"), risk.alias("relative_risk"),
        F.round("hate", 4).alias("identity_hate_rate"), risk_tier(risk).alias("tier"),
    ).orderBy(F.desc("relative_risk"), "key")


def identity_overview(
    df: DataFrame, label: str, mentions: str = "identity_mention_count", hate: str | None = None
) -> DataFrame:
    """Any-mention statistics of the whole table."""
    y, any_mention = F.col(label).cast("double"), F.col(mentions) > 0
    total, count = F.count("*"), F.count_if(any_mention)
    hated = F.sum(F.col(hate)) if hate else F.lit(0)
    return df.agg(
        F.round(F.avg(y), 4).alias("baseline_toxic_rate"),
        total.alias("total_comments"),
        count.alias("any_identity_mention_count"),
        F.round(F.try_divide(count * 100.0, total), 2).alias("any_identity_mention_pct"),
        F.round(F.coalesce(F.avg(F.when(any_mention, y)), F.lit(0.0)), 4).alias(
            "any_identity_mention_toxic_rate"
        ),
        F.coalesce(hated, F.lit(0)).cast("long").alias("identity_hate_total"),
        F.round(F.coalesce(F.try_divide(hated, total), F.lit(0.0)), 5).alias("identity_hate_rate"),
    )


def readiness(
    df: DataFrame, label: str, features: Iterable[str], key: str, split: str = "split"
) -> DataFrame:
    """Modelling checklist; disjoint splits and filled features are computed."""
    features = list(features)
    in_both = (
        df.groupBy(key).agg(F.count_distinct(split).alias("parts"))
        .agg(F.count_if(F.col("parts") > 1).alias("n")).scalar()
    )
    best = label_correlation(df, label, features).limit(10).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(
                    (-F.round(F.abs("correlation"), 12)).alias("k"), "feature"
                ))),
                lambda r: r["feature"],
            ), ",",
        ).alias("t")
    ).scalar()
    holes = sum((F.count_if(F.col(f).isNull()) for f in features), F.lit(0))
    ratio = imbalance(df, label).select("majority_minority_ratio").scalar()
    return df.agg((holes == 0).alias("train_has_engineered_features")).select(
        (in_both == 0).alias("split_disjoint"),
        "train_has_engineered_features",
        (ratio > 1.5).alias("target_imbalance_detected"),
        F.lit(len(features)).alias("candidate_features_count"),
        best.alias("top_candidate_features"),
    )


def describe(df: DataFrame, features: Iterable[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column."""
    features = list(features)
    stats = column_stats(df, features, {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
    })
    counts = prefix.value_counts(long_form(df, features, []), ["feature"], "value")
    quartiles = prefix.exact_quantiles(
        counts, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, keys=["feature"]
    )
    return stats.join(F.broadcast(quartiles), "feature", "left")


def search(report: DataFrame, contains: str = "", sort: str = "diff") -> DataFrame:
    """Filter a class-means report by feature name and sort it."""
    orders = {
        "name": [F.col("feature")],
        "diff": [_largest("toxic_minus_non_toxic"), F.col("feature")],
    }
    if sort not in orders:
        raise ValueError(f"sort must be one of {sorted(orders)}")
    found = report.filter(F.lower("feature").contains(contains.lower()))
    return found.orderBy(*orders[sort])
