"""Decision rule, comment ids and input checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the moderation rules.
DEFAULT_AUTO, DEFAULT_MANUAL = 0.75, 0.55
DECISIONS = ("auto-ban", "manual-ban", "manual-review", "none", "flagged")
SORTS = (
    "toxicity_desc", "toxicity_asc", "timestamp_desc", "timestamp_asc", "decision_asc",
)
LIMIT_RANGE, OFFSET_RANGE = (1, 200), (0, 1_000_000)
MAX_TEXT = 10_000
SEVERITY = {"auto-ban": 1, "manual-ban": 2, "manual-review": 3}


def decide(toxicity: Column, auto, manual) -> Column:
    """Automatic decision of a score; a missing score counts as 0."""
    score = F.coalesce(toxicity, F.lit(0.0))
    return (
        F.when(score >= auto, "auto-ban")
        .when(score >= manual, "manual-review")
        .otherwise("none")
    )


def comment_id(timestamp: Column, author: Column, text: Column) -> Column:
    blank = F.lit("")
    return F.md5(
        F.concat_ws(
            "-",
            F.coalesce(timestamp, blank), F.coalesce(author, blank), F.coalesce(text, blank),
        )
    )


def severity(decision: Column) -> Column:
    pick = F.lit(4)
    for name, rank in SEVERITY.items():
        pick = F.when(decision == name, rank).otherwise(pick)
    return pick


def risk_tier(relative_risk: Column) -> Column:
    return (
        F.when(relative_risk >= 2.5, "High")
        .when(relative_risk >= 1.25, "Elevated")
        .when(relative_risk <= 0.75, "Low")
        .otherwise("Baseline")
    )


def violations(
    *, limit: Column, offset: Column, auto: Column, manual: Column,
    decision: Column, sort: Column, text: Column,
) -> Column:
    """Names of the broken input rules of a row, in a fixed order.

    NULL means "not given" for everything but the text.
    """

    def outside(value: Column, low, high) -> Column:
        return value.isNotNull() & ~value.between(low, high)

    rules = {
        "limit": outside(limit, *LIMIT_RANGE),
        "offset": outside(offset, *OFFSET_RANGE),
        "auto_threshold": outside(auto, 0.0, 1.0),
        "manual_threshold": outside(manual, 0.0, 1.0),
        "threshold_order": manual > auto,
        "decision": decision.isNotNull() & ~decision.isin(list(DECISIONS)),
        "sort": sort.isNotNull() & ~sort.isin(list(SORTS)),
        "missing_text": F.trim(F.coalesce(text, F.lit(""))) == "",
        "text_too_long": F.length(text) > MAX_TEXT,
    }
    return F.array_compact(F.array(*[F.when(bad, name) for name, bad in rules.items()]))


def check_thresholds(auto: float, manual: float) -> None:
    for name, value in (("auto_threshold", auto), ("manual_threshold", manual)):
        if not 0.0 <= value <= 1.0:
            raise ValueError(f"{name} must be between 0 and 1")
    if manual > auto:
        raise ValueError("manual_threshold must be <= auto_threshold")


def check_page(limit: int, offset: int, decision: str | None, sort: str | None) -> None:
    for name, value, (low, high) in (
        ("limit", limit, LIMIT_RANGE), ("offset", offset, OFFSET_RANGE),
    ):
        if not low <= value <= high:
            raise ValueError(f"{name} must be between {low} and {high}")
    if decision and decision not in DECISIONS:
        raise ValueError(f"decision must be one of {sorted(DECISIONS)}")
    if sort and sort not in SORTS:
        raise ValueError(f"sort must be one of {sorted(SORTS)}")
