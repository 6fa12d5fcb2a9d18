"""Signature timestamps such as ``14:30, 5 May 2024 (UTC)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: month names, in order
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November", "December",
)
_GAP = r"[\s\p{Z}]+"
_WORD = r"[\p{L}\p{N}_]+"
STAMP = (
    rf"([0-9]{{2}}):([0-9]{{2}}),{_GAP}([0-9]{{1,2}}){_GAP}({_WORD}){_GAP}([0-9]{{4}}){_GAP}\(UTC\)"
)


def signature_timestamp(text: Column) -> Column:
    """First signature timestamp of ``text``.

    An unknown month word counts as January; an impossible date or time is NULL.
    """

    def part(i: int) -> Column:
        return F.regexp_extract(text, STAMP, i)

    def number(i: int) -> Column:
        return F.try_to_number(part(i), F.lit("9999")).cast("int")

    month = F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), part(4)), F.lit(0)),
        F.lit(1),
    ).cast("int")
    stamp = F.try_make_timestamp_ntz(
        number(5), month, number(3), number(1), number(2), F.lit(0)
    )
    return F.when((number(5) >= 1) & (number(1) < 24), stamp)
