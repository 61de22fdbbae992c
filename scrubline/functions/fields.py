"""Rules for single fields: part numbers, emails, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.fixed import CURRENT_ERA, ERA_2019, LEGACY_ERA, MISSING_EMAILS
from scrubline.functions.text import strip


def era(part_number: Column) -> Column:
    """Naming era of a part number; NULL and unmatched text are ``unknown``."""
    text = strip(part_number)
    return (
        F.when(text.rlike(CURRENT_ERA), "current")
        .when(text.rlike(ERA_2019), "2019")
        .when(text.rlike(LEGACY_ERA), "legacy")
        .otherwise("unknown")
    )


def normalized_part_number(part_number: Column) -> Column:
    """Older eras to ``PN-`` plus at least four digits; other text only stripped.

    Works on the digits as text, so long numbers neither overflow nor get cut.
    """
    text = strip(part_number)
    older = text.rlike(ERA_2019) | text.rlike(LEGACY_ERA)
    # What the eras put after their last letter or dash.
    digits = F.ltrim(F.regexp_extract(text, r"(\d+)$", 1), F.lit("0"))
    padded = F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0"))
    return F.when(older, F.concat(F.lit("PN-"), padded)).otherwise(text)


def invalid_email(email: Column) -> Column:
    """Malformed address: no ``@``, ``.invalid`` suffix, or a space inside.

    Missing values are another kind of defect and count as valid here.
    """
    text = strip(email)
    malformed = ~text.contains("@") | text.endswith(".invalid") | text.contains(" ")
    return F.coalesce(malformed & ~text.isin(MISSING_EMAILS), F.lit(False))


# Tried in this order for text that is neither in ISO form nor three numbers with separators.
DATE_FORMATS = [
    "yyyy/M/d",
    "yyyy/M/d H:mm:ss",
    "yyyyMMdd",
    "d MMM yyyy",
    "d MMM yyyy H:mm:ss",
    "d-MMM-yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMMM yyyy",
]
# Day and month in either order, with the year behind them: first number, separator, second number.
DAY_AND_MONTH = r"^(\d{1,2})([/.-])(\d{1,2})\2\d{4}(?!\d)"
SEPARATORS = "/.-"
_TIMES = ["", " H:mm", " H:mm:ss"]


def lenient_timestamp(value: Column, formats: list[str] | None = None, day_first: str = "") -> Column:
    """Timestamp, or NULL where the value does not parse.

    ISO text first, then the formats in order. Without ``formats``, numbers like 3/4/2024 are read
    month before day, or day before month if their separator is one of ``day_first``, and the other
    way round where that gives no date. A time without a date is no timestamp, so no result depends
    on the day of the run.
    """
    text = strip(value.cast("string"))
    iso = F.when(text.rlike(r"^\d{4}(-|$)"), F.try_to_timestamp(text))
    read = lambda value, given: F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in given])
    if formats is not None:
        others = read(text, formats) if formats else F.lit(None)
    else:
        slashed = F.regexp_replace(text, r"^(\d{1,2})[.-](\d{1,2})[.-]", "$1/$2/")
        orders = [[f"{order}/yyyy{time}" for time in _TIMES] for order in ("M/d", "d/M")]
        numbers = F.when(
            F.regexp_extract(text, DAY_AND_MONTH, 2).isin(list(day_first)), read(slashed, orders[1] + orders[0])
        ).otherwise(read(slashed, orders[0] + orders[1]))
        others = F.when(text.rlike(DAY_AND_MONTH), numbers).otherwise(read(text, DATE_FORMATS))
    # Most text is in ISO form, so the formats are tried on the rest only.
    return F.coalesce(iso, F.when(text.rlike(r"\d{1,2}.*\d"), others))


def closed_before_opened(opened: Column, closed: Column) -> Column:
    """NULL, which a filter drops, where either side is missing or does not parse."""
    return closed < opened
