"""Column expressions: text, dates, status rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days late and their colours, arrows per trend, label length.
GREEN_UP_TO = 7
AMBER_FROM = 8
RED_FROM = 14
COMPLETED_COLOUR = "Blue"
ARROWS = {"Green": "larrow", "Red": "rarrow"}
OTHER_ARROW = "darrow"
AMBER_CODE = "#ff7f0e"
LABEL_LENGTH = 100


def money_to_int(text: Column) -> Column:
    """``$4,000.00`` to 400000: currency sign, commas and the point go, cents stay."""
    return F.regexp_replace(text, r"[$,.]", "").cast("bigint")


def drop_last(text: Column, n: int) -> Column:
    """The text without its last ``n`` characters."""
    return F.substring(text, F.lit(1), F.greatest(F.length(text) - n, F.lit(0)))


def shorten(text: Column, limit: int = LABEL_LENGTH) -> Column:
    """Texts over ``limit`` characters end in three dots and are ``limit`` long."""
    cut = F.concat(F.substring(text, F.lit(1), F.lit(limit - 3)), F.lit("..."))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def count_character(text: Column, character: str) -> Column:
    """Occurrences of a character, ignoring case."""
    lowered = F.lower(text)
    return F.length(lowered) - F.length(F.replace(lowered, F.lit(character.lower()), F.lit("")))


def day_first(text: Column) -> Column:
    """Date from ``dd/MM/yyyy``; null when it is none."""
    return F.try_to_date(text, "dd/MM/yyyy")


def month_label(date: Column) -> Column:
    return F.date_format(date, "MMM yyyy")


def partition_date(year: Column, month: Column, day: Column) -> Column:
    """The date named by three partition folders."""
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def date_parts(date: Column, prefix: str) -> dict[str, Column]:
    """Year, month, day, weekday (Monday 0) and day of year."""
    return {
        f"{prefix}Year": F.year(date),
        f"{prefix}Month": F.month(date),
        f"{prefix}Day": F.dayofmonth(date),
        f"{prefix}Dayofweek": F.weekday(date),
        f"{prefix}Dayofyear": F.dayofyear(date),
    }


def month_starts(first: Column, last: Column) -> Column:
    """Array of the month starts that lie in ``[first, last]``."""
    top = F.trunc(first, "month")
    begin = F.when(top < first, F.add_months(top, 1)).otherwise(top)
    return F.when(begin <= last, F.sequence(begin, last, F.expr("INTERVAL 1 MONTH"))).otherwise(
        F.array().cast("array<date>")
    )


def variance_rag(days: Column) -> Column:
    """Red from 14 days late, Amber from 8, Green up to 7, else empty (also for null)."""
    return (
        F.when(days <= GREEN_UP_TO, "Green")
        .when((days >= AMBER_FROM) & (days < RED_FROM), "Amber")
        .when(days >= RED_FROM, "Red")
        .otherwise("")
    )


def milestone_rag(days: Column, status: Column, completed: str = "Completed") -> Column:
    """The variance colour, or Blue for a completed activity."""
    return F.when(status == completed, COMPLETED_COLOUR).otherwise(variance_rag(days))


def trend_arrow(trend: Column) -> Column:
    arrows = F.create_map(*[F.lit(x) for pair in ARROWS.items() for x in pair])
    return F.coalesce(F.try_element_at(arrows, trend), F.lit(OTHER_ARROW))
