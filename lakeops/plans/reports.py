"""Milestone and sales reports as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.scalars import (
    AMBER_CODE, COMPLETED_COLOUR, milestone_rag, month_label, month_starts, shorten, trend_arrow,
)
from lakeops.operators.joins import weighted_totals
from lakeops.operators.ranking import current_and_earlier, group_ordinals, slots, top_per
from lakeops.operators.sets import stack_dates


def milestone_variance(df: DataFrame, code: str, snapshot: str, baseline: str, finish: str, status: str,
                       tie: Column, pattern: str | None = None) -> DataFrame:
    """One row per code and snapshot: variance in days, colour and snapshot ordinals.

    A missing baseline is the finish; rows with neither are left out. Of several
    rows of a code and snapshot the one with the latest baseline stands.
    """
    rows = df.dropna(how="all").withColumn(code, F.trim(F.col(code))).dropna(subset=[code])
    if pattern:
        rows = rows.where(F.col(code).rlike(pattern))
    rows = rows.withColumn(baseline, F.coalesce(baseline, finish)).dropna(subset=[baseline])
    rows = rows.withColumn("variance_days", F.date_diff(finish, baseline))
    rows = rows.withColumn("rag", milestone_rag(F.col("variance_days"), F.col(status)))
    # one row per code and snapshot first, so the ordinal join and flag see the small table;
    # every snapshot keeps at least one row, which leaves the ordinals as they are
    chosen = top_per(rows, [code, snapshot], baseline, tie)
    return current_and_earlier(group_ordinals(chosen, snapshot), snapshot)


def milestone_axis(df: DataFrame, baseline: str, finish: str) -> DataFrame:
    """Month starts from a month before the first date to a month after the last."""
    dates = stack_dates(df, baseline, finish)
    ends = dates.agg(F.min("d").alias("first"), F.max("d").alias("last"))
    spine = F.explode(month_starts(F.add_months("first", -1), F.add_months("last", 1)))
    return ends.withColumn("month_start", spine).select(
        "month_start",
        F.year("month_start").alias("year"),
        F.date_format("month_start", "MMM").alias("month"),
        "first", "last",
    )


def milestone_tracker(df: DataFrame, programme: str, name: str, baseline: str, forecast: str,
                      status: str, trend: str, first_seen: str) -> DataFrame:
    """One row per activity: slot, short name, month labels, colour and arrow."""
    rows = df.dropna(how="all")
    # one row per programme and activity, the earliest in the file among the earliest baselines
    first = F.min_by(F.struct(baseline, forecast, status, trend), F.struct(baseline, first_seen))
    each = rows.groupBy(programme, name).agg(first.alias("__r"), F.min(first_seen).alias("__seen"))
    placed = slots(each.select(programme, name, "__r.*", "__seen"), programme, "__seen", baseline, name)
    colour = F.when(F.col(trend) == "Amber", AMBER_CODE).otherwise(F.col(trend))
    return placed.select(
        "slot", programme, name,
        shorten(F.col(name)).alias("label"),
        month_label(F.col(baseline)).alias("baseline_label"),
        month_label(F.col(forecast)).alias("forecast_label"),
        F.when(F.col(status) == "Complete", COMPLETED_COLOUR).otherwise(F.col(status)).alias("status_colour"),
        trend_arrow(F.col(trend)).alias("arrow"),
        colour.alias("trend_colour"),
    )


def daily_totals(sales: DataFrame, prices: DataFrame, day: str, item: str, quantity: str, price: str) -> DataFrame:
    """Quantity and price-weighted total per day."""
    quantities = sales.groupBy(day).agg(F.sum(quantity).alias("quantity"))
    # both sides have one row per day
    return quantities.join(weighted_totals(sales, prices, day, item, quantity, price), day)
