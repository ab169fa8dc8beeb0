"""Bringing one attribute from several sources to shared levels and to one value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinewise.functions.dates import age_years, days_apart, within_lookback
from spinewise.functions.missing import if_else, round_even
from spinewise.functions.recode import (
    MISSING,
    age_group,
    availability,
    decile_to_fifth,
    priority_coalesce,
    recode,
)
from spinewise.operators.link import lookup


def harmonise(df: DataFrame, sources: Mapping[str, tuple[str, Mapping | None]], default=MISSING) -> DataFrame:
    """Recode each source column to shared levels; ``sources`` maps a new name to (column, codes).

    Without codes the column keeps its values and only null becomes the default.
    """
    return df.withColumns(
        {
            out: F.coalesce(F.col(c), F.lit(default)) if codes is None else recode(c, codes, default)
            for out, (c, codes) in sources.items()
        }
    )


def prioritise(df: DataFrame, out: str, sources: Sequence[str], missing: str | None = MISSING) -> DataFrame:
    """Add ``out``: the value of the first source that has one."""
    return df.withColumn(out, priority_coalesce(sources, missing))


def area_fifth(df: DataFrame, table: DataFrame, area: str, table_area: str, table_decile: str) -> DataFrame:
    """Attach the deprivation decile of the area and its label in fifths."""
    linked = lookup(df, table, area, table_area, {table_decile: "IMD_decile"})
    return linked.withColumn("IMD_quintile", decile_to_fifth("IMD_decile"))


def date_disagreement(df: DataFrame, pairs: Mapping[str, tuple[str, str]], days: int = 30) -> DataFrame:
    """Per pair of date columns 'Disagree' if more than ``days`` apart, else 'Agree', null if unknown."""
    return df.withColumns(
        {
            out: if_else(days_apart(a, b) > days, F.lit("Disagree"), F.lit("Agree"))
            for out, (a, b) in pairs.items()
        }
    )


def anchor_flag(df: DataFrame, date: str, anchor: str, out: str, days: int = 365) -> DataFrame:
    """Whether the date is the anchor or up to ``days`` days before it; null if either is unknown."""
    return df.withColumn(out, within_lookback(date, anchor, days))


def age_band(df: DataFrame, birth: str, at: str, out: str = "age_cat", age: str | None = None) -> DataFrame:
    """Age at a date rounded to whole years, in three bands; null if a date is unknown."""
    years = round_even(age_years(birth, at))
    if age is not None:
        df = df.withColumn(age, years.cast("int"))
    return df.withColumn(out, age_group(years))


def available(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """'Available' or 'Missing' per column; ``columns`` maps a new name to the column."""
    return df.withColumns({out: availability(c) for out, c in columns.items()})
