"""Recodes, bands and source flags, with the fixed code lists of the data model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from spinewise.functions.missing import col, if_else

MISSING = "Missing"

# Code lists and labels of the data model.
HOSPITAL_ETHNICITY = {
    1: "White",
    2: "Mixed",
    3: "Asian or Asian British",
    4: "Black or Black British",
    5: "Other",
    0: "Missing",
    9: "Missing",
}
COMMUNITY_ETHNICITY = {
    "A": "White",
    "B": "White",
    "C": "White",
    "M": "Black or Black British",
    "P": "Black or Black British",
    "S": "Other",
    "NA_": "Missing",
}
SEX = {1: "Male", 2: "Female"}
ETHNICITY_LEVELS = [
    "White",
    "Black or Black British",
    "Asian or Asian British",
    "Mixed",
    "Other",
    "Missing",
]
SEX_LEVELS = ["Female", "Male", "Missing"]
DEPRIVATION_FIFTHS = [
    "Most deprived fifth",
    "Second most deprived fifth",
    "Middle fifth",
    "Second least deprived fifth",
    "Least deprived fifth",
]
NURSING_TYPE = {
    "Nursing": "Nursing",
    "Nursing and Residential": "Nursing",
    "Residential": "Residential",
}
YES_NO = {"Yes": 1, "No": 0}
AGE_LEVELS = ["<65", "65-79", ">=80"]


def recode(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Map codes to labels; anything not listed, null included, becomes ``default``."""
    c = col(c)
    chain = F
    for code, label in mapping.items():
        chain = chain.when(c == F.lit(code), F.lit(label))
    return chain.otherwise(F.lit(default))


def band(c: Column | str, cuts: Sequence[tuple[float, str]], above: str, missing: str | None = None) -> Column:
    """Label a number by the first ``(upper, label)`` it does not exceed, else ``above``."""
    c = col(c)
    chain = F.when(c.isNull(), F.lit(missing))
    for upper, label in cuts:
        chain = chain.when(c <= upper, F.lit(label))
    return chain.otherwise(F.lit(above))


def bed_capacity(beds: Column | str) -> Column:
    return band(beds, [(24, "0-24"), (49, "25-49")], "50+", MISSING)


def years_registered(years: Column | str) -> Column:
    return band(years, [(10, "Less than 10 years")], "More than 10 years", MISSING)


def age_group(age: Column | str) -> Column:
    """Three bands of a whole-number age; null stays null."""
    age = col(age)
    return F.when(age < 65, "<65").when(age < 80, "65-79").when(age >= 80, ">=80")


def decile_to_fifth(decile: Column | str, labels: Sequence[str] = tuple(DEPRIVATION_FIFTHS)) -> Column:
    """Pair deciles 1..10 into five labels; anything else is null."""
    decile = col(decile).cast("int")
    return F.when(
        decile.between(1, 2 * len(labels)),
        F.element_at(F.array(*[F.lit(x) for x in labels]), F.ceil(decile / 2).cast("int")),
    )


def priority_coalesce(cols: Sequence[Column | str], missing: str | None = MISSING) -> Column:
    """First source holding a value; the missing label (or null) if none does."""
    known = [col(c) if missing is None else F.nullif(col(c), F.lit(missing)) for c in cols]
    return F.coalesce(*known, *([] if missing is None else [F.lit(missing)]))


def any_source_flag(cols: Sequence[Column | str]) -> Column:
    """1 if any known source is 1; null if no source is known; else 0."""
    cols = [col(c) for c in cols]
    return (
        F.when(reduce(and_, [c.isNull() for c in cols]), F.lit(None).cast("int"))
        .when(reduce(or_, [c == 1 for c in cols]), 1)
        .otherwise(0)
    )


def either_flag(a: Column | str, b: Column | str) -> Column:
    """1 if either is 1, 0 if both are known and are not, null otherwise."""
    return if_else((col(a) == 1) | (col(b) == 1), F.lit(1), F.lit(0))


def at_least_one(c: Column | str) -> Column:
    """1 for a count of one or more, 0 otherwise (unknown included)."""
    return F.when(col(c) >= 1, 1).otherwise(0)


def differs(a: Column | str, b: Column | str, tolerance_days: int | None = None) -> Column:
    """'Different' or 'Same', by equality or by a tolerance in days; null if either is unknown."""
    a, b = col(a), col(b)
    test = (a != b) if tolerance_days is None else F.abs(F.datediff(a, b)) > tolerance_days
    return if_else(test, F.lit("Different"), F.lit("Same"))


def availability(c: Column | str) -> Column:
    return F.when(col(c).isNull(), "Missing").otherwise("Available")
