"""Missing-value rules as Spark columns.

Spark's ``sum`` skips nulls, ``when`` treats a null test as false and ``null IN (..)`` is null. The
data sets this library builds need the other reading in several places, so each rule has one named
function here and the operators use only these.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def if_else(test: Column, yes, no) -> Column:
    """``yes`` where the test holds, ``no`` where it does not, null where it is unknown."""
    return F.when(test, yes).when(~test, no)


def is_in(c: Column | str, values: Iterable) -> Column:
    """Membership that is never null: an unknown value is in no list."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def all_known(c: Column | str) -> Column:
    """Aggregate: true when no row of the group is null in ``c``."""
    return F.count(col(c)) == F.count(F.lit(1))


def sum_strict(c: Column | str) -> Column:
    """Aggregate: sum, null as soon as one row of the group is null."""
    return F.when(all_known(c), F.sum(col(c)))


def max_strict(c: Column | str) -> Column:
    """Aggregate: maximum, null as soon as one row of the group is null."""
    return F.when(all_known(c), F.max(col(c)))


def count_if_strict(test: Column) -> Column:
    """Aggregate: rows where the test holds, null as soon as it is unknown for one row."""
    return F.when(all_known(test), F.count_if(test))


def count_known(c: Column | str) -> Column:
    return F.count(col(c))


def count_missing(c: Column | str) -> Column:
    return F.count_if(col(c).isNull())


def n_distinct(c: Column | str) -> Column:
    """Aggregate: distinct values, a missing value counting as one of them."""
    return F.count_distinct(col(c)) + F.coalesce(F.max(col(c).isNull().cast("bigint")), F.lit(0))


def row_sum(cols: Sequence[Column | str]) -> Column:
    """Sum across columns of a row; null if any part is null."""
    return reduce(add, [col(c) for c in cols])


def row_any(cols: Sequence[Column | str]) -> Column:
    """1 if the row sum is above zero, else 0; null if any part is null."""
    return if_else(row_sum(cols) > 0, F.lit(1), F.lit(0))


def known_in_all(cols: Sequence[Column | str], missing: str | None = "Missing") -> Column:
    """True where every column holds a value other than null or the missing label."""
    def known(c):
        c = col(c)
        return c.isNotNull() if missing is None else c.isNotNull() & (c != missing)

    return reduce(and_, [known(c) for c in cols])


def value_to_null(c: Column | str, *values) -> Column:
    """Replace codes that stand for 'unknown' by null."""
    return if_else(is_in(c, values), F.lit(None), col(c))


def blank_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty text becomes null in the given string columns (all of them by default)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in columns})


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even, as the report tables do."""
    return F.bround(col(c), digits)


def equal_keys(left: Column, right: Column, null_safe: bool = False) -> Column:
    """Join test; ``null_safe`` makes a missing key match a missing key."""
    return left.eqNullSafe(right) if null_safe else left == right
