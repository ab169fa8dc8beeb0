"""Lists of column names, computed before the plan is built."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType


def with_prefix(df: DataFrame, *prefixes: str, ignore_case: bool = True) -> list[str]:
    """Columns starting with any prefix, in the order of the frame."""
    fold = str.lower if ignore_case else str
    wanted = tuple(fold(p) for p in prefixes)
    return [c for c in df.columns if fold(c).startswith(wanted)]


def with_suffix(df: DataFrame, *suffixes: str, ignore_case: bool = True) -> list[str]:
    fold = str.lower if ignore_case else str
    wanted = tuple(fold(s) for s in suffixes)
    return [c for c in df.columns if fold(c).endswith(wanted)]


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def without(df: DataFrame, dropped: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(dropped)]


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Those of the wanted columns the frame has, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def add_suffix(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.toDF(*[c if c in keep else c + suffix for c in df.columns])


def lead_with(df: DataFrame, *first: str) -> DataFrame:
    """Move the named columns to the front."""
    return df.select(*first, *without(df, first))
