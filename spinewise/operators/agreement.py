"""Coverage of an attribute by each source and agreement between sources.

Every table here is one pass: all sources or all pairs are counted in the same aggregate, which
combines on the map side, and only the small result is reshaped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial, reduce
from itertools import combinations
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.functions.missing import known_in_all, n_distinct
from spinewise.functions.recode import MISSING, availability, differs

TOTAL = "Total"
#: What is known but not in a list of levels, and, as a column, what is unknown.
NOT_LISTED, UNKNOWN = "(not listed)", "(unknown)"


def _rows(wide: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One-row table to one row per entry; each entry gives the columns of its row."""
    entries = F.array(*[F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows])
    return wide.select(F.inline(entries))


def _share(n: Column, total: Column) -> Column:
    """Share of a total, null where there is nothing to share."""
    return F.try_divide(n.cast("double"), total)


def frequency(df: DataFrame, c: str, levels: Sequence[str] | None = None, total: bool = True) -> DataFrame:
    """Rows per level of a column and their share, with a total row: level, n, percent.

    With ``levels`` the table has these rows in any case; without, one row for each level found.
    """
    table = source_coverage(df, {"rows": c}, levels, total)
    return table.withColumnsRenamed({"n_rows": "n", "percent_rows": "percent"})


def source_coverage(
    df: DataFrame,
    sources: Mapping[str, str],
    levels: Sequence[str] | None = None,
    total: bool = True,
    valid: bool = False,
) -> DataFrame:
    """Rows per level and share for several sources side by side: level, n_<source>, percent_<source>.

    Counts add up to the rows: what is not in ``levels`` has a row of its own, and so has null, wherever
    there is any. With ``valid``, and where no levels are given, valid_percent_<source> is the share among known rows.
    """
    if levels is not None:
        return _coverage_of_levels(df, sources, levels, total)
    texts = [F.col(c).cast("string").alias(c) for c in sources.values()]
    stacked = df.select(*texts).unpivot([], list(sources.values()), "_column", "level")
    counts = stacked.groupBy("level").agg(
        *[F.count_if(F.col("_column") == c).alias(f"n_{s}") for s, c in sources.items()]
    )
    # The totals come from the counts, whose shuffle Spark reuses. All sources share one total, since
    # every row has one level in every source.
    first = next(iter(sources))
    parts = [F.expr(f"coalesce(sum(n_{first}), 0) as rows")]
    parts += [F.expr(f"coalesce(sum(if(level is null, 0, n_{s})), 0) as known_{s}") for s in sources]
    totals = counts.agg(F.struct(*parts).alias("totals")).scalar().alias("_totals")
    rows = F.col("_totals.rows")
    cells, bottom = [], []
    for s in sources:
        n, known = F.col(f"n_{s}"), F.col(f"_totals.known_{s}")
        cells += [n, _share(n, rows).alias(f"percent_{s}")]
        bottom += [rows.alias(f"n_{s}"), _share(rows, rows).alias(f"percent_{s}")]
        if valid:
            cells.append(F.when(F.col("level").isNotNull(), _share(n, known)).alias(f"valid_percent_{s}"))
            bottom.append(_share(known, known).alias(f"valid_percent_{s}"))
    shared = counts.select("*", totals).select("level", *cells)
    if not total:
        return shared
    last = df.sparkSession.range(1).select(totals).select(F.lit(TOTAL).alias("level"), *bottom)
    return shared.unionByName(last)


def _coverage_of_levels(df, sources, levels, total) -> DataFrame:
    tests = [lambda c, level=level: c.eqNullSafe(F.lit(level)) for level in levels]
    tests += [lambda c: c.isNotNull() & ~c.isin(list(levels)), lambda c: c.isNull()]
    counted = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(test(F.col(c))).alias(f"_{i}_{j}") for i, c in enumerate(sources.values()) for j, test in enumerate(tests)],
    )
    names = ["level", *[x for s in sources for x in (f"n_{s}", f"percent_{s}")], "_shown"]
    shown = [F.lit(True)] * len(levels) + [
        reduce(or_, [F.col(f"_{i}_{j}") > 0 for i in range(len(sources))]) for j in (len(levels), len(levels) + 1)
    ]
    rows = [
        [
            F.lit(level),
            *[x for i in range(len(sources)) for x in (F.col(f"_{i}_{j}"), _share(F.col(f"_{i}_{j}"), F.col("_all")))],
            shown[j],
        ]
        for j, level in enumerate([*levels, NOT_LISTED, None])
    ]
    if total:
        rows.append([F.lit(TOTAL), *[x for _ in sources for x in (F.col("_all"), _share(F.col("_all"), F.col("_all")))], F.lit(True)])
    return _rows(counted, rows, names).where("_shown").drop("_shown")


def availability_coverage(df: DataFrame, sources: Mapping[str, str], total: bool = True) -> DataFrame:
    """Available and missing rows per source."""
    flags = df.select(*[availability(c).alias(c) for c in sources.values()])
    return source_coverage(flags, sources, ["Available", "Missing"], total)


def crosstab(df: DataFrame, rows: str, cols: str, col_levels: Sequence[str], total: str = TOTAL) -> DataFrame:
    """Two-way counts, one row per level of ``rows`` and a total row, one column per column level.

    The last column counts all rows of the level, and what is not in ``col_levels`` or null has a column
    each, so that the columns add up to it. Null row levels are shown as null.
    """
    c = F.col(cols)
    counted = df.rollup(rows).agg(
        F.grouping(rows).alias("_total"),
        *[F.count_if(c.eqNullSafe(F.lit(level))).alias(str(level)) for level in col_levels],
        F.count_if(c.isNotNull() & ~c.isin(list(col_levels))).alias(NOT_LISTED),
        F.count_if(c.isNull()).alias(UNKNOWN),
        F.count(F.lit(1)).alias(total),
    )
    label = F.when(F.col("_total") == 1, total).otherwise(F.col(rows).cast("string"))
    return counted.select(label.alias(rows), *[str(level) for level in col_levels], f"`{NOT_LISTED}`", f"`{UNKNOWN}`", total)


Difference = Callable[[str, str], Column]


def within_days(days: int) -> Difference:
    """A difference test for dates: over ``days`` days apart."""
    return partial(differs, tolerance_days=days)


def pairwise_agreement(
    df: DataFrame,
    sources: Mapping[str, str],
    pairs: Sequence[tuple[str, str]] | None = None,
    difference: Difference = differs,
    missing: str | None = MISSING,
) -> DataFrame:
    """Among rows known in both sources of a pair, how many are the same: pair, level, n, percent."""
    return agreement_counts(df, sources, pairs, difference, missing, everyone=False)


def all_source_agreement(
    df: DataFrame,
    sources: Mapping[str, str],
    difference: Difference = differs,
    missing: str | None = MISSING,
) -> DataFrame:
    """Among rows known in every source, how many are the same in all: level, n, percent."""
    return agreement_counts(df, sources, [], difference, missing).drop("pair")


def agreement_counts(
    df: DataFrame,
    sources: Mapping[str, str],
    pairs: Sequence[tuple[str, str]] | None = None,
    difference: Difference = differs,
    missing: str | None = MISSING,
    everyone: bool = True,
) -> DataFrame:
    """All-source ('all') and pairwise agreement in long form: pair, level, n, percent."""
    pairs = list(combinations(sources, 2)) if pairs is None else list(pairs)
    counted, groups = _agreement(df, sources, pairs, difference, missing, everyone)
    rows = [
        [F.lit(name), F.lit(level), n, _share(n, known)]
        for name, known, same in groups
        for level, n in (("Different", known - same), ("Same", same), (TOTAL, known))
    ]
    return _rows(counted, rows, ["pair", "level", "n", "percent"])


def agreement_report(
    df: DataFrame,
    sources: Mapping[str, str],
    pairs: Sequence[tuple[str, str]] | None = None,
    difference: Difference = differs,
    missing: str | None = MISSING,
) -> DataFrame:
    """All-source and pairwise agreement side by side: level, n_all, percent_all, n_<a>_<b>, ..."""
    pairs = list(combinations(sources, 2)) if pairs is None else list(pairs)
    counted, groups = _agreement(df, sources, pairs, difference, missing, True)
    names = ["level", *[x for name, _, _ in groups for x in (f"n_{name}", f"percent_{name}")]]
    rows = []
    for level, pick in (
        ("Different", lambda known, same: known - same),
        ("Same", lambda known, same: same),
        (TOTAL, lambda known, same: known),
    ):
        cells = [(pick(known, same), known) for _, known, same in groups]
        rows.append([F.lit(level), *[x for n, known in cells for x in (n, _share(n, known))]])
    return _rows(counted, rows, names)


def _agreement(df, sources, pairs, difference, missing, everyone):
    """One-row counts, and for each group of sources its name, known rows and equal rows."""
    groups = {"all": list(sources)} if everyone else {}
    groups |= {f"{a}_{b}": [a, b] for a, b in pairs}
    aggs, out = [], []
    for i, (name, members) in enumerate(groups.items()):
        cols = [sources[m] for m in members]
        known = known_in_all(cols, missing)
        same = reduce(and_, [difference(a, b) == "Same" for a, b in combinations(cols, 2)])
        aggs += [F.count_if(known).alias(f"_known{i}"), F.count_if(known & same).alias(f"_same{i}")]
        out.append((name, F.col(f"_known{i}"), F.col(f"_same{i}")))
    return df.agg(*aggs), out


def link_checks(df: DataFrame, keys: Sequence[str] = (), known: Sequence[str] = (), **tests: Column) -> DataFrame:
    """Counts a person reads after linking, in one row.

    ``rows``; ``distinct_<k>`` per key, a missing key counting as one; ``known_<c>`` and
    ``missing_<c>`` per column; and one count per named test.
    """
    aggs = [F.count(F.lit(1)).alias("rows"), *[n_distinct(k).alias(f"distinct_{k}") for k in keys]]
    for c in known:
        aggs += [F.count(c).alias(f"known_{c}"), F.count_if(F.col(c).isNull()).alias(f"missing_{c}")]
    aggs += [F.count_if(test).alias(name) for name, test in tests.items()]
    return df.agg(*aggs)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct rows of a projection, as a one-row table with column ``n``."""
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("n"))


def tally(df: DataFrame, *by: str) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
