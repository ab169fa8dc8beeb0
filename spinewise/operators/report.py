"""Summary tables over a person-level table.

Each table is one aggregate over all its variables at once, never one job per variable. Where there are many, a row
is cut into blocks of a few values, so that the code of the aggregate stays small however many they are.
Variables are named by the caller; none is picked by looking at the data. Numbers stay numbers: the text forms
'mean (sd)' and 'p%' are separate functions at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from spinewise.functions.missing import col, count_if_strict, if_else, round_even, row_any, row_sum
from spinewise.functions.names import with_prefix
from spinewise.functions.recode import at_least_one
from spinewise.operators.agreement import _rows, _share
from spinewise.sources.stages import staged

UNKNOWN = "Unknown"
MISSING_LEVEL = "(Missing)"
OVERALL = "Overall"
COMPLETE = "(complete)"
#: Distinct values that are ranked one by one.
MOST_RANKED = 10_000
# What is added to the name of a column that was made of another.
MARKS = ["_binary", "_colsum"]
#: Levels of a stratum, at most: each is a block of columns.
MOST_LEVELS = 200
#: Values of a row that are aggregated side by side; with hundreds the JVM takes long to compile the code, and runs it slowly until then.
BLOCK = 8


def row_scores(df: DataFrame, sums: Mapping[str, Sequence[str]] = {}, flags: Mapping[str, Sequence[str]] = {}) -> DataFrame:
    """Add row sums, and flags for a row sum above zero; null if any part is null."""
    df = df.withColumns({out: row_any(cols) for out, cols in flags.items()}) if flags else df
    return df.withColumns({out: row_sum(cols) for out, cols in sums.items()}) if sums else df


def _in_blocks(df: DataFrame, values: Sequence[Column], stats: Mapping[str, Callable[[Column], Column]], by: Sequence[str] = ()) -> DataFrame:
    """``by``, _place (of the value in ``values``, from 0), and the aggregates ``stats`` of each value, in every group that has rows.

    The values have one type. A row becomes one row for each block of them, in the task that reads it.
    """
    places = range(-(-len(values) // BLOCK) * BLOCK)
    # The last block is filled up with the last value, and these places are dropped.
    wide = df.select(*by, *[values[min(i, len(values) - 1)].alias(f"_v{i}") for i in places])
    blocks = ", ".join(f"({', '.join(f'_v{at + j}' for j in range(BLOCK))}) as `{at}`" for at in places[::BLOCK])
    names = ", ".join(f"_{j}" for j in range(BLOCK))
    long = df.sparkSession.sql(f"select * from {{wide}} unpivot include nulls (({names}) for _at in ({blocks}))", wide=wide)
    aggs = [agg(F.col(f"_{j}")).alias(f"_{j}_{n}") for j in range(BLOCK) for n, agg in stats.items()]
    entry = [F.struct((F.col("_at").cast("int") + j).alias("_place"), *[F.col(f"_{j}_{n}").alias(n) for n in stats]) for j in range(BLOCK)]
    return long.groupBy(*by, "_at").agg(*aggs).select(*by, F.inline(F.array(*entry))).where(F.col("_place") < len(values))


def _each(df: DataFrame, names: Sequence[str], values: Sequence[Column], stats: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """variable and the aggregates of its value, one row for each in the order given; a table without rows gives null for all."""
    listed = df.sparkSession.range(0, 1, 1, 1).select(F.posexplode(F.array(*[F.lit(c) for c in names])).alias("_place", "variable"))
    # One row per named variable, so its size is known before the job runs.
    return listed.join(F.broadcast(_in_blocks(df, values, stats)), "_place", "left").drop("_place")


def _or_none(c: str) -> Column:
    """A count, 0 where there were no rows to count."""
    return F.coalesce(F.col(c), F.lit(0))


def binary_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per 0/1 column: variable, n (rows that are 1), known (rows with a value), percent (n of known)."""
    counted = df.agg(
        *[x for i, c in enumerate(columns) for x in (F.count_if(F.col(c) == 1).alias(f"_n{i}"), F.count(c).alias(f"_k{i}"))]
    )
    rows = [[F.lit(c), F.col(f"_n{i}"), F.col(f"_k{i}"), _share(F.col(f"_n{i}"), F.col(f"_k{i}"))] for i, c in enumerate(columns)]
    return _rows(counted, rows, ["variable", "n", "known", "percent"])


def score_table(df: DataFrame, columns: Sequence[str], above_to_null: Mapping[str, float] = {}) -> DataFrame:
    """Per numeric column: variable, known (rows with a value), mean, sd. Values above a bound can be left out."""
    def value(c):
        c, bound = F.col(c).cast("double"), above_to_null.get(c)
        return c if bound is None else if_else(c > bound, F.lit(None), c)

    return _moments(df, {c: value(c) for c in columns})


def _moments(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    aggs, rows = [], []
    for i, (name, v) in enumerate(values.items()):
        aggs += [F.count(v).alias(f"_k{i}"), F.avg(v).alias(f"_m{i}"), F.stddev_samp(v).alias(f"_s{i}")]
        rows.append([F.lit(name), F.col(f"_k{i}"), F.col(f"_m{i}"), F.col(f"_s{i}")])
    return _rows(df.agg(*aggs), rows, ["variable", "known", "mean", "sd"])


def condition_table(df: DataFrame, flags: Sequence[str], scores: Sequence[str] = ()) -> DataFrame:
    """Score rows (known, mean, sd) on top of one row per 0/1 condition (n, known, percent)."""
    top = [score_table(df, scores)] if scores else []
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*top, binary_table(df, flags)])


def event_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per count: category, total_n (all rows), happened (rows with one or more), percent.

    An unknown count is taken as no event.
    """
    stats = {"total_n": lambda _: F.count(F.lit(1)), "happened": F.sum}
    found = _each(df, [c + "_binary" for c in columns], [at_least_one(c) for c in columns], stats)
    total, happened = _or_none("total_n"), _or_none("happened")
    return found.select(F.col("variable").alias("category"), total.alias("total_n"), happened.alias("happened"), _share(happened, total).alias("percent"))


def activity_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per count: variable, total_activity, known (all rows), mean, sd, an unknown count being 0."""
    values = [F.coalesce(F.col(c), F.lit(0)).cast("double") for c in columns]
    found = _each(df, columns, values, {"total_activity": F.sum, "known": F.count, "mean": F.avg, "sd": F.stddev_samp})
    return found.select("variable", round_even("total_activity").alias("total_activity"), _or_none("known").alias("known"), "mean", "sd")


def column_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column: variable and its rounded sum, unknown values left out."""
    counted = df.agg(*[F.sum(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = [[F.lit(c), round_even(F.coalesce(F.col(f"_{i}"), F.lit(0.0)))] for i, c in enumerate(columns)]
    return _rows(counted, rows, ["variable", "value"])


def level_table(df: DataFrame, columns: Sequence[str], unknown: str | None = UNKNOWN) -> DataFrame:
    """Per variable and level: variable, level, n, known (rows of the variable with a value), percent.

    A variable with unknown rows also gets a row for them, without known and percent, unless ``unknown``
    is None.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "variable", "level")
    counts = long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))
    # One row per named variable, so its size is known before the job runs.
    known = F.broadcast(counts.groupBy("variable").agg(F.sum(F.when(F.col("level").isNotNull(), F.col("n"))).alias("known")))
    if unknown is None:
        counts = counts.where(F.col("level").isNotNull())
    total = F.when(F.col("level").isNotNull(), F.col("known"))
    return counts.join(known, "variable").select(
        "variable",
        F.coalesce(F.col("level"), F.lit(unknown)).alias("level"),
        "n",
        total.alias("known"),
        _share(F.col("n"), total).alias("percent"),
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = (0.25, 0.5, 0.75),
    buckets: int = 64,
    most: int = MOST_RANKED,
) -> DataFrame:
    """Exact quantiles with linear interpolation: variable, known, and one column p<percent> per prob.

    Equal values are counted first, and the counts written once. A range of each variable that holds a wanted rank is cut
    into ``buckets`` ranges by approximate quantiles, and only those that hold a wanted rank go on, until each has
    ``most`` distinct values at most; those are ranked one by one. So no task ranks more values than that,
    and the approximation decides only where the cuts lie: each range travels with its bounds and the exact number of
    rows before it. A range is a row on the driver, two for each variable and prob at most. NaN is unknown, like null.
    """
    value = F.when(~F.isnan("value"), F.col("value"))
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "variable", "value")
    long = long.select("variable", value.alias("value")).where(F.col("value").isNotNull())
    counts = staged(long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    spark = df.sparkSession
    wanted = [f"{edge}((known - 1) * {float(p)}D)" for p in probs for edge in ("floor", "ceil")]
    holds = " or ".join(f"({t} >= _before and {t} < _before + _held)" for t in wanted)
    whole = counts.groupBy("variable").agg(F.min("value").alias("_low"), F.max("value").alias("_high"), F.sum("n").alias("known"), F.count(F.lit(1)).alias("_distinct"))
    names = ["variable", "_low", "_high", "known", "_before", "_held", "_distinct"]
    schema = "variable string, _low double, _high double, known long, _before long, _held long, _distinct long"
    ranges = whole.select("variable", "_low", "_high", "known", F.lit(0).cast("long").alias("_before"), F.col("known").alias("_held"), "_distinct").collect()

    def inside(some) -> DataFrame:
        # At most two ranges for each variable and prob, both ends in.
        held = F.broadcast(spark.createDataFrame([tuple(r) for r in some], schema).withColumnRenamed("variable", "_variable"))
        return counts.join(held, (F.col("variable") == F.col("_variable")) & F.col("value").between(F.col("_low"), F.col("_high"))).drop("_variable")

    while wide := [r for r in ranges if r["_distinct"] > most]:
        cut = _cut(inside(wide), buckets).where(holds).select(*names).collect()
        ranges = [r for r in ranges if r["_distinct"] <= most] + cut
    upto = F.expr("_before + sum(n) over (partition by variable, _low order by value rows unbounded preceding)")
    ranked = inside(ranges).withColumn("_upto", upto)
    aggs, out = [], []
    for i, p in enumerate(probs):
        at = f"((known - 1) * {float(p)}D)"
        aggs += [F.expr(f"min(if(_upto > {edge}{at}, value, null)) as _{edge}{i}") for edge in ("floor", "ceil")]
        out.append(F.expr(f"_floor{i} + ({at} - floor{at}) * (_ceil{i} - _floor{i})").alias(f"p{round(100 * p)}"))
    return ranked.groupBy("variable").agg(F.max("known").alias("known"), *aggs).select("variable", "known", *out)


def _cut(counts: DataFrame, buckets: int) -> DataFrame:
    """Each range of (variable, _low) cut by approximate quantiles of its values, with rows held, rows before, and distinct values."""
    own = ["variable", "_low"]
    cuts = [i / buckets for i in range(1, buckets)]
    edges = counts.groupBy(*own).agg(F.percentile_approx("value", cuts, 100 * buckets).alias("_edges"))
    # A row for each range that is cut.
    placed = counts.join(F.broadcast(edges), own).withColumn("_range", F.expr("size(filter(_edges, e -> e < value))"))
    held = placed.groupBy(*own, "_range").agg(
        F.min("value").alias("_first"),
        F.max("value").alias("_last"),
        F.any_value("known").alias("known"),
        F.any_value("_before").alias("_earlier"),
        F.sum("n").alias("_held"),
        F.count(F.lit(1)).alias("_distinct"),
    )
    # At most `buckets` rows for each range.
    before = F.expr("_earlier + sum(_held) over (partition by variable, _low order by _range) - _held")
    return held.withColumn("_before", before).select("variable", F.col("_first").alias("_low"), F.col("_last").alias("_high"), "known", "_before", "_held", "_distinct")


def first_missing(df: DataFrame, columns: Sequence[str]) -> Column:
    """The first of the columns that is null (or NaN) in a row; null for a row that has them all."""
    kinds = dict(df.dtypes)
    unknown = {c: F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNull() for c in columns}
    return F.coalesce(*[F.when(test, F.lit(c)) for c, test in unknown.items()])


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """The rows that have every column, and what is counted as they are made, in the same pass.

    The observation holds ``kept``, and for each column the rows that it was the first to be missing in. It is filled by
    the first action on the rows.
    """
    columns = list(columns or df.columns)
    cause, seen = first_missing(df, columns), Observation()
    marked = df.withColumn("_cause", cause)
    counts = [F.count_if(F.col("_cause") == c).alias(c) for c in columns]
    return marked.observe(seen, F.count_if(F.col("_cause").isNull()).alias("kept"), *counts).where("_cause is null").drop("_cause"), seen


def missing_causes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """variable, n: the rows that each column was the first to be missing in, and '(complete)' for those with all. One pass."""
    columns = list(columns or df.columns)
    counted = df.select(first_missing(df, columns).alias("_cause")).agg(
        F.count_if(F.col("_cause").isNull()).alias("_complete"), *[F.count_if(F.col("_cause") == c).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    return _rows(counted, [[F.lit(COMPLETE), F.col("_complete")], *[[F.lit(c), F.col(f"_{i}")] for i, c in enumerate(columns)]], ["variable", "n"])


def prefix_stats(df: DataFrame, prefix: str, digits: int = 2) -> DataFrame:
    """One row: mean, sd (rounded) and missing rows of every column with the prefix."""
    aggs = []
    for c in with_prefix(df, prefix):
        v = F.col(c).cast("double")
        aggs += [
            round_even(F.avg(v), digits).alias(f"{c}_mean"),
            round_even(F.stddev_samp(v), digits).alias(f"{c}_sd"),
            F.count_if(v.isNull()).alias(f"{c}_na_count"),
        ]
    return df.agg(*aggs)


def _strata(df: DataFrame, strata: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """One row per person and stratum with its level, an unknown level being a level, plus overall."""
    levels = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING_LEVEL)).alias(c) for c in strata]
    frame = df.select(*levels, F.lit(OVERALL).alias(OVERALL), *carried)
    return frame.unpivot(list(carried), [*strata, OVERALL], "stratum", "level")


def stratified_table(df: DataFrame, outcomes: Mapping[str, str], strata: Sequence[str]) -> DataFrame:
    """Mean and sd of every outcome in every level of every stratum, and overall.

    ``outcomes`` maps a column to its label. Columns: variable, label, stratum, level, known (rows of
    the level with a value), mean, sd. All strata and outcomes are counted in one grouping by
    stratum, level and block of outcomes, which combines on the map side.
    """
    names = [f"_v{i}" for i in range(len(outcomes))]
    carried = df.select(*strata, *[F.col(c).cast("double").alias(n) for c, n in zip(outcomes, names)])
    stats = {"known": F.count, "mean": F.avg, "sd": F.stddev_samp}
    counted = _in_blocks(_strata(carried, strata, names), [F.col(n) for n in names], stats, ["stratum", "level"])
    at = lambda texts: F.get(F.array(*[F.lit(x) for x in texts]), "_place")
    return counted.select(at(outcomes).alias("variable"), at(outcomes.values()).alias("label"), "stratum", "level", "known", "mean", "sd")


def stratum_sizes(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Rows per level of every stratum, and overall: stratum, level, n."""
    return _strata(df, strata, []).groupBy("stratum", "level").agg(F.count(F.lit(1)).alias("n"))


def found_levels(table: DataFrame, listed: Mapping[str, Sequence[str]], most: int = MOST_LEVELS) -> list[tuple[str, str]]:
    """(stratum, level) of the blocks of a merged table: the listed levels in their order, then all others found.

    ``listed`` maps each stratum to its levels; of a stratum without any, all are found. What is unknown comes last in
    each. The levels of a stratified table come to the driver, as they become columns; a stratum with more than
    ``most`` of them is none and fails.
    """
    seen: dict[str, set[str]] = {}
    for r in table.select("stratum", "level").distinct().limit(most * (len(listed) + 1) + 1).collect():
        seen.setdefault(r["stratum"], set()).add(r["level"])
    if wide := [s for s, levels in seen.items() if len(levels) > most]:
        raise ValueError(f"more than {most} levels: {', '.join(sorted(wide))}")
    blocks = []
    for s in [*listed, *sorted(set(seen) - set(listed))]:
        own = list(listed.get(s, []))
        others = sorted(seen.get(s, set()) - {*own, MISSING_LEVEL})
        unknown = [MISSING_LEVEL] if MISSING_LEVEL in (seen.get(s, set()) | set(own)) else []
        blocks += [(s, lv) for lv in [*[x for x in own if x != MISSING_LEVEL], *others, *unknown]]
    return blocks


def side_by_side(table: DataFrame, columns: Sequence[tuple[str, str]], values: Sequence[str] = ("known", "mean", "sd")) -> DataFrame:
    """A stratified table with one row per variable and a block of columns per (stratum, level), see ``found_levels``.

    A level that nobody has shows 0 known and no mean. One with the value ``text`` shows 'mean (sd)'.
    """

    def pick(s: str, lv: str, v: str) -> Column:
        shown = mean_sd_text("mean", "sd") if v == "text" else F.col(v)
        found = F.max(F.when((F.col("stratum") == s) & (F.col("level") == lv), shown))
        return F.coalesce(found, F.lit(0)) if v == "known" else found

    picks = [pick(s, lv, v).alias(f"{s}: {lv}: {v}") for s, lv in columns for v in values]
    return table.groupBy("variable", "label").agg(*picks)


def event_counts_by(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """People with more than none of each count, overall and by level: label, then one column each.

    A count unknown for one person of a group makes the group's number null.
    """
    level = F.coalesce(F.col(by).cast("string"), F.lit(MISSING_LEVEL))
    frame = df.select(level.alias("_level"), *columns)
    grouped = frame.groupingSets([["_level"], []], "_level").agg(
        F.grouping("_level").alias("_all"), *[count_if_strict(F.col(c) > 0).alias(c) for c in columns]
    )
    return grouped.select(F.when(F.col("_all") == 1, OVERALL).otherwise(F.col("_level")).alias("label"), *columns)


def in_level_order(table: DataFrame, c: str, levels: Sequence[str], out: str = "ord") -> DataFrame:
    """Add the place of a label in the display order; labels not listed come last."""
    place = F.array_position(F.array(*[F.lit(x) for x in levels]), F.col(c))
    return table.withColumn(out, F.coalesce(F.nullif(place, F.lit(0)), F.lit(len(levels) + 1)).cast("int"))


def dictionary(df: DataFrame) -> DataFrame:
    """One row per column of a table: variable, type."""
    entries = [F.struct(F.lit(c).alias("variable"), F.lit(t).alias("type")) for c, t in df.dtypes]
    return df.sparkSession.range(1).select(F.inline(F.array(*entries)))


def _rounded_text(value: Column, digits: int) -> Column:
    """A number as text with so many decimals, halves away from zero; rounded in decimals, not in binary fractions."""
    exact = value.cast("double").cast("decimal(38,10)")
    return F.round(exact, digits).cast(f"decimal(38,{digits})").cast("string")


def mean_sd_text(mean: Column | str, sd: Column | str, digits: int = 2) -> Column:
    """'mean (sd)', the sd of a single row shown as NA."""
    mean, sd = col(mean), col(sd)
    spread = F.when(sd.isNull(), "NA").otherwise(_rounded_text(sd, digits))
    return F.when(mean.isNotNull(), F.concat(_rounded_text(mean, digits), F.lit(" ("), spread, F.lit(")")))


def percent_text(share: Column | str) -> Column:
    """'p%': whole numbers from 10 percent on, one decimal below, '<0.1%' for less than that."""
    p = col(share) * 100
    return (
        F.when(p >= 10, F.concat(_rounded_text(p, 0), F.lit("%")))
        .when(p >= 0.1, F.concat(_rounded_text(p, 1), F.lit("%")))
        .when(p > 0, "<0.1%")
        .when(p == 0, "0%")
    )


def strip_suffix(c: Column | str, suffix: str) -> Column:
    """Remove the first occurrence of a text."""
    return F.regexp_replace(col(c), f"^(.*?)\\Q{suffix}\\E", "$1")


def in_words(table: DataFrame) -> DataFrame:
    """A score, condition or activity table as it is printed: variable, known, and its statistic as text.

    A row with a mean shows 'mean (sd)', one with a share 'p%'. Of names that end in a mark of how a column was
    made, the mark goes.
    """
    has = lambda c: F.col(c) if c in table.columns else F.lit(None)
    name, known = next(c for c in ("variable", "category") if c in table.columns), next(c for c in ("known", "total_n") if c in table.columns)
    shown = F.coalesce(mean_sd_text(has("mean"), has("sd")), percent_text(has("percent")))
    plain = reduce(strip_suffix, MARKS, F.col(name))
    return table.select(plain.alias("variable"), F.col(known).alias("known"), shown.alias("shown"))
