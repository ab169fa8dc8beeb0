"""Queries for the summary tables, each with its check.

Means and standard deviations are rounded on both sides; shares are plain divisions of counts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.frames import frame, with_frames
from spinewise.functions.missing import round_even
from spinewise.functions.names import numeric, with_prefix, with_suffix
from spinewise.functions.recode import DEPRIVATION_FIFTHS, decile_to_fifth
from spinewise.operators.harmonise import age_band
from spinewise.operators.report import (
    activity_table,
    binary_table,
    column_sums,
    condition_table,
    event_counts_by,
    event_share,
    complete_rows,
    in_level_order,
    level_table,
    missing_causes,
    prefix_stats,
    quantiles,
    row_scores,
    score_table,
    side_by_side,
    stratified_table,
    stratum_sizes,
)

FLAGS = ["f_many", "f_urgent", "f_finished"]
COUNTS = ["n_orders", "n_finished", "n_urgent"]
STRATA = ["segment", "region", "setting"]
OUTCOMES = {"n_orders": "Orders", "n_urgent": "Urgent orders", "balance": "Balance"}
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def scores(spark, d):
    scored = row_scores(frame(spark, d, "features"), {"n_conditions": ["f_many", "f_urgent", "any_two"]}, {"any_two": ["f_urgent", "f_finished"]})
    return scored.select("person_id", "any_two", "n_conditions")


def binary(spark, d):
    f = frame(spark, d, "features")
    return binary_table(f, with_prefix(f, "F_"))


def conditions(spark, d):
    return rounded(condition_table(frame(spark, d, "features"), FLAGS, ["Q3_kinds", "balance"]), "mean", "sd")


def shares(spark, d):
    return event_share(frame(spark, d, "features"), COUNTS)


def activity(spark, d):
    f = frame(spark, d, "features")
    return rounded(activity_table(f, with_prefix(f, "n_")), "mean", "sd")


def sums(spark, d):
    f = frame(spark, d, "features").drop("balance", "person_id")
    return column_sums(f, numeric(f))


def levels(spark, d):
    return level_table(frame(spark, d, "features"), ["segment", "setting", "f_urgent", "n_urgent"])


def known_levels(spark, d):
    return level_table(frame(spark, d, "activity"), ["status", "priority"], unknown=None)


def medians(spark, d):
    return rounded(quantiles(frame(spark, d, "activity").withColumn("event_id", F.nullif(F.col("event_id") % 1000, F.lit(7))), ["amount", "event_id"]), "p25", "p50", "p75")


def score(spark, d):
    return rounded(score_table(frame(spark, d, "features"), ["balance", "Q3_kinds", "n_urgent"], {"balance": 7000}), "mean", "sd")


def prefixed(spark, d):
    return prefix_stats(frame(spark, d, "features"), "q3_")


def ages(spark, d):
    spine = frame(spark, d, "spine")
    return age_band(spine, "birth", "index_wave1", age="age").select("person_id", "age", "age_cat")


def stratified(spark, d):
    table = stratified_table(frame(spark, d, "features"), OUTCOMES, STRATA)
    return rounded(in_level_order(table, "level", SEGMENTS), "mean", "sd")


def sizes(spark, d):
    return stratum_sizes(frame(spark, d, "features"), STRATA)


def merged(spark, d):
    table = stratified_table(frame(spark, d, "features"), OUTCOMES, ["segment"])
    wide = side_by_side(table, [("segment", "BUILDING"), ("segment", "MACHINERY"), ("Overall", "Overall")], ["known", "mean"])
    return rounded(wide, *with_suffix(wide, ": mean"))


def event_counts(spark, d):
    return event_counts_by(frame(spark, d, "features"), COUNTS, "setting")


def fifths(spark, d):
    """Mean orders by deprivation-style fifth of the area number, in display order."""
    f = frame(spark, d, "spine").withColumn("fifth", decile_to_fifth(F.col("area") % 11))
    table = stratified_table(f, {"balance": "Balance"}, ["fifth"])
    ordered = in_level_order(table.where("stratum = 'fifth'"), "level", DEPRIVATION_FIFTHS)
    return ordered.select("level", "ord", "known", round_even("mean", 2).alias("mean"))


CAUSES = ["region", "setting", "n_orders", "n_urgent", "f_urgent", "Q3_kinds"]


def causes(spark, d):
    return missing_causes(frame(spark, d, "features"), CAUSES)


def complete(spark, d):
    return complete_rows(frame(spark, d, "features"), CAUSES)[0].select("person_id", *CAUSES)


QUERIES = {
    "missing_causes": causes,
    "complete_rows": complete,
    "row_score": scores,
    "binary_table": binary,
    "condition_table": conditions,
    "event_share": shares,
    "activity_table": activity,
    "column_sums": sums,
    "level_table": levels,
    "level_table_known": known_levels,
    "quantiles": medians,
    "score_table": score,
    "prefix_stats": prefixed,
    "age_band": ages,
    "stratified_table": stratified,
    "stratum_sizes": sizes,
    "side_by_side": merged,
    "event_counts_by": event_counts,
    "ordered_fifths": fifths,
}


def each(rows: list[str]) -> str:
    return " union all ".join(rows)


def mean_sd(v: str) -> str:
    return f"round(avg({v}), 6) as mean, round(stddev_samp({v}), 6) as sd"


def level_rows(c: str, table: str = "features") -> str:
    return f"""select '{c}' as variable, coalesce(cast({c} as string), 'Unknown') as level, count(*) as n,
        case when {c} is not null then (select count({c}) from {table}) end as known,
        case when {c} is not null then count(*) / (select count({c}) from {table}) end as percent from {table} group by {c}"""


def stratum_rows(s: str, outcomes: dict[str, str], table: str = "features") -> str:
    level = f"coalesce(cast({s} as string), '(Missing)')" if s != "Overall" else "'Overall'"
    return each(
        [
            f"""select '{v}' as variable, '{label}' as label, '{s}' as stratum, {level} as level, count({v}) as known, {mean_sd(v)}
            from {table} group by {level}"""
            for v, label in outcomes.items()
        ]
    )


def exact_age(table: str, birth: str, at: str) -> str:
    """Common table expressions ending in ``aged``, which adds the age as whole years and a fraction."""
    start = "cast({b} + to_years(cast({y} as int)) as date)"
    last, following = start.format(b=birth, y="years"), start.format(b=birth, y="years + 1")
    return f"""spans as (select *, year({at}) - year({birth}) as span from {table}),
    whole as (select *, span - case when {start.format(b=birth, y='span')} > {at} then 1 else 0 end as years from spans),
    aged as (select *, years + ({at} - {last}) / ({following} - {last}) as exact from whole)"""


AGE_BAND = "case when round_even(exact, 0) < 65 then '<65' when round_even(exact, 0) <= 79 then '65-79' when exact is not null then '>=80' end"

CHECKS = {
    "missing_causes": f"""{with_frames('features')},
        caused as (select coalesce({', '.join(f"case when {c} is null then '{c}' end" for c in CAUSES)}, '(complete)') as variable from features),
        listed as (select unnest(['(complete)', {', '.join(f"'{c}'" for c in CAUSES)}]) as variable)
        select l.variable, count(c.variable) as n from listed l left join caused c on l.variable = c.variable group by l.variable""",
    "complete_rows": f"{with_frames('features')} select person_id, {', '.join(CAUSES)} from features where {' and '.join(f'{c} is not null' for c in CAUSES)}",
    "row_score": f"""{with_frames('features')},
        flagged as (select *, case when f_urgent + f_finished > 0 then 1 when f_urgent + f_finished <= 0 then 0 end as any_two from features)
        select person_id, any_two, f_many + f_urgent + any_two as n_conditions from flagged""",
    "binary_table": f"{with_frames('features')} "
    + each([f"select '{c}' as variable, count(*) filter (where {c} = 1) as n, count({c}) as known, count(*) filter (where {c} = 1) / count({c}) as percent from features" for c in FLAGS]),
    "condition_table": f"{with_frames('features')} "
    + each(
        [f"select '{c}' as variable, count({c}) as known, null as n, null as percent, {mean_sd(c)} from features" for c in ("Q3_kinds", "balance")]
        + [f"select '{c}', count({c}), count(*) filter (where {c} = 1), count(*) filter (where {c} = 1) / count({c}), null, null from features" for c in FLAGS]
    ),
    "event_share": f"{with_frames('features')} "
    + each([f"select '{c}_binary' as category, count(*) as total_n, count(*) filter (where {c} >= 1) as happened, count(*) filter (where {c} >= 1) / count(*) as percent from features" for c in COUNTS]),
    "activity_table": f"{with_frames('features')} "
    + each([f"select '{c}' as variable, cast(sum(coalesce({c}, 0)) as double) as total_activity, count(*) as known, {mean_sd(f'coalesce({c}, 0)')} from features" for c in COUNTS]),
    "column_sums": f"{with_frames('features')} "
    + each([f"select '{c}' as variable, cast(sum({c}) as double) as value from features" for c in [*COUNTS, "Q3_largest", "Q3_kinds", *FLAGS]]),
    "level_table": f"{with_frames('features')} " + each([level_rows(c) for c in ("segment", "setting", "f_urgent", "n_urgent")]),
    "level_table_known": f"{with_frames('activity')} "
    + each(
        [
            f"select '{c}' as variable, {c} as level, count(*) as n, (select count({c}) from activity) as known, count(*) / (select count({c}) from activity) as percent from activity where {c} is not null group by {c}"
            for c in ("status", "priority")
        ]
    ),
    "quantiles": f"""{with_frames('activity')}, noted as (select amount, cast(nullif(event_id % 1000, 7) as double) as event_id from activity) """
    + each(
        [
            f"select '{c}' as variable, count({c}) as known, {', '.join(f'round(quantile_cont({c}, {p}), 6) as p{round(100 * p)}' for p in (0.25, 0.5, 0.75))} from noted"
            for c in ("amount", "event_id")
        ]
    ),
    "score_table": f"{with_frames('features')} "
    + each([f"select '{n}' as variable, count({v}) as known, {mean_sd(v)} from features" for n, v in (("balance", "case when balance > 7000 then null else balance end"), ("Q3_kinds", "Q3_kinds"), ("n_urgent", "n_urgent"))]),
    "prefix_stats": f"{with_frames('features')} select "
    + ", ".join(f"round_even(avg({c}), 2) as {c}_mean, round_even(stddev_samp({c}), 2) as {c}_sd, count(*) - count({c}) as {c}_na_count" for c in ("Q3_largest", "Q3_kinds"))
    + " from features",
    "age_band": f"""{with_frames('spine')}, {exact_age('spine', 'birth', 'index_wave1')}
        select person_id, cast(round_even(exact, 0) as int) as age,
               {AGE_BAND} as age_cat from aged""",
    "stratified_table": f"{with_frames('features')}, tables as ("
    + each([stratum_rows(s, OUTCOMES) for s in (*STRATA, "Overall")])
    + f""") select *, cast(coalesce(nullif(list_position([{', '.join(f"'{s}'" for s in SEGMENTS)}], level), 0), {len(SEGMENTS) + 1}) as int) as ord from tables""",
    "stratum_sizes": f"{with_frames('features')} "
    + each([f"select '{s}' as stratum, coalesce({s}, '(Missing)') as level, count(*) as n from features group by {s}" for s in STRATA])
    + " union all select 'Overall', 'Overall', count(*) from features",
    "side_by_side": f"{with_frames('features')} "
    + each(
        [
            f"select '{v}' as variable, '{label}' as label, "
            + ", ".join(
                f'count({v}) filter (where {test}) as "{name}: known", round(avg({v}) filter (where {test}), 6) as "{name}: mean"'
                for name, test in (
                    ("segment: BUILDING", "segment = 'BUILDING'"),
                    ("segment: MACHINERY", "segment = 'MACHINERY'"),
                    ("Overall: Overall", "true"),
                )
            )
            + " from features"
            for v, label in OUTCOMES.items()
        ]
    ),
    "event_counts_by": f"""{with_frames('features')}
        select case when grouping(level) = 1 then 'Overall' else level end as label,
               {', '.join(f'case when count({c}) = count(*) then count(*) filter (where {c} > 0) end as {c}' for c in COUNTS)}
        from (select *, coalesce(setting, '(Missing)') as level from features) group by grouping sets ((level), ())""",
    "ordered_fifths": f"""{with_frames('spine')}, tenths as (select *, area % 11 as decile from spine),
        banded as (select *, case when decile in (1, 2) then 1 when decile in (3, 4) then 2 when decile in (5, 6) then 3
                             when decile in (7, 8) then 4 when decile in (9, 10) then 5 else 6 end as ord from tenths)
        select case ord when 1 then 'Most deprived fifth' when 2 then 'Second most deprived fifth' when 3 then 'Middle fifth'
               when 4 then 'Second least deprived fifth' when 5 then 'Least deprived fifth' else '(Missing)' end as level,
               ord, count(balance) as known, round_even(avg(balance), 2) as mean from banded group by ord""",
}
