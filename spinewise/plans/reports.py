"""The report tables over the final set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinewise.functions.dates import parse_date_as
from spinewise.functions.names import present, with_prefix, without
from spinewise.functions.recode import AGE_LEVELS, DEPRIVATION_FIFTHS, MISSING, SEX_LEVELS, YES_NO, any_source_flag, recode
from spinewise.operators.harmonise import age_band
from spinewise.operators.report import (
    MISSING_LEVEL,
    OVERALL,
    activity_table,
    condition_table,
    event_counts_by,
    event_share,
    found_levels,
    in_level_order,
    level_table,
    prefix_stats,
    quantiles,
    row_scores,
    score_table,
    side_by_side,
    stratified_table,
    stratum_sizes,
)
from spinewise.operators.varlist import VariableList
from spinewise.plans.study import Study

# The variables of each table.
FRAILTY_CONDITIONS = [
    "f_anxdep_h36",
    "f_dependence_h36",
    "f_fallsfract_h36",
    "f_incont_h36",
    "f_mobprob_h36",
    "f_pulcers_h36",
    "f_senility_h36",
    "cogimp_sus",
]
COGNITIVE_CONDITIONS = ["f_delirium_h36", "f_dementia_h36", "f_senility_h36"]
MISSING_AS_LEVEL = [
    "IMD_quintile",
    "DiscussedPreferredDeathLocation_Indicator",
    "DeathLocationPreferred_Type",
    "Client_Funding_Status_ASC",
    "Der_CQC_Service_Type_CHR",
]
CONDITION_PREFIXES = ["c_", "e_", "ec_", "f_"]
CONDITION_SCORES = ["nr_elix_h36", "nr_elix_2_h36"]
ACTIVITY = ["adm_em_12h", "adm_el_12h", "adm_avoid_12h", "adm_lrti_12h", "adm_urti_12h", "ngproc_combined"]
NOT_IN_LEVEL_TABLE = ["adm_em_12h", "adm_el_12h", "adm_avoid_12h"]
CARE_HOME_SCORES = [
    "waterlow_recent",
    "braden_recent",
    "iaged_score",
    "barthel_score",
    "ascot_scrqol",
    "icecap_qol",
    "eq5d_vas",
    "UK_crosswalk",
    "ascot_mascore_p",
]
IDS = ["pseudonhsno", "pseudocqcid", "ClientID_N", "ClientID_P", "ClientID_PCS", "clientid", "clientid_w2", "hashedid", "residentid"]
DEMENTIA_SOURCES = ["f_dementia_h36", "c_dementia_h36", "dementia"]
NURSING_LEVELS = ["Nursing", "Residential"]
LEVEL_ORDER = {"age_cat": AGE_LEVELS, "IMD_quintile": DEPRIVATION_FIFTHS}

#: Levels of the merged table that have a block even if nobody has them, in their order; others follow as they are found.
STRATA_LEVELS = {
    "sex_final": SEX_LEVELS,
    "age_cat": [*AGE_LEVELS, MISSING_LEVEL],
    "nur_res": [*NURSING_LEVELS, MISSING_LEVEL],
    "dementia_combo": ["0", "1", MISSING_LEVEL],
    "IMD_quintile": [*DEPRIVATION_FIFTHS, MISSING_LEVEL],
    OVERALL: [OVERALL],
}


def reporting_frame(final: DataFrame, study: Study = Study()) -> DataFrame:
    """The final set with the score scaled, missing levels named, and the frailty scores added."""
    scaled = final.withColumn("barthel_score", F.col("barthel_score") * study.score_scale)
    named = scaled.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in present(final, MISSING_AS_LEVEL)}
    )
    return row_scores(
        named, sums={"n_frailty_conditions": FRAILTY_CONDITIONS}, flags={"cogimp_sus": COGNITIVE_CONDITIONS}
    )


def required(frame: DataFrame, variables: Sequence[str]) -> list[str]:
    """The same variables; an error names those that the frame lacks."""
    if absent := [c for c in variables if c not in frame.columns]:
        raise ValueError(f"no such variables: {', '.join(absent)}")
    return list(variables)


def variable_tables(
    frame: DataFrame,
    categorical: Sequence[str] | None,
    continuous: Sequence[str] | None,
    study: Study = Study(),
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The one-row-per-variable tables, by name.

    ``categorical`` and ``continuous`` name the variables of the level and quantile tables; None stands for
    all that remain, see ``remaining_variables``. A variable that the frame lacks raises an error.
    """
    levels, numbers = remaining_variables(frame)
    categorical, continuous = levels if categorical is None else categorical, numbers if continuous is None else continuous
    conditions = list(dict.fromkeys(c for p in CONDITION_PREFIXES for c in with_prefix(frame, p)))
    activity = [*ACTIVITY, *[c for c in with_prefix(frame, "n_") if c not in ACTIVITY]]
    tables = {
        "conditions": lambda: condition_table(frame, conditions, present(frame, CONDITION_SCORES)),
        "event_share": lambda: event_share(frame, activity),
        "activity": lambda: activity_table(frame, activity),
        "levels": lambda: level_table(frame, required(frame, categorical)),
        "quantiles": lambda: quantiles(frame, required(frame, continuous)),
        "scores": lambda: score_table(frame, required(frame, CARE_HOME_SCORES)),
        "length_of_stay": lambda: score_table(frame, ["lengthofstay"], {"lengthofstay": study.longest_stay}),
        "survey": lambda: prefix_stats(frame, "Q3_"),
    }
    return {n: tables[n]() for n in (tables if only is None else only)}


def remaining_variables(frame: DataFrame) -> tuple[list[str], list[str]]:
    """Variables in none of the other tables, without ids: those for the level table, and the measured ones."""
    taken = [c for p in ["n_", *CONDITION_PREFIXES] for c in with_prefix(frame, p)]
    left, kinds = without(frame, [*NOT_IN_LEVEL_TABLE, *CONDITION_SCORES, *IDS, *taken]), dict(frame.dtypes)
    return [c for c in left if kinds[c] != "double"], [c for c in left if kinds[c] == "double"]


def stratified_frame(final: DataFrame) -> DataFrame:
    """The final set with combined dementia and the age band at the index date."""
    answers = final.withColumn("dementia", recode("dementia", YES_NO).cast("int"))
    combined = answers.withColumn("dementia_combo", any_source_flag(DEMENTIA_SOURCES))
    born = combined.withColumn("_born", parse_date_as("dob_final", "dd/MM/yyyy"))
    return age_band(born, "_born", "index_date").drop("_born")


def stratified_tables(
    frame: DataFrame,
    outcomes: Mapping[str, str] | VariableList,
    only: Sequence[str] | None = None,
    levels: Mapping[str, Sequence[str]] = STRATA_LEVELS,
) -> dict[str, DataFrame]:
    """Mean and sd of the outcomes by stratum, the size of each stratum, people with events, and blocks side by side.

    The outcomes are labels by name, or a variable list, which is first checked against the frame. However many there
    are, they are one grouping of the frame. The merged tables (``merged`` numbers, ``printed`` text) have a block for every
    level found: their first pass makes the stratified table, which is small, and the second only turns it.
    """
    if isinstance(outcomes, VariableList):
        outcomes = outcomes.checked(frame, numeric=True).outcomes()
    strata = [s for s in levels if s != OVERALL]
    order = [x for c in strata for x in LEVEL_ORDER.get(c, [])]
    counts = [c for c in outcomes if c.startswith("n_")]

    def turned(values: Sequence[str]) -> DataFrame:
        table = stratified_table(frame, outcomes, strata).persist()  # a row for each outcome and level
        return side_by_side(table, found_levels(table, levels), values)

    tables = {
        "means": lambda: in_level_order(stratified_table(frame, outcomes, strata), "level", order),
        "sizes": lambda: in_level_order(stratum_sizes(frame, strata), "level", order),
        "event_counts": lambda: event_counts_by(frame, counts, "IMD_quintile"),
        "merged": lambda: turned(("known", "mean", "sd")),
        "printed": lambda: turned(("known", "text")),
    }
    return {n: tables[n]() for n in (["means", "sizes", "event_counts", "merged"] if only is None else only)}
