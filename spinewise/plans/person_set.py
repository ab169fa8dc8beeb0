"""Events and records to one row per resident: assemble, link, resolve, finalise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.functions.dates import cap_date, format_dmy, parse_date_as, parse_year_month
from spinewise.functions.names import with_prefix
from spinewise.functions.recode import (
    COMMUNITY_ETHNICITY,
    ETHNICITY_LEVELS,
    HOSPITAL_ETHNICITY,
    MISSING,
    NURSING_TYPE,
    SEX,
    SEX_LEVELS,
    any_source_flag,
    either_flag,
    priority_coalesce,
    recode,
)
from spinewise.operators.agreement import (
    agreement_report,
    availability_coverage,
    crosstab,
    link_checks,
    source_coverage,
    within_days,
)
from spinewise.operators.harmonise import area_fifth, available, prioritise
from spinewise.operators.link import Provider, assemble, link_to_spine, waves_wide, zero_fill
from spinewise.plans.study import ENTITY, PERSON, PERSON_ALT, Study

# Columns of the hospital extract kept per person, and the counts that are 0 if unknown.
INPATIENT_KEPT = [
    "adm_em_12h",
    "adm_el_12h",
    "adm_avoid_12h",
    "bedsore_12h",
    "lrti_12h",
    "urti_12h",
    "destch_12h",
]
INPATIENT_RENAMED = {
    "bedsore_12h": "adm_bedsore_12h",
    "lrti_12h": "adm_lrti_12h",
    "urti_12h": "adm_urti_12h",
    "destch_12h": "discharge_ch_12h",
}
CONDITION_PREFIXES = ["c_", "e_", "ec_", "f_", "nr_elix_"]
ZERO_IF_UNKNOWN = [
    "n_ambulance_call_outs_5m",
    "n_ED_attendances",
    "n_cs_appts",
    "n_ED_attendances_5m",
    "adm_el_12h",
    "adm_em_12h",
    "adm_bedsore_12h",
    "adm_lrti_12h",
    "adm_urti_12h",
    "discharge_ch_12h",
    "n_admissions_5m",
    "n_elective_admissions_5m",
    "n_emergency_admissions_5m",
    "n_avoidable_emergency_admissions_5m",
    "n_admissions_wave",
    "n_elective_admissions_wave",
    "n_emergency_admissions_wave",
    "n_avoidable_emergency_admissions_wave",
    "n_OP_appts",
]


def hospital_set(
    inpatient: DataFrame,
    inpatient_counts: DataFrame,
    emergency_counts: DataFrame,
    outpatient_counts: DataFrame,
    demographics: DataFrame,
) -> DataFrame:
    """One row per person from the hospital sources, with the combined condition flags."""
    prefixed = [c for p in CONDITION_PREFIXES for c in with_prefix(inpatient, p)]
    history = (
        inpatient.select(PERSON, *INPATIENT_KEPT, *dict.fromkeys(prefixed))
        .withColumnsRenamed(INPATIENT_RENAMED)
        .distinct()
    )
    together = assemble(
        {
            "history": history,
            "inpatient": inpatient_counts,
            "emergency": emergency_counts,
            "outpatient": outpatient_counts,
            "demographics": demographics,
        },
        PERSON,
    )
    return together.withColumns(
        {
            "diabetes_combined": either_flag("e_diab_comp_h36", "e_diab_uncomp_h36"),
            "anaemia_combined": either_flag("e_anaemia_bloodloss_h36", "e_anaemia_deficiency_h36"),
            "hypertension_combined": either_flag("e_ht_comp_h36", "e_ht_uncomp_h36"),
            "ngproc_combined": either_flag("n_ED_attendances_ngproc", "n_ngproc_op"),
        }
    )


def care_home_records(residents: DataFrame, records: DataFrame) -> DataFrame:
    """The care-home records of both waves side by side, for the residents of both providers."""
    dates = ["ch_admission", "index_wave1", "index_wave2", "ascotwave1", "ascotwave2"]
    return waves_wide(
        residents,
        records,
        [
            Provider(
                people=F.col("Provider") == "N",
                records=F.col("provider") == 1,
                person_key="ClientID_N",
                record_key="clientid",
                drop={1: ["provider", "hashedid"], 2: ["provider", "residentid", "hashedid", "both_waves"]},
                drop_people=[*dates, "ClientID_N", "ClientID_PCS"],
            ),
            Provider(
                people=F.col("Provider") == "P",
                records=F.col("provider") == 2,
                person_key="ClientID_P",
                record_key="hashedid",
                record_id=F.upper("hashedid"),
                drop={1: ["provider", "clientid"], 2: ["provider", "residentid", "both_waves"]},
                drop_people=[*dates, "ClientID_N", "ClientID_P"],
            ),
        ],
        wave="wave",
        lead=[PERSON, ENTITY],
    )


def link_people(
    residents: DataFrame, sources: Mapping[str, DataFrame], areas: DataFrame, check: Sequence[str] | None = None
) -> DataFrame:
    """Every source on the list of residents, with counts filled, dementia flag and area fifth.

    The key of a source is whichever of the two person-id names it has. ``check`` names the sources
    to be tested for one row per person (all of them by default).
    """
    keyed = {n: (df, PERSON if PERSON in df.columns else PERSON_ALT) for n, df in sources.items()}
    linked = link_to_spine(residents.select(PERSON), keyed, PERSON, check=check)
    linked = zero_fill(linked, ZERO_IF_UNKNOWN).withColumns(
        {
            "adm_avoid_12h": F.nullif("adm_avoid_12h", F.lit(0)),
            "dementia_sus": either_flag("f_dementia_h36", "c_dementia_h36"),
        }
    )
    return area_fifth(linked, areas, "LSOA_PDS", "LSOA_IMD", "IMD_decile")


def care_home_checks() -> dict[str, Column]:
    """Aggregates over the care-home records: residents of each provider with a record of each wave."""
    of = {"wave1": F.col("residentid"), "wave2": F.col("lengthofstay_w2")}
    return {f"n_{p}_{w}": F.count_if((F.col("Provider") == p) & c.isNotNull()) for p in ("N", "P") for w, c in of.items()}


def linked_checks() -> dict[str, Column]:
    """Aggregates over the linked set: people whom each source is known for."""
    known = {"hospital": "adm_em_12h", "social_care": "Service_Type_ASC", "demographics": "index_date", "residency": "Der_Start_Date_CHR", "area": "IMD_decile"}
    return {f"n_{n}": F.count(c) for n, c in known.items()}


def ethnicity_columns() -> dict[str, Column]:
    return {
        "ethnicity_sus": recode("ethnicity_sus", HOSPITAL_ETHNICITY, MISSING),
        "ethnicity_csds": recode("EthnicCategory", COMMUNITY_ETHNICITY, MISSING),
        "ethnicity_new": F.coalesce("ethnicity_new", F.lit(MISSING)),
    }


def sex_columns() -> dict[str, Column]:
    return {
        "gender_PDS": recode("gender_PDS", SEX, MISSING),
        "gender_csds": recode("Gender", SEX, MISSING),
        "sex_sus": recode("sex_sus", SEX, MISSING),
        "gender_new": F.coalesce("gender_new", F.lit(MISSING)),
    }


def birth_columns() -> dict[str, Column]:
    return {"dob_sus": F.col("dob_sus"), "dob_pds": format_dmy(parse_year_month("DOB_yr_mth_PDS"))}


def death_columns(study: Study = Study()) -> dict[str, Column]:
    return {
        "dod_pds": cap_date(parse_date_as("date_of_death_PDS", "yyyy-MM-dd"), study.after_end),
        "dod_sus": cap_date(parse_date_as("deathdate_sus", "dd/MM/yyyy"), study.after_end),
        "dod_chr": cap_date(parse_year_month("YearMonthDeath_YYYYMM_CHR"), study.after_end),
    }


def dementia_columns() -> dict[str, Column]:
    answer = F.when(F.col("dementia").isNotNull(), (F.col("dementia") == "Yes").cast("int"))
    return {"dementia_sus": F.col("dementia_sus"), "dementia_num": answer}


# Sources of each attribute in order of trust.
ETHNICITY_ORDER = ["ethnicity_new", "ethnicity_sus", "ethnicity_csds"]
SEX_ORDER = ["gender_PDS", "sex_sus", "gender_csds", "gender_new"]
BIRTH_ORDER = ["dob_pds", "dob_sus"]
DEATH_ORDER = ["dod_pds", "dod_sus", "dod_chr"]
DEMENTIA_ORDER = ["dementia_sus", "dementia_num"]


def _pick(columns: Mapping[str, Column], order: Sequence[str]) -> list[Column]:
    return [columns[c] for c in order]


def finalise(linked: DataFrame, study: Study = Study()) -> DataFrame:
    """The resolved attributes in place of their sources, type of home, availability, counts filled."""
    person = linked.withColumns(
        {
            "dod_final": priority_coalesce(_pick(death_columns(study), DEATH_ORDER), None),
            "dob_final": priority_coalesce(_pick(birth_columns(), BIRTH_ORDER), None),
            "ethnicity_final": priority_coalesce(_pick(ethnicity_columns(), ETHNICITY_ORDER)),
            "sex_final": priority_coalesce(_pick(sex_columns(), SEX_ORDER)),
            "dementia_final": any_source_flag(_pick(dementia_columns(), DEMENTIA_ORDER)),
            "CH_admission_flag": F.col("CH_admission_flag").cast("int"),
            "wave": F.col("wave").cast("int"),
            "nur_res": recode("Der_CQC_Service_Type_CHR", NURSING_TYPE),
        }
    ).drop("ethnicity_sus", "EthnicCategory", "gender_PDS", "Gender", "sex_sus", "dob_sus", "DOB_yr_mth_PDS")
    return zero_fill(available(person, {"dob_available": "dob_final", "dod_available": "dod_final"}), prefix="n_")


def attribute(linked: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """The person key and the sources of one attribute."""
    return linked.select(PERSON, *[c.alias(n) for n, c in columns.items()])


def source_reports(linked: DataFrame, study: Study = Study(), only: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Coverage of each attribute by source, agreement between sources, and the crosstabs, by name."""
    ethnicity, sex = attribute(linked, ethnicity_columns()), attribute(linked, sex_columns())
    birth = prioritise(attribute(linked, birth_columns()), "dob_final", BIRTH_ORDER, None)
    death = prioritise(attribute(linked, death_columns(study)), "dod_final", DEATH_ORDER, None)
    dementia = attribute(linked, dementia_columns())
    ethnic = {"sus": "ethnicity_sus", "csds": "ethnicity_csds", "CH": "ethnicity_new"}
    sexes = {"PDS": "gender_PDS", "CH": "gender_new", "csds": "gender_csds", "sus": "sex_sus"}
    births = {"sus": "dob_sus", "pds": "dob_pds"}
    deaths = {"sus": "dod_sus", "pds": "dod_pds", "chr": "dod_chr"}
    answers = {"sus": "dementia_sus", "ch": "dementia_num"}
    apart = within_days(study.tolerance_days)
    tables = {
        "ethnicity_coverage": lambda: source_coverage(ethnicity, ethnic, ETHNICITY_LEVELS, total=False),
        "ethnicity_agreement": lambda: agreement_report(ethnicity, ethnic),
        "ethnicity_crosstab": lambda: crosstab(ethnicity, "ethnicity_sus", "ethnicity_csds", ETHNICITY_LEVELS),
        "sex_coverage": lambda: source_coverage(sex, sexes, SEX_LEVELS),
        "sex_agreement": lambda: agreement_report(sex, sexes),
        "sex_crosstab_community": lambda: crosstab(sex, "gender_PDS", "gender_csds", SEX_LEVELS),
        "sex_crosstab_hospital": lambda: crosstab(sex, "gender_PDS", "sex_sus", SEX_LEVELS),
        "birth_coverage": lambda: availability_coverage(birth, {"pds": "dob_pds", "sus": "dob_sus", "final": "dob_final"}),
        "birth_agreement": lambda: agreement_report(birth, births, missing=None),
        "death_coverage": lambda: availability_coverage(
            death, {"chr": "dod_chr", "pds": "dod_pds", "sus": "dod_sus", "final": "dod_final"}
        ),
        "death_agreement": lambda: agreement_report(death, deaths, difference=apart, missing=None),
        "birth_checks": lambda: link_checks(
            birth, known=["dob_pds", "dob_sus"], n_dob_disagree=F.col("dob_sus") != F.col("dob_pds")
        ),
        "death_checks": lambda: link_checks(death, known=DEATH_ORDER),
        "dementia_coverage": lambda: source_coverage(dementia, answers, valid=True),
        "dementia_agreement": lambda: agreement_report(dementia, answers, missing=None),
    }
    return {n: tables[n]() for n in (tables if only is None else only)}
