"""Measures of the five event sources and the records valid at the index date.

Each function takes a source table as read and the residents table, and returns person-level rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.functions.dates import (
    out_of_hours_by_hour,
    out_of_hours_by_time,
    parse_date,
    parse_timestamp,
    seconds_of_day,
    within_lookback,
)
from spinewise.functions.missing import is_in, value_to_null
from spinewise.functions.names import without
from spinewise.operators.asof import asof_filled, asof_record, asof_ties, latest_filled
from spinewise.operators.windowed import any_where, count_where, distinct_values, row_count, total, window_features
from spinewise.plans.study import PERSON, PERSON_ALT, Study

# Codes the measures test for.
COMMUNITY_MISSED = [7, 2, 3]
COMMUNITY_FACE_TO_FACE = 1
COMMUNITY_TEAMS = {"dn": 12, "SALT": 33, "podiatry": 27, "continence": 7, "rehab": 29}
AMBULANCE_ARRIVAL = ["1048031000000100", "1048021000000102", "1048041000000109", "1048051000000107"]
FALL_COMPLAINT = ["161898004", "430576002", "54670004", "75941004", "240871000000104", "429482004"]
FALL_MECHANISM = ["54670004", "75941004", "240871000000104", "429482004"]
OUTPATIENT_MISSED = [3, 1, 7]
AMBULANCE_FALL = 28
NO_PLACE = "ZZZZZ"
EMERGENCY_DEPARTMENT = "ED"


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The column added or replaced, worked out once a row.

    Spark repeats a projected expression in each filter and sum that uses it, but takes nothing through a generator,
    here one of a single row.
    """
    made = df.select("*", F.inline(F.array(F.struct(value.alias("_once")))))
    here = [F.col("_once").alias(c) if c == name else F.col(c) for c in df.columns]
    return made.select(*here, *([] if name in df.columns else [F.col("_once").alias(name)]))


def _dated(df: DataFrame, column: str, order: str, out: str | None = None) -> DataFrame:
    """Parse a text date; a column that is a date already is kept as it is."""
    out = out or column
    if dict(df.dtypes)[column] != "string":
        return df.withColumn(out, F.col(column))
    return _once(_once(df, out, F.col(column)), out, parse_date(out, order))


def _stamped(df: DataFrame, column: str) -> DataFrame:
    return _once(_once(df, column, F.col(column)), column, parse_timestamp(column)) if dict(df.dtypes)[column] == "string" else df


def cohort_flags(residents: DataFrame, study: Study = Study()) -> DataFrame:
    """Admitted to the home in the year before the index date; present in both waves."""
    return residents.select(
        PERSON,
        within_lookback("ch_admission", "index_wave1", study.lookback_days).alias("CH_admission_flag"),
        study.in_both_waves.alias("wave"),
    )


def inpatient_features(events: DataFrame, residents: DataFrame, study: Study = Study(), keep: str | None = None) -> DataFrame:
    """Admissions in the wave and the period, and death in hospital after the index date.

    By default only people with an admission between the index date and the end of the period are
    kept; ``keep='any'`` keeps people with an admission in any window.
    """
    since, period, wave = study.since_index, study.period, study.between_waves
    counted = (period.suffix, wave.suffix)
    return window_features(
        _dated(events, "activity_date", "dmy"),
        residents,
        PERSON,
        "activity_date",
        [since, period, wave],
        [
            any_where("death_hosp_postindex", F.col("death_hosp") == 1, spans=(since.suffix,)),
            row_count("n_admissions", counted),
            count_where("n_elective_admissions", F.col("adm_el") == 1, True, counted),
            count_where("n_emergency_admissions", F.col("adm_em") == 1, True, counted),
            count_where("n_avoidable_emergency_admissions", F.col("adm_avoid") == 1, True, counted),
            count_where("n_admissions_bedsore", F.col("bedsore") == 1, True, counted),
        ],
        keep=since.suffix if keep is None else keep,
    )


def community_features(events: DataFrame, residents: DataFrame, study: Study = Study()) -> DataFrame:
    """Community appointments by kind in all three windows."""
    team = F.col("Referral_TeamType")
    return window_features(
        _dated(events, "Contact_Date", "ymd"),
        residents,
        PERSON_ALT,
        "Contact_Date",
        [study.year_before, study.period, study.between_waves],
        [
            row_count("n_cs_appts"),
            count_where("n_cs_missed_appts", is_in("AttendanceStatus", COMMUNITY_MISSED)),
            count_where("n_cs_f2f_appts", F.col("Consultation_MediumUsed") == COMMUNITY_FACE_TO_FACE),
            *[count_where(f"n_cs_appts_{name}", team == code) for name, code in COMMUNITY_TEAMS.items()],
            distinct_values("n_cs_services", team),
        ],
        spine_key=PERSON,
    )


def emergency_features(events: DataFrame, residents: DataFrame, study: Study = Study()) -> DataFrame:
    """Emergency attendances in all three windows: rows in the look-back, distinct ids in the others."""
    back, period, wave = study.year_before, study.period, study.between_waves
    counted = events.where(F.col("cntnondupe") == 1)
    timed = _once(_dated(counted, "arrdate_ec", "dmy", "Arrival_Date"), "_arrival", seconds_of_day("arrtime_ec"))
    falls = is_in("chief_ec", FALL_COMPLAINT) | is_in("injmech_ec", FALL_MECHANISM)
    return window_features(
        timed,
        residents,
        PERSON,
        "Arrival_Date",
        [back, period, wave],
        [
            row_count("n_ED_attendances", (back.suffix,)),
            distinct_values("n_ED_attendances", "uid", (period.suffix, wave.suffix)),
            count_where("n_ED_unplanned", F.col("cntunplan") == 1, True),
            count_where("n_ED_seenunplan", F.col("cntseenunplan") == 1, True),
            count_where("n_out_of_hours_ED_attendances", out_of_hours_by_time("_arrival"), True),
            count_where("n_long_ED_attendances", F.col("tnrdur_ec") >= study.long_attendance_minutes, True),
            count_where("n_ED_attendances_via_ambulance", is_in("arrmode_ec", AMBULANCE_ARRIVAL)),
            count_where("n_ED_attendances_for_falls", falls),
            count_where("n_ED_attendances_ngproc", F.col("ngproc_ec") == 1, True, (back.suffix,)),
        ],
    )


def outpatient_features(events: DataFrame, residents: DataFrame, study: Study = Study()) -> DataFrame:
    """Outpatient appointments in all three windows."""
    back = study.year_before
    return window_features(
        _dated(events, "appdate_op", "ymd").where(F.col("cntnondupe_op") == 1),
        residents,
        PERSON,
        "appdate_op",
        [back, study.period, study.between_waves],
        [
            row_count("n_OP_appts"),
            count_where("n_missed_OP_appts", is_in("attstatus_op", OUTPATIENT_MISSED)),
            total("n_ngproc_op", "ngproc_op", True, (back.suffix,)),
        ],
    )


def ambulance_features(events: DataFrame, residents: DataFrame, study: Study = Study()) -> DataFrame:
    """Ambulance calls in the period and the wave.

    The source keeps blank text, so a blank receiving place counts as conveyed.
    """
    events = _stamped(_stamped(events, "time_call_connected"), "time_resource_arrived_on_scene")
    place = F.col("receiving_location_type_cad")
    return window_features(
        _dated(events, "call_date", "ymd"),
        residents,
        PERSON_ALT,
        "call_date",
        [study.period, study.between_waves],
        [
            row_count("n_ambulance_call_outs"),
            count_where("n_ambulance_attendances", F.col("time_resource_arrived_on_scene").isNotNull()),
            count_where("n_ambulance_conveyances", value_to_null(place, NO_PLACE).isNotNull()),
            count_where("n_ambulance_attendances_OOH", out_of_hours_by_hour("time_call_connected"), True),
            count_where("n_ambulance_attendances_fall", F.col("chief_complaint_call_triage_code") == AMBULANCE_FALL, True),
            count_where("n_ambulance_conveyances_ED", place == EMERGENCY_DEPARTMENT),
        ],
        spine_key=PERSON,
    )


def social_care_record(history: DataFrame, residents: DataFrame, tiebreak=("Event_End_Date",)) -> DataFrame:
    """The social-care record covering the index date; of several with one start the one that ends first, an open end last."""
    columns = ["Accommodation_Status", "Client_Funding_Status", "Service_Component", "Service_Type"]
    dated = _dated(history, "Event_Start_Date", "ymd")
    found = asof_record(
        _dated(dated, "Event_End_Date", "ymd") if "Event_End_Date" in dated.columns else dated,
        residents,
        PERSON_ALT,
        "Event_Start_Date",
        "index_wave1",
        columns,
        tiebreak,
        spine_key=PERSON,
    )
    return found.withColumnsRenamed({c: f"{c}_ASC" for c in columns})


def demographic_record(history: DataFrame, ties: str = "all") -> DataFrame:
    """The demographic record covering the index date, with all tied records or one of them."""
    columns = without(history, [PERSON, "Change_Time_Stamp"])
    pick = asof_ties if ties == "all" else asof_record
    found = pick(history, None, PERSON, "Change_Time_Stamp", "index_date", columns)
    return found.withColumnsRenamed(
        {
            "Der_Practice_Code": "practice_code_PDS",
            "Der_CCGofResidence": "CCG_residence_PDS",
            "Gender": "gender_PDS",
            "DateOfDeath": "date_of_death_PDS",
            "Der_Postcode_LSOA_Code": "LSOA_PDS",
            "Der_DOBYearMth": "DOB_yr_mth_PDS",
        }
    )


RESIDENCY_COLUMNS = [
    "Der_Start_Date",
    "Der_End_Date",
    "Der_CQC_Location",
    "Der_CQC_Service_Type",
    "CCG_Of_Residence",
    "YearMonthDeath_YYYYMM",
    "CareHomeIndicator",
    "DeathFlag",
    "DeathInHospFlag",
]


def residency_record(history: DataFrame, tiebreak=()) -> DataFrame:
    """The residency covering the index date, its gaps filled from older ones but for the end date."""
    found = asof_filled(
        history, None, PERSON, "Der_Start_Date", "index_wave1", RESIDENCY_COLUMNS, tiebreak, exempt=["Der_End_Date"]
    )
    return found.withColumnsRenamed({c: f"{c}_CHR" for c in RESIDENCY_COLUMNS})


def residency_per_home(residency: DataFrame, tiebreak=(PERSON,)) -> DataFrame:
    """Per care home, the newest known service type, area and indicator of its residents."""
    columns = ["Der_CQC_Service_Type_CHR", "CCG_Of_Residence_CHR", "CareHomeIndicator_CHR"]
    found = latest_filled(residency, "Der_CQC_Location_CHR", "Der_Start_Date_CHR", columns, tiebreak)
    return found.withColumnsRenamed({c: c + "CH" for c in ["Der_CQC_Location_CHR", *columns]})
