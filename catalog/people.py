"""Queries for the ready-made measures and the three pipelines, each with its check.

The given tables stand in for the administrative sources (see ``catalog.frames``); the study dates
are moved into the years they cover.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from catalog.features import WINDOW_TESTS, strict, windowed
from catalog.frames import HISTORY, frame, with_frames
from catalog.linkage import covered, group_shares, side_by_side
from catalog.summaries import AGE_BAND, each, exact_age, level_rows, mean_sd, stratum_rows
from spinewise.functions.recode import AGE_LEVELS, DEPRIVATION_FIFTHS, ETHNICITY_LEVELS, SEX_LEVELS
from spinewise.operators.report import in_words
from spinewise.plans.final_set import final_checks, final_set
from spinewise.plans.person_set import (
    care_home_checks,
    care_home_records,
    finalise,
    hospital_set,
    link_people,
    linked_checks,
    source_reports,
)
from spinewise.plans.presets import (
    ambulance_features,
    cohort_flags,
    community_features,
    demographic_record,
    emergency_features,
    inpatient_features,
    outpatient_features,
    residency_per_home,
    residency_record,
    social_care_record,
)
from spinewise.plans.reports import CARE_HOME_SCORES, STRATA_LEVELS, reporting_frame, stratified_frame, stratified_tables, variable_tables
from spinewise.plans.study import PERSON, PERSON_ALT, Study
from spinewise.sources.store import StageStore
from spinewise.sources.stages import new_path
from spinewise.sources.tables import read_variables, write_csv

STUDY = Study(period_start="1998-01-01", period_end="1998-05-31", after_end="2000-01-01", longest_stay=9000)


def measured(preset, source, **options):
    def run(spark, d):
        return preset(frame(spark, d, source), frame(spark, d, "residents"), STUDY, **options)

    return run


def residency_with_order(spark, d):
    return residency_record(frame(spark, d, "residency"), ["record"])


def demographic_one(spark, d):
    return demographic_record(frame(spark, d, "demographics"), ties="one")


def social_care(spark, d):
    return social_care_record(frame(spark, d, "social_care"), frame(spark, d, "residents"))


def care_home(spark, d):
    return care_home_records(frame(spark, d, "residents"), frame(spark, d, "care_home"))


def hospital(spark, d):
    return hospital_set(
        frame(spark, d, "hospital_extract"),
        measured(inpatient_features, "inpatient", keep="any")(spark, d),
        measured(emergency_features, "emergency")(spark, d),
        measured(outpatient_features, "outpatient")(spark, d),
        frame(spark, d, "hospital_demographics"),
    )


def linked(spark, d):
    return link_people(
        frame(spark, d, "residents"),
        {
            "hospital": hospital(spark, d),
            "ambulance": measured(ambulance_features, "ambulance")(spark, d),
            "social_care": social_care(spark, d),
            "demographics": demographic_one(spark, d),
            "community_demographics": frame(spark, d, "community_demographics"),
            "residency": residency_with_order(spark, d),
            "care_home": care_home(spark, d),
            "community": measured(community_features, "community")(spark, d),
            "flags": cohort_flags(frame(spark, d, "residents"), STUDY),
        },
        frame(spark, d, "areas"),
        check=["demographics", "community_demographics", "care_home"],
    )


def person_set(spark, d):
    return finalise(linked(spark, d), STUDY)


@lru_cache(maxsize=8)
def _stored(application: str, d: str) -> StageStore:
    """The stages of a folder's study, each written once: sources and linked set by person, final set, homes."""
    spark = SparkSession.active()
    store, residents = StageStore(spark), frame(spark, d, "residents")
    store.put("residents", residents, PERSON)
    store.put("hospital", hospital(spark, d), PERSON)
    store.put("ambulance", measured(ambulance_features, "ambulance")(spark, d), PERSON_ALT)
    store.put("social_care", social_care(spark, d), PERSON_ALT)
    store.put("demographics", demographic_one(spark, d), PERSON)
    store.put("community_demographics", frame(spark, d, "community_demographics"), PERSON_ALT)
    store.put("residency", residency_with_order(spark, d), PERSON)
    store.put("care_home", care_home(spark, d), PERSON, care_home_checks())
    store.put("community", measured(community_features, "community")(spark, d), PERSON_ALT)
    store.put("flags", cohort_flags(residents, STUDY), PERSON)
    store.put("linked", linked_from(store, frame(spark, d, "areas")), PERSON, linked_checks())
    store.put("people", finalise(store.get("linked"), STUDY), PERSON)
    homes = residency_per_home(store.get("residency"))
    home_level, people = final_set(store.get("people"), frame(spark, d, "home_spine"), frame(spark, d, "survey"), frame(spark, d, "regulator"), homes)
    store.put("homes", home_level)
    store.put("final", people, checks=final_checks())
    return store


def stored(spark, d) -> StageStore:
    return _stored(spark.sparkContext.applicationId, d)


def linked_from(store, areas):
    """The link over stored stages: all sources have the spine's partitioning."""
    sources = {n: store.get(n) for n in SOURCES}
    return link_people(store.get("residents"), sources, areas, check=["demographics", "community_demographics", "care_home"])


def person_set_stored(spark, d):
    return finalise(linked_from(stored(spark, d), frame(spark, d, "areas")), STUDY)


def report_of(name):
    def run(spark, d):
        return source_reports(stored(spark, d).get("linked"), STUDY, [name])[name]

    return run


def final_people(spark, d):
    return stored(spark, d).get("final")


def home_level(spark, d):
    return stored(spark, d).get("homes")


def stage_counts(spark, d):
    """What the writes of the stages counted, without another look at them."""
    return stored(spark, d).counts()


def variables_of(name):
    def run(spark, d):
        report = reporting_frame(final_people(spark, d), STUDY)
        listed = (None, None) if name.startswith("remaining_") else (CATEGORICAL, CONTINUOUS)
        name_of = name.removeprefix("remaining_")
        table = variable_tables(report, *listed, STUDY, [name_of])[name_of]
        return table.withColumns({c: F.round(c, 6) for c in ("mean", "sd") if c in table.columns})

    return run


def strata_of(name, outcomes=None):
    def run(spark, d):
        people = stratified_frame(final_people(spark, d))
        table = stratified_tables(people, outcomes(spark, people) if outcomes else OUTCOMES, [name])[name]
        return table.withColumns({c: F.round(f"`{c}`", 6) for c in table.columns if c.endswith(("mean", "sd"))})

    return run


def listed_outcomes(spark, people):
    """A variable list in a file: every count and score with its label, those of the table marked in the first filter."""
    path = new_path(spark, "variables-csv")
    entries = [(f"Label of {v}" if v.startswith("n_") else None, v, "1" if v in LISTED else None, None, None) for v in [*LISTED, "lengthofstay", "no_such_column"]]
    write_csv(spark.createDataFrame(entries, "label string, variables string, `Filter 1` string, `Filter 2` string, `Filter 3` string"), path)
    return read_variables(spark, path).filled("filter1")


def printed(name):
    def run(spark, d):
        report = reporting_frame(final_people(spark, d), STUDY)
        return in_words(variable_tables(report, CATEGORICAL, CONTINUOUS, STUDY, [name])[name])

    return run


CATEGORICAL = ["IMD_quintile", "sex_final", "nur_res", "ethnicity_final", "registered_bed_capacity", "service_reg_yrs"]
CONTINUOUS = ["n_cs_appts", "Years_Since_Reg_CQC"]
# Text forms of all that is in none of the other tables, for the check alone: the query finds them itself.
REMAINING_LEVELS = [
    "adm_bedsore_12h", "adm_lrti_12h", "adm_urti_12h", "discharge_ch_12h", "death_hosp_postindex", "deathdate_sus",
    "diabetes_combined", "anaemia_combined", "hypertension_combined", "ngproc_combined", "Accommodation_Status_ASC",
    "Client_Funding_Status_ASC", "Service_Component_ASC", "Service_Type_ASC", "index_date", "practice_code_PDS",
    "CCG_residence_PDS", "date_of_death_PDS", "LSOA_PDS", "Der_Start_Date_CHR", "Der_End_Date_CHR", "Der_CQC_Location_CHR",
    "Der_CQC_Service_Type_CHR", "CCG_Of_Residence_CHR", "YearMonthDeath_YYYYMM_CHR", "CareHomeIndicator_CHR",
    "DeathFlag_CHR", "DeathInHospFlag_CHR", "Provider", "both_waves", "ethnicity_new", "gender_new", "dementia",
    "ethnicity_new_w2", "gender_new_w2", "dementia_w2", "CH_admission_flag", "wave", "dementia_sus", "IMD_decile",
    "IMD_quintile", "dod_final", "dob_final", "ethnicity_final", "sex_final", "dementia_final", "nur_res", "dob_available",
    "dod_available", "RecordedDate_WF", "Location_HSCA_start_date_CQC", "Publication_Date_CQC", "Care_homes_beds_CQC",
    "Location_Region_CQC", "Der_CQC_Service_Type_CHRCH", "CCG_Of_Residence_CHRCH", "CareHomeIndicator_CHRCH",
    "registered_bed_capacity", "service_reg_yrs", "cogimp_sus",
]
REMAINING_NUMBERS = [
    *[f"{c}_w2" for c in CARE_HOME_SCORES], *CARE_HOME_SCORES, "lengthofstay", "lengthofstay_w2", "Q3_staff", "Q3_hours", "Years_Since_Reg_CQC",
]
#: Sources in the order in which they are linked.
SOURCES = ["hospital", "ambulance", "social_care", "demographics", "community_demographics", "residency", "care_home", "community", "flags"]
OUTCOMES = {"n_ED_attendances": "ED attendances", "n_cs_appts": "Community appointments", "nr_elix_h36": "Conditions"}
QUERIES = {
    "cohort_flags": lambda spark, d: cohort_flags(frame(spark, d, "residents"), STUDY),
    "inpatient_features": measured(inpatient_features, "inpatient"),
    "community_features": measured(community_features, "community"),
    "emergency_features": measured(emergency_features, "emergency"),
    "outpatient_features": measured(outpatient_features, "outpatient"),
    "ambulance_features": measured(ambulance_features, "ambulance"),
    "social_care_record": social_care,
    "demographic_record": lambda spark, d: demographic_record(frame(spark, d, "demographics")),
    "demographic_record_one": demographic_one,
    "residency_record": residency_with_order,
    "residency_per_home": lambda spark, d: residency_per_home(residency_with_order(spark, d)),
    "care_home_records": care_home,
    "hospital_set": hospital,
    "person_set": person_set,
    "person_set_stored": person_set_stored,
    "stage_counts": stage_counts,
    **{f"sources_{n}": report_of(n) for n in (
        "ethnicity_coverage", "ethnicity_agreement", "ethnicity_crosstab", "sex_coverage", "sex_agreement",
        "sex_crosstab_community", "sex_crosstab_hospital", "birth_coverage", "birth_agreement", "death_coverage",
        "death_agreement", "birth_checks", "death_checks", "dementia_coverage", "dementia_agreement",
    )},
    "home_level": home_level,
    "final_set": final_people,
    **{f"report_{n}": variables_of(n) for n in ("conditions", "event_share", "activity", "levels", "scores", "length_of_stay", "survey", "quantiles", "remaining_levels", "remaining_quantiles")},
    **{f"strata_{n}": strata_of(n) for n in ("means", "sizes", "event_counts", "merged")},
    "strata_listed": strata_of("means", listed_outcomes),
    "strata_printed": strata_of("printed", listed_outcomes),
    **{f"printed_{n}": printed(n) for n in ("conditions", "event_share", "activity", "scores")},
}

# --- checks -----------------------------------------------------------------------------------

BACK, PERIOD, WAVE = WINDOW_TESTS[""], WINDOW_TESTS["_5m"], WINDOW_TESTS["_wave"]
SINCE = f"day between index_wave1 and date '{STUDY.period_end}'"
# Codes of arrival by ambulance, complaints of a fall, and injuries by a fall.
AM = ["1048031000000100", "1048021000000102", "1048041000000109", "1048051000000107"]
FALLS = ["161898004", "430576002", "54670004", "75941004", "240871000000104", "429482004"]
INJURY = ["54670004", "75941004", "240871000000104", "429482004"]
TWO = ("_5m", "_wave")
LOOK = ("",)


def one_of(c, codes):
    return f"{c} in ({', '.join(repr(x) for x in codes)})"


def where(test):
    return f"count(*) filter (where {test})"


INPATIENT = [
    ("n_admissions", "count(*)", None),
    ("n_elective_admissions", strict("adm_el = 1"), None),
    ("n_emergency_admissions", strict("adm_em = 1"), None),
    ("n_avoidable_emergency_admissions", strict("adm_avoid = 1"), None),
    ("n_admissions_bedsore", strict("bedsore = 1"), None),
]
DIED = [("death_hosp_postindex", "case when count(death_hosp) = count(*) then max(case when death_hosp = 1 then 1 else 0 end) end", None)]
COMMUNITY = [
    ("n_cs_appts", "count(*)", None),
    ("n_cs_missed_appts", where("AttendanceStatus in (7, 2, 3)"), None),
    ("n_cs_f2f_appts", where("Consultation_MediumUsed = 1"), None),
    ("n_cs_appts_dn", where("Referral_TeamType = 12"), None),
    ("n_cs_appts_SALT", where("Referral_TeamType = 33"), None),
    ("n_cs_appts_podiatry", where("Referral_TeamType = 27"), None),
    ("n_cs_appts_continence", where("Referral_TeamType = 7"), None),
    ("n_cs_appts_rehab", where("Referral_TeamType = 29"), None),
    ("n_cs_services", "count(distinct Referral_TeamType) + cast(max(case when Referral_TeamType is null then 1 else 0 end) as bigint)", None),
]
EMERGENCY = [
    ("n_ED_attendances", "count(*)", LOOK),
    ("n_ED_attendances", "count(distinct uid)", TWO),
    ("n_ED_unplanned", strict("cntunplan = 1"), None),
    ("n_ED_seenunplan", strict("cntseenunplan = 1"), None),
    ("n_out_of_hours_ED_attendances", strict("(cast(arrtime_ec as time) > time '18:00:00' or cast(arrtime_ec as time) < time '08:00:00')"), None),
    ("n_long_ED_attendances", strict("tnrdur_ec >= 720"), None),
    ("n_ED_attendances_via_ambulance", where(one_of("arrmode_ec", AM)), None),
    ("n_ED_attendances_for_falls", where(f"coalesce({one_of('chief_ec', FALLS)}, false) or coalesce({one_of('injmech_ec', INJURY)}, false)"), None),
    ("n_ED_attendances_ngproc", strict("ngproc_ec = 1"), LOOK),
]
OUTPATIENT = [
    ("n_OP_appts", "count(*)", None),
    ("n_missed_OP_appts", where("attstatus_op in (3, 1, 7)"), None),
    ("n_ngproc_op", "case when count(ngproc_op) = count(*) then cast(sum(ngproc_op) as bigint) end", LOOK),
]
AMBULANCE = [
    ("n_ambulance_call_outs", "count(*)", None),
    ("n_ambulance_attendances", "count(time_resource_arrived_on_scene)", None),
    ("n_ambulance_conveyances", where("receiving_location_type_cad <> 'ZZZZZ'"), None),
    ("n_ambulance_attendances_OOH", strict("(hour(cast(time_call_connected as timestamp)) >= 18 or hour(cast(time_call_connected as timestamp)) < 8)"), None),
    ("n_ambulance_attendances_fall", strict("chief_complaint_call_triage_code = 28"), None),
    ("n_ambulance_conveyances_ED", where("receiving_location_type_cad = 'ED'"), None),
]
THREE = {"": BACK, "_5m": PERIOD, "_wave": WAVE}
ALT = "Der_Pseudo_NHS_Number"
_DATE = "cast(strptime({c}, '%d/%m/%Y') as date)"


def names(measures, suffixes):
    return list(dict.fromkeys(n + s for s in suffixes for n, _, only in measures if only is None or s in only))


def _inpatient(kind):
    day = _DATE.format(c="activity_date")
    died = windowed("inpatient", "residents", PERSON, PERSON, day, {"": SINCE}, DIED, PERSON)
    counts = windowed("inpatient", "residents", PERSON, PERSON, day, {"_5m": PERIOD, "_wave": WAVE}, INPATIENT, PERSON)
    return f"select * from (select * from {died}) d {kind} join (select * from {counts}) c using ({PERSON})"


_NEWEST_CHR = "order by Der_Start_Date desc, record rows between current row and unbounded following"
_CHR = ["Der_CQC_Location", "Der_CQC_Service_Type", "CCG_Of_Residence", "YearMonthDeath_YYYYMM", "CareHomeIndicator", "DeathFlag", "DeathInHospFlag"]
BODIES = {
    "cohort_flags": f"""select {PERSON}, ch_admission >= index_wave1 - 365 and ch_admission <= index_wave1 as CH_admission_flag,
        ascotwave1 = 1 and ascotwave2 = 1 as wave from residents""",
    "inpatient_features": _inpatient("left"),
    "inpatient_any": _inpatient("full"),
    "community_features": f"select * from {windowed('community', 'residents', ALT, PERSON, 'Contact_Date', THREE, COMMUNITY, ALT)}",
    "emergency_features": "select * from "
    + windowed("(select * from emergency where cntnondupe = 1)", "residents", PERSON, PERSON, "arrdate_ec", THREE, EMERGENCY, PERSON),
    "outpatient_features": f"select * from {windowed('(select * from outpatient where cntnondupe_op = 1)', 'residents', PERSON, PERSON, 'appdate_op', THREE, OUTPATIENT, PERSON)}",
    "ambulance_features": f"select * from {windowed('ambulance', 'residents', ALT, PERSON, 'call_date', {'_5m': PERIOD, '_wave': WAVE}, AMBULANCE, ALT)}",
    "social_care_record": f"""select {ALT}, Accommodation_Status as Accommodation_Status_ASC, Client_Funding_Status as Client_Funding_Status_ASC,
        Service_Component as Service_Component_ASC, Service_Type as Service_Type_ASC
        from social_care join residents on {ALT} = {PERSON} where cast(Event_Start_Date as date) <= index_wave1
        qualify row_number() over (partition by {ALT} order by cast(Event_Start_Date as date) desc, cast(Event_End_Date as date) nulls last,
            Accommodation_Status nulls first, Client_Funding_Status nulls first, Service_Component nulls first, Service_Type nulls first) = 1""",
    "demographic_record": f"""select {PERSON}, index_date, Der_Practice_Code as practice_code_PDS, Der_CCGofResidence as CCG_residence_PDS, Gender as gender_PDS,
        DateOfDeath as date_of_death_PDS, Der_Postcode_LSOA_Code as LSOA_PDS, Der_DOBYearMth as DOB_yr_mth_PDS
        from demographics where Change_Time_Stamp <= index_date
        qualify rank() over (partition by {PERSON} order by Change_Time_Stamp desc) = 1""",
    "residency_record": f"""select {PERSON}, Der_Start_Date as Der_Start_Date_CHR, Der_End_Date as Der_End_Date_CHR, {', '.join(f'{c} as {c}_CHR' for c in _CHR)}
        from (select {PERSON}, Der_Start_Date, Der_End_Date, {', '.join(f'first_value({c} ignore nulls) over w as {c}' for c in _CHR)},
                     row_number() over (partition by {PERSON} order by Der_Start_Date desc, record) as place
              from residency where Der_Start_Date <= index_wave1 window w as (partition by {PERSON} {_NEWEST_CHR})) where place = 1""",
}
BODIES["demographic_record_one"] = BODIES["demographic_record"].replace("qualify rank()", "qualify row_number()").replace(
    "Change_Time_Stamp desc)", "Change_Time_Stamp desc, index_date, Der_Practice_Code)"
)
_HOME = ["Der_CQC_Service_Type", "CCG_Of_Residence", "CareHomeIndicator"]
BODIES["residency_per_home"] = f"""select Der_CQC_Location_CHR as Der_CQC_Location_CHRCH, {', '.join(f'{c}_CHR as {c}_CHRCH' for c in _HOME)}
    from (select Der_CQC_Location_CHR, {', '.join(f'first_value({c}_CHR ignore nulls) over w as {c}_CHR' for c in _HOME)},
                 row_number() over (partition by Der_CQC_Location_CHR order by Der_Start_Date_CHR desc, {PERSON} desc) as place
          from ({BODIES['residency_record']})
          window w as (partition by Der_CQC_Location_CHR order by Der_Start_Date_CHR desc, {PERSON} desc rows between current row and unbounded following)) where place = 1"""
_RECORD = ["ethnicity_new", "gender_new", "dementia", *CARE_HOME_SCORES, "lengthofstay"]

def _provider(code, number, key, record, upper):
    first = ", ".join(f"a.{c}" for c in ["residentid", "both_waves", *_RECORD])
    later = ", ".join(f"b.{c} as {c}_w2" for c in _RECORD)
    own = "null as ClientID_PCS, r.ClientID_P, null as clientid_w2" if code == "N" else "r.ClientID_PCS, null as ClientID_P, b.clientid as clientid_w2"
    match = "{r}.{record}" if not upper else "upper({r}.{record})"
    joins = " ".join(
        f"left join (select * from care_home where provider = {number} and wave = {w}) {r} on r.{key} = {match.format(r=r, record=record)}"
        for w, r in ((1, "a"), (2, "b"))
    )
    return f"select r.{PERSON}, r.pseudocqcid, r.Provider, {own}, {first}, {later} from residents r {joins} where r.Provider = '{code}'"


BODIES["care_home_records"] = _provider("N", 1, "ClientID_N", "clientid", False) + " union all " + _provider("P", 2, "ClientID_P", "hashedid", True)
_OR = "case when {a} = 1 or {b} = 1 then 1 when {a} is not null and {b} is not null then 0 end"
_RENAMED = "bedsore_12h as adm_bedsore_12h, lrti_12h as adm_lrti_12h, urti_12h as adm_urti_12h, destch_12h as discharge_ch_12h"
BODIES["hospital_set"] = f"""select *, {_OR.format(a='e_diab_comp_h36', b='e_diab_uncomp_h36')} as diabetes_combined,
        {_OR.format(a='e_anaemia_bloodloss_h36', b='e_anaemia_deficiency_h36')} as anaemia_combined,
        {_OR.format(a='e_ht_comp_h36', b='e_ht_uncomp_h36')} as hypertension_combined,
        {_OR.format(a='n_ED_attendances_ngproc', b='n_ngproc_op')} as ngproc_combined
    from (select distinct * exclude (admission, bedsore_12h, lrti_12h, urti_12h, destch_12h), {_RENAMED} from hospital_extract) h
    full join inpatient_any using ({PERSON}) full join emergency_features using ({PERSON})
    full join outpatient_features using ({PERSON}) full join hospital_demographics using ({PERSON})"""

# Counts that are 0 where a person has no record.
_ZERO = [
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
BODIES["linked"] = f"""select r.{PERSON}, h.* exclude ({PERSON}) replace ({', '.join(f'coalesce({c}, 0) as {c}' for c in _ZERO if 'cs_' not in c and 'ambulance' not in c)},
            nullif(adm_avoid_12h, 0) as adm_avoid_12h),
        a.* exclude ({ALT}) replace (coalesce(n_ambulance_call_outs_5m, 0) as n_ambulance_call_outs_5m),
        s.* exclude ({ALT}), d.* exclude ({PERSON}), cd.* exclude ({ALT}), c.* exclude ({PERSON}), k.* exclude ({PERSON}),
        cs.* exclude ({ALT}) replace (coalesce(n_cs_appts, 0) as n_cs_appts), f.* exclude ({PERSON}),
        {_OR.format(a='f_dementia_h36', b='c_dementia_h36')} as dementia_sus, IMD_decile,
        case when IMD_decile in (1, 2) then 'Most deprived fifth' when IMD_decile in (3, 4) then 'Second most deprived fifth'
             when IMD_decile in (5, 6) then 'Middle fifth' when IMD_decile in (7, 8) then 'Second least deprived fifth'
             when IMD_decile in (9, 10) then 'Least deprived fifth' end as IMD_quintile
    from residents r left join hospital_set h on r.{PERSON} = h.{PERSON} left join ambulance_features a on r.{PERSON} = a.{ALT}
    left join social_care_record s on r.{PERSON} = s.{ALT} left join demographic_record_one d on r.{PERSON} = d.{PERSON}
    left join community_demographics cd on r.{PERSON} = cd.{ALT} left join residency_record c on r.{PERSON} = c.{PERSON}
    left join care_home_records k on r.{PERSON} = k.{PERSON} left join community_features cs on r.{PERSON} = cs.{ALT}
    left join cohort_flags f on r.{PERSON} = f.{PERSON} left join areas on LSOA_PDS = LSOA_IMD"""


def _month(c):
    return f"cast(strptime(cast({c} as varchar) || '01', '%Y%m%d') as date)"


def _sexed(c):
    return f"case {c} when 1 then 'Male' when 2 then 'Female' else 'Missing' end"


def _capped(c):
    return f"case when {c} >= date '{STUDY.after_end}' then null else {c} end"


BODIES["attributes"] = f"""select *, case e_sus when 1 then 'White' when 2 then 'Mixed' when 3 then 'Asian or Asian British' when 4 then 'Black or Black British' when 5 then 'Other' else 'Missing' end as ethnicity_sus,
        case when EthnicCategory in ('A', 'B', 'C') then 'White' when EthnicCategory in ('M', 'P') then 'Black or Black British'
             when EthnicCategory = 'S' then 'Other' else 'Missing' end as ethnicity_csds,
        coalesce(e_new, 'Missing') as ethnicity_new, coalesce(g_new, 'Missing') as gender_new,
        {_sexed('g_pds')} as gender_PDS, {_sexed('Gender')} as gender_csds, {_sexed('s_sus')} as sex_sus,
        strftime({_month('DOB_yr_mth_PDS')}, '%d/%m/%Y') as dob_pds,
        {_capped('cast(date_of_death_PDS as date)')} as dod_pds, {_capped("cast(strptime(deathdate_sus, '%d/%m/%Y') as date)")} as dod_sus,
        {_capped(_month('YearMonthDeath_YYYYMM_CHR'))} as dod_chr,
        case when dementia is not null then case when dementia = 'Yes' then 1 else 0 end end as dementia_num
    from (select * rename (ethnicity_sus as e_sus, ethnicity_new as e_new, gender_new as g_new, gender_PDS as g_pds, sex_sus as s_sus) from linked)"""
BODIES["finals"] = f"""select *, coalesce(nullif(ethnicity_new, 'Missing'), nullif(ethnicity_sus, 'Missing'), ethnicity_csds) as ethnicity_final,
        coalesce(nullif(gender_PDS, 'Missing'), nullif(sex_sus, 'Missing'), nullif(gender_csds, 'Missing'), gender_new) as sex_final,
        coalesce(dob_pds, dob_sus) as dob_final, coalesce(dod_pds, dod_sus, dod_chr) as dod_final,
        case when dementia_sus = 1 or dementia_num = 1 then 1 when dementia_sus is null and dementia_num is null then null else 0 end as dementia_final
    from attributes"""
_COUNTED = [
    *names(INPATIENT, TWO), *names(EMERGENCY, THREE), *names(OUTPATIENT, THREE), *names(AMBULANCE, TWO), *names(COMMUNITY, THREE),
]
BODIES["person_set"] = f"""select * exclude (e_sus, EthnicCategory, g_pds, Gender, s_sus, dob_sus, DOB_yr_mth_PDS, e_new, g_new, ethnicity_sus, ethnicity_csds,
            gender_PDS, gender_csds, sex_sus, dob_pds, dod_pds, dod_sus, dod_chr, dementia_num)
        replace (cast(CH_admission_flag as int) as CH_admission_flag, cast(wave as int) as wave, e_new as ethnicity_new, g_new as gender_new,
                 {', '.join(f'coalesce({c}, 0) as {c}' for c in _COUNTED)}),
        case Der_CQC_Service_Type_CHR when 'Nursing' then 'Nursing' when 'Nursing and Residential' then 'Nursing' when 'Residential' then 'Residential' end as nur_res,
        case when dob_final is null then 'Missing' else 'Available' end as dob_available,
        case when dod_final is null then 'Missing' else 'Available' end as dod_available
    from finals"""
BODIES["home_level"] = """select h.pseudocqcid, RecordedDate as RecordedDate_WF, Q3_staff, Q3_hours, cast(Location_HSCA_start_date as date) as Location_HSCA_start_date_CQC,
        cast(strptime(Publication_Date, '%d/%m/%Y') as date) as Publication_Date_CQC, Care_homes_beds as Care_homes_beds_CQC,
        Location_Region as Location_Region_CQC, years_since_registration as Years_Since_Reg_CQC,
        Der_CQC_Service_Type_CHRCH, CCG_Of_Residence_CHRCH, CareHomeIndicator_CHRCH
    from home_spine h left join survey s on h.pseudocqcid = s.pseudocqcid left join regulator g on h.pseudocqcid = g.pseudocqcid
    left join residency_per_home p on h.pseudocqcid = p.Der_CQC_Location_CHRCH"""
BODIES["final_set"] = """select p.*, h.* exclude (pseudocqcid),
        case when Care_homes_beds_CQC is null then 'Missing' when Care_homes_beds_CQC <= 24 then '0-24' when Care_homes_beds_CQC <= 49 then '25-49' else '50+' end as registered_bed_capacity,
        case when Years_Since_Reg_CQC is null then 'Missing' when Years_Since_Reg_CQC <= 10 then 'Less than 10 years' else 'More than 10 years' end as service_reg_yrs
    from person_set p left join home_level h on p.pseudocqcid = h.pseudocqcid"""
BASE = {
    "residents", "inpatient", "community", "emergency", "outpatient", "ambulance", "social_care", "demographics", "residency",
    "hospital_extract", "hospital_demographics", "community_demographics", "care_home", "areas", "home_spine", "survey", "regulator",
}


# Flags that add up to the number of frailty conditions.
_FRAILTY = [
    "f_anxdep_h36",
    "f_dependence_h36",
    "f_fallsfract_h36",
    "f_incont_h36",
    "f_mobprob_h36",
    "f_pulcers_h36",
    "f_senility_h36",
    "cogimp_sus",
]
_COGNITIVE = "f_delirium_h36 + f_dementia_h36 + f_senility_h36"
BODIES["scored"] = f"""select * replace (barthel_score * 5 as barthel_score, coalesce(IMD_quintile, 'Missing') as IMD_quintile,
        coalesce(Der_CQC_Service_Type_CHR, 'Missing') as Der_CQC_Service_Type_CHR, coalesce(Client_Funding_Status_ASC, 'Missing') as Client_Funding_Status_ASC),
        case when {_COGNITIVE} > 0 then 1 when {_COGNITIVE} <= 0 then 0 end as cogimp_sus from final_set"""
BODIES["report"] = f"select *, {' + '.join(_FRAILTY)} as n_frailty_conditions from scored"
BODIES["answered"] = """select * replace (case dementia when 'Yes' then 1 when 'No' then 0 end as dementia), try_strptime(dob_final, '%d/%m/%Y')::date as born from final_set"""
BODIES["combined"] = """select *, case when f_dementia_h36 = 1 or c_dementia_h36 = 1 or dementia = 1 then 1
        when f_dementia_h36 is null and c_dementia_h36 is null and dementia is null then null else 0 end as dementia_combo from answered"""


def check(select: str) -> str:
    """A check over the given frames and the bodies above, each as a common table expression."""
    parts = ",\n".join(f"{n} as ({sql})" for n, sql in BODIES.items())
    return f"{with_frames(*sorted(BASE))},\n{parts}\n{select}"


def check_from(extra: str, select: str) -> str:
    return check("").rstrip() + f",\n{extra}\n{select}"


def crossed(rows, columns, levels):
    cells = ", ".join(f"count(*) filter (where {columns} = '{x}') as \"{x}\"" for x in levels)
    listed = ", ".join(f"'{x}'" for x in levels)
    cells += f", count(*) filter (where {columns} not in ({listed})) as \"(not listed)\", count(*) filter (where {columns} is null) as \"(unknown)\""
    return f"select case when grouping({rows}) = 1 then 'Total' else {rows} end as {rows}, {cells}, count(*) as Total from attributes group by rollup ({rows})"


def availability(sources):
    flags = ", ".join(f"case when {c} is null then 'Missing' else 'Available' end as {c}" for c in sources.values())
    return check_from(f"flags as (select {flags} from finals)", covered("flags", sources, ["Available", "Missing"]))


def quantile_rows(c):
    cells = ", ".join(f"quantile_cont(cast({c} as double), {p}) as p{round(100 * p)}" for p in (0.25, 0.5, 0.75))
    return f"select '{c}' as variable, count({c}) as known, {cells} from report having count({c}) > 0"


def known_missing(*columns):
    return "count(*) as rows, " + ", ".join(f"count({c}) as known_{c}, count(*) - count({c}) as missing_{c}" for c in columns)


ETHNIC = {"sus": "ethnicity_sus", "csds": "ethnicity_csds", "CH": "ethnicity_new"}
SEXES = {"PDS": "gender_PDS", "CH": "gender_new", "csds": "gender_csds", "sus": "sex_sus"}
ANSWERS = {"sus": "dementia_sus", "ch": "dementia_num"}
_UNLIKE, _LISTED, _GIVEN = "{a} <> {b}", "{c} <> 'Missing'", "{c} is not null"
_FLAGS = [c for c in HISTORY if c.startswith(("c_", "e_", "ec_", "f_"))]
_ACTIVE = ["adm_em_12h", "adm_el_12h", "adm_avoid_12h", "adm_lrti_12h", "adm_urti_12h", "ngproc_combined", *_COUNTED, "n_frailty_conditions"]
_STRATA = ["sex_final", "age_cat", "nur_res", "dementia_combo", "IMD_quintile"]
_ORDER = [*AGE_LEVELS, *DEPRIVATION_FIFTHS]
_PLACE = f"cast(coalesce(nullif(list_position([{', '.join(f"'{x}'" for x in _ORDER)}], level), 0), {len(_ORDER) + 1}) as int) as ord"
_AGED = exact_age("combined", "born", "index_date") + f", banded as (select *, {AGE_BAND} as age_cat from aged)"

#: All counts and scores that the variable list marks for the stratified table.
LISTED = [*_COUNTED, "nr_elix_h36", "nr_elix_2_h36", *CARE_HOME_SCORES]
_BLOCKS = [(s, lv) for s, levels in STRATA_LEVELS.items() for lv in levels]


def _entries(strata, table):
    """Rows (stratum, level, entry) with an entry for each listed variable, from one grouping a stratum."""
    entry = ", ".join(
        f"{{variable: '{v}', label: '{f'Label of {v}' if v.startswith('n_') else v}', known: count({v}), mean: avg({v}), sd: stddev_samp({v})}}" for v in LISTED
    )
    return each(
        [
            f"select '{s}' as stratum, {'$$Overall$$' if s == 'Overall' else f'coalesce(cast({s} as varchar), $$(Missing)$$)'} as level, unnest([{entry}]) as x"
            f" from {table}" + ("" if s == "Overall" else f" group by {s}")
            for s in strata
        ]
    )


def _text(value, digits=2):
    return f"cast(cast(round(cast({value} as decimal(38, 10)), {digits}) as decimal(38, {digits})) as varchar)"


def _shown(mean, sd):
    return f"case when {mean} is not null then {_text(mean)} || ' (' || coalesce({_text(sd)}, 'NA') || ')' end"


def _percent(share):
    p = f"({share} * 100)"
    return f"case when {p} >= 10 then {_text(p, 0)} || '%' when {p} >= 0.1 then {_text(p, 1)} || '%' when {p} > 0 then '<0.1%' when {p} = 0 then '0%' end"


CHECKS = {n: check(f"select * from {n}") for n in QUERIES if n in BODIES}
CHECKS["person_set_stored"] = CHECKS["person_set"]
CHECKS |= {
    "sources_ethnicity_coverage": check(covered("attributes", ETHNIC, ETHNICITY_LEVELS, False)),
    "sources_ethnicity_agreement": check(side_by_side(group_shares("attributes", ETHNIC, _UNLIKE, _LISTED))),
    "sources_ethnicity_crosstab": check(crossed("ethnicity_sus", "ethnicity_csds", ETHNICITY_LEVELS)),
    "sources_sex_coverage": check(covered("attributes", SEXES, SEX_LEVELS)),
    "sources_sex_agreement": check(side_by_side(group_shares("attributes", SEXES, _UNLIKE, _LISTED))),
    "sources_sex_crosstab_community": check(crossed("gender_PDS", "gender_csds", SEX_LEVELS)),
    "sources_sex_crosstab_hospital": check(crossed("gender_PDS", "sex_sus", SEX_LEVELS)),
    "sources_birth_coverage": availability({"pds": "dob_pds", "sus": "dob_sus", "final": "dob_final"}),
    "sources_birth_agreement": check(side_by_side(group_shares("attributes", {"sus": "dob_sus", "pds": "dob_pds"}, _UNLIKE, _GIVEN))),
    "sources_death_coverage": availability({"chr": "dod_chr", "pds": "dod_pds", "sus": "dod_sus", "final": "dod_final"}),
    "sources_death_agreement": check(
        side_by_side(group_shares("attributes", {"sus": "dod_sus", "pds": "dod_pds", "chr": "dod_chr"}, "abs({a} - {b}) > 30", _GIVEN))
    ),
    "sources_birth_checks": check("select " + known_missing("dob_pds", "dob_sus") + ", count(*) filter (where dob_sus <> dob_pds) as n_dob_disagree from attributes"),
    "sources_death_checks": check("select " + known_missing("dod_pds", "dod_sus", "dod_chr") + " from attributes"),
    "sources_dementia_coverage": check(covered("attributes", ANSWERS, None, valid=True)),
    "sources_dementia_agreement": check(side_by_side(group_shares("attributes", ANSWERS, _UNLIKE, _GIVEN))),
    "report_conditions": check(
        each(
            [f"select '{c}' as variable, count({c}) as known, null as n, null as percent, {mean_sd(c)} from report" for c in ("nr_elix_h36", "nr_elix_2_h36")]
            + [f"select '{c}', count({c}), {where(f'{c} = 1')}, {where(f'{c} = 1')} / count({c}), null, null from report" for c in _FLAGS]
        )
    ),
    "report_event_share": check(
        each([f"select '{c}_binary' as category, count(*) as total_n, {where(f'{c} >= 1')} as happened, {where(f'{c} >= 1')} / count(*) as percent from report" for c in _ACTIVE])
    ),
    "report_activity": check(
        each([f"select '{c}' as variable, cast(sum(coalesce({c}, 0)) as double) as total_activity, count(*) as known, {mean_sd(f'coalesce({c}, 0)')} from report" for c in _ACTIVE])
    ),
    "report_levels": check(each([level_rows(c, "report") for c in CATEGORICAL])),
    "report_scores": check(each([f"select '{c}' as variable, count({c}) as known, {mean_sd(c)} from report" for c in CARE_HOME_SCORES])),
    "report_remaining_levels": check(each([level_rows(c, "report") for c in REMAINING_LEVELS])),
    "report_remaining_quantiles": check(each([quantile_rows(c) for c in REMAINING_NUMBERS])),
    "report_length_of_stay": check(
        f"select 'lengthofstay' as variable, count(lengthofstay) as known, {mean_sd('lengthofstay')} from report where lengthofstay <= {STUDY.longest_stay}"
    ),
    "report_survey": check(
        "select " + ", ".join(f"round_even(avg({c}), 2) as {c}_mean, round_even(stddev_samp({c}), 2) as {c}_sd, count(*) - count({c}) as {c}_na_count" for c in ("Q3_staff", "Q3_hours")) + " from report"
    ),
    "report_quantiles": check(each([quantile_rows(c) for c in CONTINUOUS])),
    "strata_means": check_from(
        _AGED + ", tables as (" + each([stratum_rows(s, OUTCOMES, "banded") for s in (*_STRATA, "Overall")]) + ")", f"select *, {_PLACE} from tables"
    ),
    "strata_merged": check_from(
        _AGED.rstrip(),
        each(
            [
                f"select '{v}' as variable, '{label}' as label, "
                + ", ".join(
                    f'count({v}) filter (where {test}) as "{s}: {lv}: known", round(avg({v}) filter (where {test}), 6) as "{s}: {lv}: mean", '
                    f'round(stddev_samp({v}) filter (where {test}), 6) as "{s}: {lv}: sd"'
                    for s, lv in _BLOCKS
                    for test in ["true" if s == "Overall" else f"coalesce(cast({s} as string), '(Missing)') = '{lv}'"]
                )
                + " from banded"
                for v, label in OUTCOMES.items()
            ]
        ),
    ),
    "strata_sizes": check_from(
        _AGED + ", tables as (" + each([f"select '{s}' as stratum, coalesce(cast({s} as string), '(Missing)') as level, count(*) as n from banded group by {s}" for s in _STRATA])
        + " union all select 'Overall', 'Overall', count(*) from banded)",
        f"select *, {_PLACE} from tables",
    ),
    "strata_event_counts": check(
        "select case when grouping(level) = 1 then 'Overall' else level end as label, "
        + ", ".join(f"case when count({c}) = count(*) then {where(f'{c} > 0')} end as {c}" for c in OUTCOMES if c.startswith("n_"))
        + " from (select *, coalesce(IMD_quintile, '(Missing)') as level from final_set) group by grouping sets ((level), ())"
    ),
}
_STAGES = {
    "residents": "residents", "hospital": "hospital_set", "ambulance": "ambulance_features", "social_care": "social_care_record",
    "demographics": "demographic_record_one", "community_demographics": "community_demographics", "residency": "residency_record",
    "care_home": "care_home_records", "community": "community_features", "flags": "cohort_flags", "linked": "linked", "people": "person_set",
    "homes": "home_level", "final": "final_set",
}
_COUNTS = [
    *[
        ("care_home", f"n_{code}{suffix}", f"count(*) filter (where Provider = '{code}' and {column} is not null)", "care_home_records")
        for code in ("N", "P")
        for suffix, column in (("_wave1", "residentid"), ("_wave2", "lengthofstay_w2"))
    ],
    ("linked", "n_hospital", "count(adm_em_12h)", "linked"),
    ("linked", "n_social_care", "count(*) filter (where Service_Type_ASC is not null)", "linked"),
    ("linked", "n_demographics", "count(index_date)", "linked"),
    ("linked", "n_residency", "count(Der_Start_Date_CHR)", "linked"),
    ("linked", "n_area", "count(IMD_decile)", "linked"),
    ("final", "n_survey", "count(RecordedDate_WF)", "final_set"),
    ("final", "n_regulator", "count(Publication_Date_CQC)", "final_set"),
    ("final", "n_home", "count(pseudocqcid)", "final_set"),
]
_LONG = _AGED.replace("banded as (", "banded as materialized (") + f", long as (select stratum, level, x.* from ({_entries([*_STRATA, 'Overall'], 'banded')}))"
CHECKS |= {
    "strata_listed": check_from(_LONG, f"select variable, label, stratum, level, known, round(mean, 6) as mean, round(sd, 6) as sd, {_PLACE} from long"),
    "strata_printed": check_from(
        _LONG,
        "select variable, label, "
        + ", ".join(
            f"coalesce(max(case when stratum = '{s}' and level = '{lv}' then known end), 0) as \"{s}: {lv}: known\", "
            f"max(case when stratum = '{s}' and level = '{lv}' then {_shown('mean', 'sd')} end) as \"{s}: {lv}: text\""
            for s, lv in _BLOCKS
        )
        + " from long group by variable, label",
    ),
    **{
        f"printed_{n}": f"select {name} as variable, {known} as known, {shown} as shown from ({CHECKS[f'report_{n}']})"
        for n, name, known, shown in (
            ("conditions", "variable", "known", f"coalesce({_shown('mean', 'sd')}, {_percent('percent')})"),
            ("event_share", "replace(category, '_binary', '')", "total_n", _percent("percent")),
            ("activity", "variable", "known", _shown("mean", "sd")),
            ("scores", "variable", "known", _shown("mean", "sd")),
        )
    },
    "stage_counts": check(
        each(
            [f"select '{stage}' as stage, 'rows' as measure, count(*) as value from {table}" for stage, table in _STAGES.items()]
            + [f"select '{stage}' as stage, '{measure}' as measure, {value} as value from {table}" for stage, measure, value, table in _COUNTS]
        )
    ),
}
