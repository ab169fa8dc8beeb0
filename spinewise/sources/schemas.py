"""Column types of the input files, by name. Columns not listed are text.

Fixed values: the names and types of the data model.
"""

RESIDENTS = {
    "ch_admission": "date",
    "index_date": "date",
    "index_wave1": "date",
    "index_wave2": "date",
    "ascotwave1": "int",
    "ascotwave2": "int",
}
INPATIENT = {
    "adm_el": "int",
    "adm_em": "int",
    "adm_avoid": "int",
    "bedsore": "int",
    "death_hosp": "int",
    "adm_em_12h": "int",
    "adm_el_12h": "int",
    "adm_avoid_12h": "int",
    "bedsore_12h": "int",
    "lrti_12h": "int",
    "urti_12h": "int",
    "destch_12h": "int",
}
CONDITION_PREFIXES = {"c_": "int", "e_": "int", "ec_": "int", "f_": "int", "nr_elix_": "int"}
COMMUNITY = {
    "Contact_Date": "date",
    "AttendanceStatus": "int",
    "Consultation_MediumUsed": "int",
    "Referral_TeamType": "int",
}
EMERGENCY = {
    "tnrdur_ec": "int",
    "cntnondupe": "int",
    "cntunplan": "int",
    "cntseenunplan": "int",
    "ngproc_ec": "int",
}
OUTPATIENT = {
    "appdate_op": "date",
    "attstatus_op": "int",
    "cntnondupe_op": "int",
    "ngproc_op": "int",
}
AMBULANCE = {"call_date": "date", "chief_complaint_call_triage_code": "int"}
HOSPITAL_DEMOGRAPHICS = {"ethnicity_sus": "int", "sex_sus": "int"}
COMMUNITY_DEMOGRAPHICS = {"Gender": "int"}
RESIDENCY = {
    "index_wave1": "date",
    "Der_Start_Date": "timestamp",
    "Der_End_Date": "timestamp",
    "YearMonthDeath_YYYYMM": "int",
    "CareHomeIndicator": "int",
    "DeathFlag": "int",
    "DeathInHospFlag": "int",
}
CARE_HOME_RECORDS = {
    "provider": "int",
    "wave": "int",
    "both_waves": "int",
    "waterlow_recent": "double",
    "braden_recent": "double",
    "iaged_score": "double",
    "barthel_score": "double",
    "ascot_scrqol": "double",
    "icecap_qol": "double",
    "eq5d_vas": "double",
    "UK_crosswalk": "double",
    "ascot_mascore_p": "double",
    "lengthofstay": "double",
}
REGULATOR = {"Care_homes_beds": "int", "years_since_registration": "double"}
SURVEY_PREFIXES = {"Q3_": "double"}
AREA_LOOKUP_COLUMNS = {
    "LSOA code (2011)": "LSOA_IMD",
    "Index of Multiple Deprivation (IMD) Decile (where 1 is most deprived 10% of LSOAs)": "IMD_decile",
}
