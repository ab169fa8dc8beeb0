"""Ready-made measures on the boundary rows of every source, with the study's own dates."""

from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spinewise.plans import presets
from spinewise.plans.final_set import final_set
from spinewise.plans.person_set import care_home_records, finalise, hospital_set, link_people, source_reports
from spinewise.plans.reports import (
    CARE_HOME_SCORES,
    remaining_variables,
    reporting_frame,
    stratified_frame,
    stratified_tables,
    variable_tables,
)
from spinewise.plans.study import Study
from spinewise.sources import tables

INDEX, SECOND = date(2023, 3, 1), date(2023, 8, 1)


@pytest.fixture(scope="module")
def residents(spark):
    made = [
        ("a", "h1", "N", "n1", None, None, date(2022, 6, 1), INDEX, SECOND, 1, 1),
        ("b", "h1", "P", None, "AB1", "s1", date(2021, 6, 1), INDEX, SECOND, 1, 0),
        ("c", "h2", "N", "n3", None, None, None, INDEX, None, 1, 1),
        ("d", "h9", "P", None, "AB4", "s4", INDEX, INDEX, SECOND, None, 1),
    ]
    return spark.createDataFrame(
        made,
        "pseudonhsno string, pseudocqcid string, Provider string, ClientID_N string, ClientID_P string, ClientID_PCS string, "
        "ch_admission date, index_wave1 date, index_wave2 date, ascotwave1 int, ascotwave2 int",
    )


def dmy(d):
    return d.strftime("%d/%m/%Y")


@pytest.fixture(scope="module")
def inpatient(spark):
    data = [
        ("a", dmy(INDEX), 1, 0, 0, 0, 0),
        ("a", dmy(date(2023, 6, 1)), 0, 1, 1, None, 1),
        ("a", dmy(date(2023, 10, 31)), 1, 0, 0, 0, 0),
        ("a", dmy(date(2023, 11, 1)), 1, 0, 0, 0, 0),
        ("b", dmy(date(2023, 5, 31)), 1, 0, 0, 0, None),
        ("c", dmy(date(2022, 5, 31)), 1, 0, 0, 0, 0),
        ("d", "not a date", 1, 0, 0, 0, 0),
    ]
    return spark.createDataFrame(data, "pseudonhsno string, activity_date string, adm_el int, adm_em int, adm_avoid int, bedsore int, death_hosp int")


def test_cohort_flags(residents):
    assert rows(presets.cohort_flags(residents)) == [("a", True, True), ("b", False, False), ("c", None, True), ("d", True, None)]


def test_inpatient(inpatient, residents):
    got = presets.inpatient_features(inpatient, residents)
    columns = ["pseudonhsno", "death_hosp_postindex", "n_admissions_5m", "n_elective_admissions_5m", "n_admissions_bedsore_5m", "n_admissions_wave", "n_elective_admissions_wave"]
    assert rows(got.select(*columns)) == [("a", 1, 2, 1, None, 2, 1), ("b", None, None, None, None, None, None)]
    assert got.columns[1] == "death_hosp_postindex" and len(got.columns) == 12


def test_community(spark, residents):
    data = [
        ("a", INDEX, 7, 1, 12),
        ("a", INDEX - timedelta(365), 5, None, None),
        ("a", INDEX - timedelta(366), 5, 1, 12),
        ("a", SECOND, 2, 2, 7),
        ("b", date(2023, 6, 1), 3, 1, 33),
    ]
    events = spark.createDataFrame(data, "Der_Pseudo_NHS_Number string, Contact_Date date, AttendanceStatus int, Consultation_MediumUsed int, Referral_TeamType int")
    got = {r[0]: r for r in presets.community_features(events, residents).collect()}
    a = got["a"]
    assert (a.n_cs_appts, a.n_cs_missed_appts, a.n_cs_f2f_appts, a.n_cs_appts_dn, a.n_cs_services) == (2, 1, 1, 1, 2)
    assert (a.n_cs_appts_5m, a.n_cs_appts_continence_5m, a.n_cs_appts_wave, a.n_cs_services_wave) == (1, 1, 2, 2)
    assert got["b"].n_cs_appts is None and got["b"].n_cs_appts_SALT_5m == 1 and len(got["a"]) == 28


def emergency_events(spark):
    def row(who, uid, day, clock, minutes, chief="161898004", injury=None, once=1):
        return (who, uid, dmy(day), clock, minutes, once, 1, 0, "1048031000000100" if minutes else "other", chief, injury, 1)

    return spark.createDataFrame(
        [
            row("a", "u1", INDEX, "07:59:59", 720),
            row("a", "u1", INDEX, "08:00:00", 719),
            row("a", "u2", SECOND, "18:00:00", 720, "none", "429482004"),
            row("a", "u2", SECOND, "18:00:01", 720, None, None),
            row("a", "u3", INDEX, "18:00:01", 900, once=0),
            row("b", None, date(2023, 6, 1), None, None),
            row("b", "u9", date(2023, 6, 1), "12:00:00", 10),
        ],
        "pseudonhsno string, uid string, arrdate_ec string, arrtime_ec string, tnrdur_ec int, cntnondupe int, cntunplan int, cntseenunplan int, "
        "arrmode_ec string, chief_ec string, injmech_ec string, ngproc_ec int",
    )


def test_emergency(spark, residents):
    got = {r[0]: r for r in presets.emergency_features(emergency_events(spark), residents).collect()}
    a, b = got["a"], got["b"]
    assert (a.n_ED_attendances, a.n_out_of_hours_ED_attendances, a.n_long_ED_attendances, a.n_ED_attendances_for_falls) == (2, 1, 1, 2)
    assert (a.n_ED_attendances_wave, a.n_out_of_hours_ED_attendances_wave, a.n_ED_attendances_for_falls_wave) == (2, 2, 3)
    assert (b.n_ED_attendances_5m, b.n_out_of_hours_ED_attendances_5m, b.n_long_ED_attendances_5m, b.n_ED_attendances_via_ambulance_5m) == (2, None, None, 1)
    assert a.n_ED_attendances_ngproc == 2 and "n_ED_attendances_ngproc_5m" not in a.asDict() and len(a) == 23


def test_outpatient(spark, residents):
    data = [("a", INDEX, 3, 1, 1), ("a", INDEX, 5, 1, None), ("a", INDEX, 7, 0, 1), ("b", INDEX, 1, 1, 1), ("b", date(2023, 10, 31), 2, 1, 1)]
    events = spark.createDataFrame(data, "pseudonhsno string, appdate_op date, attstatus_op int, cntnondupe_op int, ngproc_op int")
    assert rows(presets.outpatient_features(events, residents)) == [
        ("a", 2, 1, None, None, None, 2, 1),
        ("b", 1, 1, 1, 1, 0, None, None),
    ]


def test_ambulance(spark, residents):
    data = [
        ("a", SECOND, "2023-08-01 18:00:00", "2023-08-01 18:10:00", "ED", 28),
        ("a", SECOND, "2023-08-01 08:00:00", None, "", 28),
        ("a", date(2023, 9, 1), "2023-09-01 07:59:59", "bad", "ZZZZZ", 1),
        ("b", date(2023, 9, 1), None, None, None, None),
    ]
    events = spark.createDataFrame(
        data,
        "Der_Pseudo_NHS_Number string, call_date date, time_call_connected string, time_resource_arrived_on_scene string, receiving_location_type_cad string, chief_complaint_call_triage_code int",
    )
    assert rows(presets.ambulance_features(events, residents)) == [
        ("a", 3, 1, 2, 2, 2, 1, 2, 1, 2, 1, 2, 1),
        ("b", 1, 0, 0, None, None, 0, None, None, None, None, None, None),
    ]


def demographic_history(spark):
    t = datetime
    return spark.createDataFrame(
        [
            ("a", INDEX, t(2022, 1, 1), "old", "x", 1, None, "E1", 194002),
            ("a", INDEX, t(2023, 1, 1), "new", "x", 1, "2023-10-31", "E1", 194001),
            ("a", INDEX, t(2023, 4, 1), "later", "x", 2, None, "E2", 194001),
            ("b", INDEX, t(2023, 1, 1), "t1", "x", 2, "2023-11-01", "E2", None),
            ("b", INDEX, t(2023, 1, 1), "t2", "x", 2, None, "E2", None),
            ("c", INDEX, t(2023, 4, 1), "t3", "x", None, None, None, None),
        ],
        "pseudonhsno string, index_date date, Change_Time_Stamp timestamp, Der_Practice_Code string, Der_CCGofResidence string, Gender int, "
        "DateOfDeath string, Der_Postcode_LSOA_Code string, Der_DOBYearMth int",
    )


def test_demographic_record(spark):
    everyone = presets.demographic_record(demographic_history(spark))
    assert rows(everyone.select("pseudonhsno", "practice_code_PDS")) == [("a", "new"), ("b", "t1"), ("b", "t2")]
    assert "Change_Time_Stamp" not in everyone.columns and "LSOA_PDS" in everyone.columns
    one = presets.demographic_record(demographic_history(spark), ties="one")
    assert rows(one.select("pseudonhsno", "practice_code_PDS")) == [("a", "new"), ("b", "t1")]


def residency_history(spark):
    t = datetime
    return spark.createDataFrame(
        [
            ("a", INDEX, t(2022, 1, 1), t(2022, 9, 1), "h1", "Nursing", "A", 202310, 1, 1, 0),
            ("a", INDEX, t(2023, 1, 1), None, "h1", None, "B", None, None, 0, None),
            ("b", INDEX, t(2023, 1, 1), None, "h1", "Residential", None, 202311, 1, 0, 0),
            ("c", INDEX, t(2023, 4, 1), None, "h2", "Residential", None, None, 1, 0, 0),
        ],
        "pseudonhsno string, index_wave1 date, Der_Start_Date timestamp, Der_End_Date timestamp, Der_CQC_Location string, Der_CQC_Service_Type string, "
        "CCG_Of_Residence string, YearMonthDeath_YYYYMM int, CareHomeIndicator int, DeathFlag int, DeathInHospFlag int",
    )


def test_residency_record_and_newest_per_home(spark):
    person = presets.residency_record(residency_history(spark))
    assert rows(person.select("pseudonhsno", "Der_End_Date_CHR", "Der_CQC_Service_Type_CHR", "CCG_Of_Residence_CHR", "YearMonthDeath_YYYYMM_CHR")) == [
        ("a", None, "Nursing", "B", 202310),
        ("b", None, "Residential", None, 202311),
    ]
    home = presets.residency_per_home(person)
    assert rows(home) == [("h1", "Residential", "B", 1)]


def test_social_care_record(spark, residents):
    data = [("a", "2023-02-28", "2023-10-01", "Own", "Full", "c", "t"), ("a", "2023-02-28", "2023-9-30", "Tied", "Full", "c", "t"), ("a", "2023-02-28", None, "Open", "", "c", "t"), ("a", "2023-03-02", "2023-03-03", "After", "", "c", "t")]
    history = spark.createDataFrame(data, "Der_Pseudo_NHS_Number string, Event_Start_Date string, Event_End_Date string, Accommodation_Status string, Client_Funding_Status string, Service_Component string, Service_Type string")
    assert rows(presets.social_care_record(history, residents)) == [("a", "Tied", "Full", "c", "t")]


@pytest.fixture(scope="module")
def pipeline(spark, residents, inpatient, tmp_path_factory):
    flags = "c_dementia_h36 e_diab_comp_h36 e_diab_uncomp_h36 e_anaemia_bloodloss_h36 e_anaemia_deficiency_h36 e_ht_comp_h36 e_ht_uncomp_h36 f_anxdep_h36 f_delirium_h36 f_dementia_h36 f_dependence_h36 f_fallsfract_h36 f_incont_h36 f_mobprob_h36 f_pulcers_h36 f_senility_h36 nr_elix_h36 nr_elix_2_h36".split()
    counts = "adm_em_12h adm_el_12h adm_avoid_12h bedsore_12h lrti_12h urti_12h destch_12h".split()
    extract = inpatient.where("pseudonhsno in ('a', 'b')")
    extract = extract.withColumns({c: F.lit(0) for c in counts} | {c: (F.col("pseudonhsno") == "a").cast("int") for c in flags})
    extract = extract.withColumn("e_ht_uncomp_h36", F.lit(None).cast("int")).select("pseudonhsno", *counts, *flags)
    demographics = spark.createDataFrame(
        [("a", 1, 1, "01/01/1940", "15/10/2023"), ("b", 9, None, None, "05/11/2023"), ("c", 3, 2, "29/02/1944", None)],
        "pseudonhsno string, ethnicity_sus int, sex_sus int, dob_sus string, deathdate_sus string",
    )
    outpatient = spark.createDataFrame([("a", INDEX, 3, 1, 1)], "pseudonhsno string, appdate_op date, attstatus_op int, cntnondupe_op int, ngproc_op int")
    hospital = hospital_set(
        extract,
        presets.inpatient_features(inpatient, residents),
        presets.emergency_features(emergency_events(spark), residents),
        presets.outpatient_features(outpatient, residents),
        demographics,
    )
    records = spark.createDataFrame(
        [
            ("n1", None, "r1", 1, 1, 1, "White", "Female", "No", 10.0, 100.0),
            ("n1", None, "r1", 1, 2, 1, "White", "Female", "No", 8.0, 100.0),
            (None, "ab1", "r2", 2, 1, 0, None, None, "Yes", 4.0, 14001.0),
        ],
        "clientid string, hashedid string, residentid string, provider int, wave int, both_waves int, ethnicity_new string, gender_new string, dementia string, barthel_score double, lengthofstay double",
    )
    community = spark.createDataFrame([("b", "A", 2), ("c", "S", None)], "Der_Pseudo_NHS_Number string, EthnicCategory string, Gender int")
    calls = spark.createDataFrame(
        [("a", SECOND, "2023-08-01 18:00:00", None, "ED", 28)],
        "Der_Pseudo_NHS_Number string, call_date date, time_call_connected string, time_resource_arrived_on_scene string, receiving_location_type_cad string, chief_complaint_call_triage_code int",
    )
    contacts = spark.createDataFrame([("a", INDEX, 7, 1, 12)], "Der_Pseudo_NHS_Number string, Contact_Date date, AttendanceStatus int, Consultation_MediumUsed int, Referral_TeamType int")
    residency = presets.residency_record(residency_history(spark))
    areas = spark.createDataFrame([("E1", 1), ("E2", 10)], "LSOA_IMD string, IMD_decile int")
    care = spark.createDataFrame([("a", "2023-01-01", "e", "Own", None, "c", "t")], "Der_Pseudo_NHS_Number string, Event_Start_Date string, Event_End_Date string, Accommodation_Status string, Client_Funding_Status string, Service_Component string, Service_Type string")
    linked = link_people(
        residents,
        {
            "hospital": hospital,
            "ambulance": presets.ambulance_features(calls, residents),
            "social_care": presets.social_care_record(care, residents),
            "demographics": presets.demographic_record(demographic_history(spark), ties="one"),
            "community_demographics": community,
            "residency": residency,
            "care_home": care_home_records(residents, records),
            "community": presets.community_features(contacts, residents),
            "flags": presets.cohort_flags(residents),
        },
        areas,
    )

    def stage(df, name):
        path = str(tmp_path_factory.mktemp("stages") / name)
        tables.write_frame(df, path)
        return tables.read_frame(spark, path)

    linked = stage(linked, "linked")
    person = stage(finalise(linked), "person")
    homes = spark.createDataFrame([("h1",), ("h2",)], "pseudocqcid string")
    survey = spark.createDataFrame([("h1", "2023", 3.0), ("h3", "2023", 9.0)], "pseudocqcid string, RecordedDate string, Q3_a double")
    regulator = spark.createDataFrame([("h1", "2010-01-01", "01/02/2020", 24, 10.5, "x"), ("h2", "bad", None, None, None, "x")], "pseudocqcid string, Location_HSCA_start_date string, Publication_Date string, Care_homes_beds int, years_since_registration double, Care_home_ string")
    level, final = final_set(person, homes, survey, regulator, presets.residency_per_home(residency))
    return linked, person, stage(level, "homes"), stage(final, "final")


def test_person_set(pipeline):
    _, person, _, _ = pipeline
    got = {r.pseudonhsno: r for r in person.collect()}
    assert set(got) == {"a", "b", "c", "d"}
    a, b, c, d = (got[k] for k in "abcd")
    assert (a.ethnicity_final, a.sex_final, a.dob_final, a.dod_final, a.dementia_final) == ("White", "Male", "01/01/1940", date(2023, 10, 31), 1)
    assert (b.ethnicity_final, b.sex_final, b.dob_final, b.dod_final, b.dementia_final) == ("White", "Female", None, None, 1)
    assert (c.ethnicity_final, c.sex_final, c.dob_final, c.dementia_final) == ("Asian or Asian British", "Female", "29/02/1944", None)
    assert (d.ethnicity_final, d.sex_final, d.dob_available, d.dod_available) == ("Missing", "Missing", "Missing", "Missing")
    assert (a.IMD_quintile, b.IMD_quintile, c.IMD_quintile) == ("Most deprived fifth", "Least deprived fifth", None)
    assert (a.nur_res, b.nur_res, c.nur_res) == ("Nursing", "Residential", None)
    assert (a.CH_admission_flag, a.wave, d.wave) == (1, 1, None)
    assert all(v == 0 for k, v in d.asDict().items() if k.startswith("n_"))
    assert a.adm_avoid_12h is None and a.adm_em_12h == 0 and d.adm_em_12h == 0
    assert a.diabetes_combined == 1 and a.hypertension_combined == 1 and b.hypertension_combined is None and a.ngproc_combined == 1
    assert (a.barthel_score, a.barthel_score_w2, b.barthel_score_w2) == (10.0, 8.0, None)


def test_source_reports(pipeline):
    linked, *_ = pipeline
    made = {n: t.collect() for n, t in source_reports(linked).items()}
    sex = {r.level: r for r in made["sex_coverage"]}
    assert (sex["Male"].n_PDS, sex["Female"].n_PDS, sex["Missing"].n_PDS, sex["Total"].n_PDS) == (1, 1, 2, 4)
    ethnicity = {r.level: r for r in made["ethnicity_coverage"]}
    assert ethnicity["Asian or Asian British"].n_sus == 1 and "Total" not in ethnicity
    death = {r.level: r for r in made["death_coverage"]}
    assert (death["Available"].n_sus, death["Available"].n_pds, death["Available"].n_chr, death["Available"].n_final) == (1, 1, 1, 1)
    agreed = {r.level: r for r in made["death_agreement"]}
    assert (agreed["Same"].n_all, agreed["Total"].n_all) == (1, 1)
    birth = {r.level: r for r in made["birth_agreement"]}
    assert (birth["Same"].n_sus_pds, birth["Different"].n_sus_pds) == (1, 0)


def test_final_set(pipeline):
    _, _, level, final = pipeline
    assert rows(level.select("pseudocqcid", "RecordedDate_WF", "Care_homes_beds_CQC", "Location_HSCA_start_date_CQC")) == [("h1", "2023", 24, date(2010, 1, 1)), ("h2", None, None, None)]
    assert "Care_home_" not in level.columns
    assert rows(final.select("pseudonhsno", "registered_bed_capacity", "service_reg_yrs")) == [
        ("a", "0-24", "More than 10 years"), ("b", "0-24", "More than 10 years"), ("c", "Missing", "Missing"), ("d", "Missing", "Missing"),
    ]


def test_reports(pipeline):
    final = pipeline[3]
    frame = reporting_frame(final)
    a = {r.pseudonhsno: r for r in frame.collect()}["a"]
    assert (a.barthel_score, a.cogimp_sus, a.n_frailty_conditions) == (50.0, 1, 8)
    levels, numbers = remaining_variables(frame)
    assert "IMD_quintile" in levels and "Years_Since_Reg_CQC" in numbers and "pseudonhsno" not in levels
    assert not {"n_cs_appts", "c_dementia_h36"} & {*levels, *numbers}
    with pytest.raises(ValueError, match="braden_recent"):
        variable_tables(frame, ["IMD_quintile"], [], only=["scores"])
    frame = frame.withColumns({c: F.lit(1.0) for c in CARE_HOME_SCORES if c not in frame.columns})
    made = variable_tables(frame, ["IMD_quintile", "sex_final"], ["Years_Since_Reg_CQC"])
    assert {r.variable for r in made["scores"].collect()} == set(CARE_HOME_SCORES)
    stay = made["length_of_stay"].collect()[0]
    assert (stay.known, stay.mean) == (1, 100.0)
    conditions = {r.variable: r for r in made["conditions"].collect()}
    assert (conditions["c_dementia_h36"].n, conditions["c_dementia_h36"].known) == (1, 2)
    assert conditions["nr_elix_h36"].mean == 0.5
    assert {r.total_n for r in made["event_share"].collect()} == {4}
    assert rows(made["levels"].where("variable = 'IMD_quintile' and level = 'Missing'").select("n", "percent")) == [(2, 0.5)]
    assert made["survey"].collect()[0].Q3_a_na_count == 2
    assert made["quantiles"].collect()[0].p50 == 10.5
    only = variable_tables(frame, [], [], only=["survey"])
    assert list(only) == ["survey"]
    everything = variable_tables(frame, None, None, only=["levels", "quantiles"])
    assert {r.variable for r in everything["levels"].select("variable").distinct().collect()} == set(levels)


def test_stratified_reports(pipeline):
    frame = stratified_frame(pipeline[3])
    got = {r.pseudonhsno: (r.age_cat, r.dementia_combo) for r in frame.collect()}
    assert got == {"a": (">=80", 1), "b": (None, 1), "c": (None, None), "d": (None, None)}
    made = stratified_tables(frame, {"n_cs_appts": "Appointments", "nr_elix_h36": "Conditions"})
    means = {(r.variable, r.stratum, r.level): (r.known, r.mean) for r in made["means"].collect()}
    assert means["n_cs_appts", "Overall", "Overall"] == (4, 0.25) and means["nr_elix_h36", "nur_res", "(Missing)"] == (0, None)
    counts = {r.label: r.n_cs_appts for r in made["event_counts"].collect()}
    assert counts["Overall"] == 1 and counts["Most deprived fifth"] == 1 and counts["(Missing)"] == 0


def test_a_second_demographic_record_fails_the_link(spark, residents):
    twice = presets.demographic_record(demographic_history(spark))
    from spinewise.operators.link import link_to_spine

    with pytest.raises(Exception, match="demographics: more than one row for pseudonhsno b"):
        link_to_spine(residents, {"demographics": (twice, "pseudonhsno")}, "pseudonhsno").collect()


def test_study_defaults():
    study = Study()
    assert (study.period_start, study.period_end, study.after_end) == ("2023-06-01", "2023-10-31", "2023-11-01")


def test_a_text_date_is_parsed_once_a_row(spark):
    """The filters by window and the sums read the parsed date; none of them parses it again."""
    events = spark.createDataFrame([("a", "01/02/2023", 1, 0, 0, 0, 0)], "pseudonhsno string, activity_date string, adm_el int, adm_em int, adm_avoid int, bedsore int, death_hosp int")
    people = spark.createDataFrame(
        [("a", date(2023, 1, 1), date(2023, 6, 1), 1, 1)], "pseudonhsno string, index_wave1 date, index_wave2 date, ascotwave1 int, ascotwave2 int"
    )
    made = presets.inpatient_features(events, people, keep="any")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("dd/MM/yyyy") == 1
    assert [r.n_admissions_wave for r in made.collect()] == [1]
