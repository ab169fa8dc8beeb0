"""Tables in the shape of the library's inputs, derived from the whole of the given tables.

Each text is plain SQL that Spark and DuckDB both run, so a query and its check start from the same
rows. Missing values and code values come from the contents of the given rows.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_PERSON = "concat('P', lpad(cast({key} as string), 9, '0'))"
_INDEX = "date '1997-01-01' + cast({key} % 730 as int)"


def _person(key: str) -> str:
    return _PERSON.format(key=key)


def _index(key: str) -> str:
    return _INDEX.format(key=key)


def _dmy(day: str) -> str:
    text = f"cast(cast({day} as date) as string)"
    return f"concat(substr({text}, 9, 2), '/', substr({text}, 6, 2), '/', substr({text}, 1, 4))"


def _ymd(day: str) -> str:
    return f"cast(cast({day} as date) as string)"


def _ever(test: str) -> str:
    return f"max(case when {test} then 1 else 0 end)"


# Person-level columns of the hospital extract: sums and flags over all orders of the person.
HISTORY = {
    "adm_em_12h": "cast(count(*) filter (where o_orderstatus = 'O') as int)",
    "adm_el_12h": "cast(nullif(count(*) filter (where o_orderstatus = 'F'), 0) as int)",
    "adm_avoid_12h": "cast(count(*) filter (where o_orderpriority = '1-URGENT') as int)",
    "bedsore_12h": _ever("o_totalprice > 490000"),
    "lrti_12h": "cast(nullif(count(*) filter (where o_orderpriority = '2-HIGH'), 0) as int)",
    "urti_12h": "cast(count(*) filter (where o_orderpriority = '3-MEDIUM') as int)",
    "destch_12h": _ever("o_totalprice < 3000"),
    "c_dementia_h36": _ever("o_totalprice > 485000"),
    "c_copd_h36": _ever("o_orderpriority = '4-NOT SPECIFIED'"),
    "e_diab_comp_h36": _ever("o_totalprice between 100000 and 120000"),
    "e_diab_uncomp_h36": f"case when min(o_totalprice) > 5000 then {_ever('o_totalprice between 120000 and 140000')} end",
    "e_anaemia_bloodloss_h36": _ever("o_totalprice between 140000 and 150000"),
    "e_anaemia_deficiency_h36": _ever("o_totalprice between 150000 and 170000"),
    "e_ht_comp_h36": _ever("o_totalprice between 200000 and 230000"),
    "e_ht_uncomp_h36": _ever("o_totalprice between 230000 and 290000"),
    "f_anxdep_h36": _ever("o_totalprice between 300000 and 310000"),
    "f_delirium_h36": _ever("o_totalprice between 310000 and 320000"),
    "f_dementia_h36": f"case when min(o_totalprice) > 6000 then {_ever('o_totalprice between 320000 and 330000')} end",
    "f_dependence_h36": _ever("o_totalprice between 330000 and 350000"),
    "f_fallsfract_h36": _ever("o_totalprice between 350000 and 380000"),
    "f_incont_h36": _ever("o_totalprice between 380000 and 390000"),
    "f_mobprob_h36": _ever("o_totalprice between 390000 and 410000"),
    "f_pulcers_h36": _ever("o_totalprice between 410000 and 415000"),
    "f_senility_h36": _ever("o_totalprice between 415000 and 425000"),
    "nr_elix_h36": "cast(count(distinct o_orderpriority) as int)",
    "nr_elix_2_h36": "cast(count(distinct o_orderstatus) as int)",
}

FRAMES = {
    "spine": f"""
        select c_custkey as person_id, c_mktsegment as segment, c_nationkey as area, c_acctbal as balance,
               {_index('c_custkey')} as index_wave1,
               {_index('c_custkey')} + 180 as index_wave2,
               case when c_custkey % 10 <> 0 then 1 else 0 end as ascotwave1,
               case when c_custkey % 3 <> 0 then 1 else 0 end as ascotwave2,
               case when c_acctbal >= 0 then {_index('c_custkey')} - cast((c_custkey * 7) % 900 as int) end as ch_admission,
               date '1910-01-01' + cast((c_custkey * 37) % 14000 as int) as birth
        from {{customer}}""",
    "activity": """
        select o_orderkey as event_id, o_custkey as person_id, o_orderdate as event_time,
               o_orderstatus as status, nullif(o_orderpriority, '5-LOW') as priority,
               o_totalprice as amount
        from {orders}""",
    "services": """
        select o_custkey as person_id, l_shipdate as event_time,
               case when l_discount > 0.005 then l_suppkey end as service, l_orderkey as visit
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "calls": """
        select user_id as person_id, ts as event_time, event_type as kind, value,
               cast(ts as date) as call_date
        from {events}""",
    "sources": """
        select d.doc_id, d.lang, d.n_chars,
               case when quality = 1 then 'Good' when quality = 0 then 'Poor' else 'Missing' end as by_label,
               case when n_chars >= 1500 then 'Good' when n_chars >= 600 then 'Poor' else 'Missing' end as by_length,
               case when lang = 'en' then 'Good' when lang = 'de' then 'Poor' else 'Missing' end as by_language,
               quality, toxic,
               case when n_chars >= 1500 then 1 when n_chars >= 600 then 0 end as long_text,
               case when lang = 'en' then 1 when lang = 'de' then 0 end as english
        from {documents} d left join {labels} l on d.doc_id = l.doc_id""",
    "features": """
        select c.c_custkey as person_id, c.c_mktsegment as segment, r.r_name as region, c.c_acctbal as balance,
               nullif(c.c_mktsegment, 'FURNITURE') as setting, a.n_orders, a.n_finished, a.n_urgent,
               cast(floor(a.largest) as bigint) as Q3_largest, a.Q3_kinds,
               case when a.n_orders > 10 then 1 else 0 end as f_many,
               case when c.c_acctbal > 0 then case when a.n_urgent > 1 then 1 else 0 end end as f_urgent,
               case when a.n_orders is not null then case when a.n_finished > 2 then 1 else 0 end end as f_finished
        from {customer} c
        left join {nation} n on c.c_nationkey = n.n_nationkey
        left join {region} r on n.n_regionkey = r.r_regionkey
        left join (select o_custkey, count(*) as n_orders, count(*) filter (where o_orderstatus = 'F') as n_finished,
                          case when max(o_totalprice) < 495000 then count(*) filter (where o_orderpriority = '1-URGENT') end as n_urgent,
                          max(o_totalprice) as largest, count(distinct nullif(o_orderpriority, '5-LOW')) as Q3_kinds
                   from {orders} group by o_custkey) a on c.c_custkey = a.o_custkey""",
    "dated": """
        select o_custkey as person_id, cast(min(o_orderdate) as date) as first_day, cast(max(o_orderdate) as date) as last_day,
               cast(max(case when o_orderstatus = 'F' then o_orderdate end) as date) as finished_day
        from {orders} group by o_custkey""",
    "homes": """
        select s_suppkey as home, s_name as name, s_nationkey as area, cast(floor(s_acctbal / 100) as int) as beds_raw
        from {supplier}""",
    "deliveries": """
        select l_suppkey as home, l_shipdate as event_time, l_orderkey as visit, l_linenumber as line,
               case when l_quantity >= 40 then l_partkey end as last_part, nullif(l_returnflag, 'N') as last_flag
        from {lineitem}""",
    "yearly": """
        select concat('c', cast(o_custkey as string)) as hashed, o_custkey as client, cast(o_custkey % 2 + 1 as int) as provider,
               cast(extract(year from o_orderdate) % 2 + 1 as int) as wave, count(*) as n_orders, max(o_totalprice) as largest
        from {orders} group by o_custkey, extract(year from o_orderdate) % 2""",
    "residents": f"""
        select {_person('c_custkey')} as pseudonhsno,
               concat('H', cast(c_custkey % 97 as string)) as pseudocqcid,
               case when c_nationkey % 2 = 0 then 'N' else 'P' end as Provider,
               case when c_nationkey % 2 = 0 then concat('n', cast(c_custkey as string)) end as ClientID_N,
               case when c_nationkey % 2 = 1 then concat('AB', cast(c_custkey as string)) end as ClientID_P,
               c_name as ClientID_PCS,
               case when c_acctbal >= 0 then {_index('c_custkey')} - cast((c_custkey * 7) % 900 as int) end as ch_admission,
               {_index('c_custkey')} as index_wave1,
               {_index('c_custkey')} + 180 as index_wave2,
               case when c_custkey % 10 <> 0 then 1 else 0 end as ascotwave1,
               case when c_custkey % 3 <> 0 then 1 else 0 end as ascotwave2
        from {{customer}}""",
    "inpatient": f"""
        select {_person('o_custkey')} as pseudonhsno, {_dmy('o_orderdate')} as activity_date,
               case when o_totalprice < 20000 then null when o_orderstatus = 'F' then 1 else 0 end as adm_el,
               case when o_orderstatus = 'O' then 1 else 0 end as adm_em,
               case when o_totalprice > 480000 then null when o_orderpriority = '1-URGENT' then 1 else 0 end as adm_avoid,
               case when o_orderpriority = '2-HIGH' then 1 else 0 end as bedsore,
               case when o_totalprice < 15000 then null when o_totalprice > 400000 then 1 else 0 end as death_hosp
        from {{orders}}""",
    "community": f"""
        select {_person('o_custkey')} as Der_Pseudo_NHS_Number, cast(l_shipdate as date) as Contact_Date,
               l_linenumber as AttendanceStatus,
               case l_returnflag when 'A' then 1 when 'N' then 2 end as Consultation_MediumUsed,
               case when l_discount > 0.005 then cast(l_suppkey % 40 as int) end as Referral_TeamType
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "emergency": f"""
        select {_person('o_custkey')} as pseudonhsno, cast(l_orderkey as string) as uid,
               cast(l_shipdate as date) as arrdate_ec,
               case when l_quantity < 50 then concat(lpad(cast(l_partkey % 24 as string), 2, '0'), ':0', cast(l_linenumber - 1 as string), ':00') end as arrtime_ec,
               case when l_discount > 0.005 then cast(l_quantity * 30 as int) end as tnrdur_ec,
               case when l_tax > 0.075 then 0 else 1 end as cntnondupe,
               case when l_quantity < 49 then case when l_returnflag = 'A' then 1 else 0 end end as cntunplan,
               case when l_returnflag = 'N' then 1 else 0 end as cntseenunplan,
               case l_linenumber when 1 then '1048031000000100' when 2 then '1048021000000102'
                    when 3 then '1048041000000109' when 4 then '1048051000000107'
                    when 5 then '1048071000000103' end as arrmode_ec,
               case l_suppkey % 9 when 0 then '161898004' when 1 then '430576002' when 2 then '54670004'
                    when 3 then '267036007' when 4 then '21522001' end as chief_ec,
               case l_partkey % 7 when 0 then '429482004' when 1 then '240871000000104' when 2 then '125605004' end as injmech_ec,
               case when l_quantity > 2 then case when l_linestatus = 'O' then 1 else 0 end end as ngproc_ec
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "outpatient": f"""
        select {_person('o_custkey')} as pseudonhsno, cast(o_orderdate as date) as appdate_op,
               cast(substr(o_orderpriority, 1, 1) as int) as attstatus_op,
               case when o_totalprice > 490000 then 0 else 1 end as cntnondupe_op,
               case when o_totalprice < 20000 then null when o_orderstatus = 'F' then 1 else 0 end as ngproc_op
        from {{orders}}""",
    "ambulance": f"""
        select {_person('user_id')} as Der_Pseudo_NHS_Number, cast(ts as date) - 9800 + cast(event_id % 500 as int) as call_date,
               substr(cast(ts as string), 1, 19) as time_call_connected,
               case when value > 15 then substr(cast(ts as string), 1, 19) end as time_resource_arrived_on_scene,
               case event_type when 'error' then 'ZZZZZ' when 'click' then 'ED' when 'view' then ''
                    when 'purchase' then 'Ward' end as receiving_location_type_cad,
               case when value > 1 then 20 + cast(floor(value / 8) as int) end as chief_complaint_call_triage_code
        from {{events}}""",
    "social_care": f"""
        select {_person('o_custkey')} as Der_Pseudo_NHS_Number, {_ymd('o_orderdate')} as Event_Start_Date,
               case when o_orderkey % 5 <> 0 then {_ymd('cast(o_orderdate as date) + cast(o_orderkey % 90 as int)')} end as Event_End_Date,
               o_orderstatus as Accommodation_Status,
               nullif(o_orderpriority, '5-LOW') as Client_Funding_Status,
               substr(o_orderpriority, 3) as Service_Component, concat(o_orderstatus, o_orderpriority) as Service_Type
        from {{orders}}""",
    "demographics": f"""
        select {_person('o_custkey')} as pseudonhsno, {_index('o_custkey')} as index_date,
               o_orderdate as Change_Time_Stamp, cast(o_orderkey as string) as Der_Practice_Code,
               o_orderpriority as Der_CCGofResidence,
               case o_orderstatus when 'F' then 1 when 'O' then 2 end as Gender,
               case when o_totalprice > 400000 then {_ymd('o_orderdate')} end as DateOfDeath,
               cast(o_custkey % 25 as string) as Der_Postcode_LSOA_Code,
               cast(192001 + (o_custkey % 60) * 100 + o_custkey % 12 as int) as Der_DOBYearMth
        from {{orders}}""",
    "residency": f"""
        select {_person('o_custkey')} as pseudonhsno, {_index('o_custkey')} as index_wave1,
               o_orderdate as Der_Start_Date, case when o_totalprice > 150000 then o_orderdate end as Der_End_Date,
               case when o_orderstatus <> 'P' then concat('H', cast(o_custkey % 97 as string)) end as Der_CQC_Location,
               case o_orderpriority when '1-URGENT' then 'Nursing' when '2-HIGH' then 'Nursing and Residential'
                    when '3-MEDIUM' then 'Residential' end as Der_CQC_Service_Type,
               nullif(o_orderstatus, 'P') as CCG_Of_Residence,
               case when o_totalprice > 430000 then 199801 + cast(o_custkey % 12 as int) end as YearMonthDeath_YYYYMM,
               case when o_totalprice > 100000 then 1 end as CareHomeIndicator,
               case when o_totalprice > 430000 then 1 else 0 end as DeathFlag,
               case when o_totalprice > 470000 then 1 end as DeathInHospFlag, o_orderkey as record
        from {{orders}}""",
    "hospital_extract": f"""
        select {_person('o_custkey')} as pseudonhsno, o_orderkey as admission, {', '.join(HISTORY)}
        from {{orders}} join (select o_custkey as who, {', '.join(f'{v} as {k}' for k, v in HISTORY.items())}
                              from {{orders}} group by o_custkey) h on o_custkey = who""",
    "hospital_demographics": f"""
        select {_person('c_custkey')} as pseudonhsno, cast(c_nationkey % 10 as int) as ethnicity_sus,
               case when c_acctbal > 1000 then cast(c_custkey % 2 + 1 as int) end as sex_sus,
               case when c_acctbal > 500 then {_dmy("date '1910-01-01' + cast((c_custkey * 37) % 14000 as int)")} end as dob_sus,
               case when c_acctbal > 7500 then {_dmy("date '1998-06-01' + cast(c_custkey % 900 as int)")} end as deathdate_sus
        from {{customer}} join (select distinct o_custkey as who from {{orders}}) o on c_custkey = who""",
    "community_demographics": f"""
        select {_person('c_custkey')} as Der_Pseudo_NHS_Number,
               case c_mktsegment when 'BUILDING' then 'A' when 'MACHINERY' then 'M' when 'FURNITURE' then 'S'
                    when 'HOUSEHOLD' then 'NA_' end as EthnicCategory,
               case when c_nationkey > 3 then cast(c_nationkey % 2 + 1 as int) end as Gender
        from {{customer}} join (select distinct user_id as who from {{events}}) e on c_custkey = who""",
    "care_home": """
        select case when c_nationkey % 2 = 0 then concat('n', cast(c_custkey as string)) end as clientid,
               case when c_nationkey % 2 = 1 then concat('ab', cast(c_custkey as string)) end as hashedid,
               concat('r', cast(c_custkey as string)) as residentid, cast(c_nationkey % 2 + 1 as int) as provider, w as wave,
               case when ways = 2 then 1 else 0 end as both_waves,
               case when c_mktsegment = 'BUILDING' then 'White' when c_mktsegment = 'AUTOMOBILE' then 'Mixed' end as ethnicity_new,
               case when c_acctbal > 4000 then 'Female' when c_acctbal < 2000 then 'Male' end as gender_new,
               case when c_nationkey < 5 then 'Yes' when c_nationkey < 20 then 'No' end as dementia,
               cast(c_custkey % 25 as double) as waterlow_recent, cast(c_custkey % 23 as double) as braden_recent,
               case when c_nationkey > 3 then cast(c_custkey % 10 as double) end as iaged_score,
               cast(c_custkey % 100 as double) / 100 as ascot_scrqol, cast(c_custkey % 97 as double) / 100 as icecap_qol,
               case when c_acctbal > 500 then cast(c_custkey % 101 as double) end as eq5d_vas,
               cast(c_custkey % 89 as double) / 100 as UK_crosswalk, cast(c_custkey % 51 as double) / 50 as ascot_mascore_p,
               cast(floor(c_acctbal / 100) as double) as barthel_score, case when c_acctbal > 0 then c_acctbal * w end as lengthofstay
        from {customer} c join (select who, w, cast(count(*) over (partition by who) as int) as ways
                                from (select distinct o_custkey as who, cast(extract(year from o_orderdate) % 2 + 1 as int) as w from {orders}) x) o on c_custkey = who""",
    "areas": """
        select cast(n_nationkey as string) as LSOA_IMD, cast(n_nationkey % 11 as int) as IMD_decile from {nation}""",
    "home_spine": "select concat('H', cast(s_suppkey as string)) as pseudocqcid from {supplier}",
    "survey": """
        select concat('H', cast(s_suppkey as string)) as pseudocqcid, cast(s_nationkey as string) as RecordedDate,
               cast(floor(s_acctbal / 10) as double) as Q3_staff, case when s_acctbal > 1000 then cast(floor(s_acctbal / 7) as double) end as Q3_hours
        from {supplier}""",
    "regulator": f"""
        select concat('H', cast(s_suppkey as string)) as pseudocqcid,
               {_ymd("date '2000-01-31' + cast(s_suppkey % 3000 as int)")} as Location_HSCA_start_date,
               {_dmy("date '2010-01-31' + cast(s_suppkey % 3000 as int)")} as Publication_Date,
               case when s_acctbal > 0 then cast(floor(s_acctbal / 120) as int) end as Care_homes_beds,
               s_name as Location_Region, case when s_acctbal > 500 then cast(floor(s_acctbal / 500) as double) end as years_since_registration,
               'Y' as Care_home_, s_name as Location_City
        from {{supplier}}""",
}
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


@lru_cache(maxsize=256)
def _schema(application: str, path: str):
    return SparkSession.active().read.parquet(path).schema


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read once per application."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark.sparkContext.applicationId, path)).parquet(path)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named frame on Spark."""
    text = FRAMES[name]
    used = {t for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **{t: load(spark, sf_dir, t) for t in used})


def with_frames(*names: str) -> str:
    """The opening of a check: the named frames as common table expressions."""
    texts = [f"{n} as ({re.sub(r'[{](?P<t>[a-z]+)[}]', r'\g<t>', FRAMES[n])})" for n in names]
    return "with " + ",\n".join(texts)
