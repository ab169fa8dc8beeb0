"""Queries that write and read files: delimited text, frames, lookups, variable lists. Each with its check.

Every query writes the frame it is about to a folder of its own in the shared folder and reads it back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalog.frames import frame, with_frames
from spinewise.operators.link import link_to_spine, lookup
from spinewise.operators.windowed import fixed_period, look_back, row_count, window_features
from spinewise.sources import schemas, stages, tables

EVEN = "substr(pseudonhsno, 10, 1) in ('0', '2', '4', '6', '8')"
_CALLS = ["Der_Pseudo_NHS_Number", "call_date", "time_call_connected", "receiving_location_type_cad"]


def csv_by_name(spark, d):
    """Two files whose columns are in another order, one with a column more and one less."""
    events = frame(spark, d, "inpatient")
    one, other = (stages.new_path(spark, "inpatient-csv") for _ in range(2))
    tables.write_csv(events.where(EVEN), one)
    turned = [c for c in reversed(events.columns) if c != "bedsore"]
    tables.write_csv(events.where(f"not ({EVEN})").select(*turned, F.lit("late").alias("batch")), other)
    types = {c: "int" for c in events.columns if c not in ("pseudonhsno", "activity_date")}
    return tables.read_csv(spark, [one, other], types)


def csv_blanks_kept(spark, d):
    path = stages.new_path(spark, "calls-csv")
    tables.write_csv(frame(spark, d, "ambulance").select(*_CALLS), path)
    return tables.read_csv(spark, path, {"call_date": "date"}, blank_as_null=False)


def csv_plain(spark, d):
    """Without quotes, with a column of row names that goes when it is read again."""
    path = stages.new_path(spark, "homes-csv")
    homes = frame(spark, d, "regulator").select(F.substring("pseudocqcid", 2, 20).alias("X"), "pseudocqcid", "Publication_Date", "Care_homes_beds")
    tables.write_plain_csv(homes, path)
    return tables.read_csv(spark, path, schemas.REGULATOR)


def csv_bad_records(spark, d):
    """Records with a field too few or too many, by the priority of the order that they were made of."""
    path = stages.new_path(spark, "ragged-csv")
    priority = F.substring("priority", 1, 1)
    tail = F.when(priority == "1", "").when(priority == "2", ",F,more").otherwise(",F")
    lines = frame(spark, d, "activity").select(F.concat(F.col("event_id").cast("string"), F.lit(","), F.coalesce(priority, F.lit("0")), F.coalesce(tail, F.lit(",F"))).alias("id,kind,flag"))
    tables.write_plain_csv(lines, path)
    read = tables.read_csv(spark, path, {"id": "long"}, bad_records="_bad")
    return tables.count_bad_records(read, "_bad", ["kind", "flag"])


def csv_misfits(spark, d):
    """Values of an untyped file that their types would lose."""
    path = stages.new_path(spark, "text-csv")
    activity = frame(spark, d, "activity").select("event_id", "priority", F.coalesce(F.substring("priority", 1, 1), F.col("status")).alias("rank"))
    tables.write_csv(activity, path)
    return tables.misfits(tables.read_csv(spark, path), {"event_id": "long", "priority": "int", "rank": "int"})


def frame_round_trip(spark, d):
    path = stages.new_path(spark, "community")
    tables.write_frame(frame(spark, d, "community"), path, partition_by=["AttendanceStatus"])
    return tables.read_frame(spark, path, ["Der_Pseudo_NHS_Number", "Contact_Date", "AttendanceStatus", "Referral_TeamType"])


def lookup_from_file(spark, d):
    """A published lookup with more columns than are kept, put on people."""
    path = stages.new_path(spark, "areas-csv")
    published = {old: new for old, new in schemas.AREA_LOOKUP_COLUMNS.items()}
    areas = frame(spark, d, "areas")
    tables.write_csv(areas.select(*[F.col(new).alias(old) for old, new in published.items()], F.lit("x").alias("Name")), path)
    table = tables.read_lookup(spark, path, published, {"IMD_decile": "int"})
    people = frame(spark, d, "spine").select("person_id", F.col("area").cast("string").alias("area"))
    return lookup(people, table, "area", "LSOA_IMD", {"IMD_decile": "IMD_decile"})


def column_dictionary(spark, d):
    path = stages.new_path(spark, "dictionary-csv")
    tables.write_dictionary(frame(spark, d, "spine"), path)
    return tables.read_csv(spark, path)


def clashing_names(spark, d):
    """Two sources that call their measure the same, on one spine."""
    spine, activity = frame(spark, d, "spine"), frame(spark, d, "activity")
    counted = lambda span: window_features(activity, spine, "person_id", "event_time", [span], [row_count("n_events")])
    sources = {"year": (counted(look_back("index_wave1")), "person_id"), "period": (counted(fixed_period("1998-01-01", "1998-05-31", "")), "person_id")}
    return link_to_spine(spine.select("person_id", F.lit(0).alias("n_events")), sources, "person_id", check=[])


QUERIES = {
    "csv_by_name": csv_by_name,
    "csv_blanks_kept": csv_blanks_kept,
    "csv_plain": csv_plain,
    "csv_bad_records": csv_bad_records,
    "csv_misfits": csv_misfits,
    "frame_round_trip": frame_round_trip,
    "lookup_from_file": lookup_from_file,
    "column_dictionary": column_dictionary,
    "clashing_names": clashing_names,
}

_INPATIENT = ["adm_el", "adm_em", "adm_avoid", "death_hosp"]
CHECKS = {
    "csv_by_name": f"""{with_frames('inpatient')}
        select pseudonhsno, activity_date, {', '.join(_INPATIENT)}, case when {EVEN} then bedsore end as bedsore,
               case when not ({EVEN}) then 'late' end as batch from inpatient""",
    "csv_blanks_kept": f"{with_frames('ambulance')} select {', '.join(_CALLS)} from ambulance",
    "csv_plain": f"{with_frames('regulator')} select pseudocqcid, Publication_Date, Care_homes_beds from regulator",
    "csv_bad_records": f"""{with_frames('activity')}
        select coalesce(substr(priority, 1, 1), '0') as kind, case when priority = '1-URGENT' then null else 'F' end as flag,
               count(*) as rows, count(*) filter (where substr(priority, 1, 1) in ('1', '2')) as bad from activity group by 1, 2""",
    "csv_misfits": f"""{with_frames('activity')}
        select 'event_id' as variable, count(*) as known, 0 as misfits from activity union all
        select 'priority', count(priority), count(priority) from activity union all
        select 'rank', count(*), count(*) filter (where priority is null) from activity""",
    "frame_round_trip": f"{with_frames('community')} select Der_Pseudo_NHS_Number, Contact_Date, AttendanceStatus, Referral_TeamType from community",
    "lookup_from_file": f"""{with_frames('spine', 'areas')}
        select person_id, cast(area as varchar) as area, IMD_decile from spine left join areas on cast(area as varchar) = LSOA_IMD""",
    "column_dictionary": reduce(
        lambda a, b: f"{a} union all {b}",
        [
            f"select '{c}' as variable, '{t}' as type"
            for c, t in (
                ("person_id", "bigint"), ("segment", "string"), ("area", "int"), ("balance", "double"), ("index_wave1", "date"), ("index_wave2", "date"),
                ("ascotwave1", "int"), ("ascotwave2", "int"), ("ch_admission", "date"), ("birth", "date"),
            )
        ],
    ),
    "clashing_names": f"""{with_frames('spine', 'activity')}
        select s.person_id, 0 as n_events,
               nullif((select count(*) from activity a where a.person_id = s.person_id and cast(event_time as date) between index_wave1 - 365 and index_wave1), 0) as n_events_year,
               nullif((select count(*) from activity a where a.person_id = s.person_id and cast(event_time as date) between date '1998-01-01' and date '1998-05-31'), 0) as n_events_period
        from spine s""",
}
