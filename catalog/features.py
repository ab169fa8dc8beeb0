"""Queries for windowed event measures, flags and as-of records, each with its check."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.frames import frame, with_frames
from spinewise.functions.dates import out_of_hours_by_hour, out_of_hours_by_time, seconds_of_day
from spinewise.functions.missing import count_if_strict, is_in, max_strict, sum_strict
from spinewise.operators.asof import asof_filled, asof_record, asof_ties, asof_waves, latest_filled
from spinewise.operators.harmonise import anchor_flag
from spinewise.operators.link import link_to_spine, zero_fill
from spinewise.operators.windowed import (
    about_distinct,
    add_partials,
    anchor_to_date,
    any_where,
    between_anchors,
    count_where,
    day_partials,
    distinct_values,
    features_from_partials,
    fixed_period,
    look_back,
    row_count,
    total,
    window_features,
)

PERIOD = ("1998-01-01", "1998-05-31")
OUTCOME_END = "1999-12-31"


def both():
    return (F.col("ascotwave1") == 1) & (F.col("ascotwave2") == 1)


def spans(*suffixes):
    made = {
        "": look_back("index_wave1"),
        "_wave": between_anchors("index_wave1", "index_wave2", "_wave", both()),
        "_5m": fixed_period(*PERIOD),
    }
    return [made[s] for s in suffixes]


WINDOW_TESTS = {
    "": "day between index_wave1 - 365 and index_wave1",
    "_wave": "ascotwave1 = 1 and ascotwave2 = 1 and day between index_wave1 and index_wave2",
    "_5m": f"day between date '{PERIOD[0]}' and date '{PERIOD[1]}'",
}


def strict(test: str) -> str:
    """Rows where a test holds, null as soon as it is unknown for one row."""
    return f"case when count({test}) = count(*) then count(*) filter (where {test}) end"


def full_join(ctes: dict[str, str], key: str) -> str:
    """Full outer join of subqueries on one key."""
    first, *rest = ctes
    joins = "".join(f" full join ({ctes[n]}) {n} using ({key})" for n in rest)
    return f"({ctes[first]}) {first}{joins}"


def windowed(events: str, spine: str, event_key: str, spine_key: str, day: str, spans: dict[str, str], measures, key: str) -> str:
    """The plain form: events joined to the spine, one filter and grouping per window, full joins.

    ``measures`` gives (name, expression, suffixes or None).
    """
    joined = f"(select e.*, s.* exclude ({spine_key}), e.{event_key} as {key}_, {day} as day from {events} e join {spine} s on e.{event_key} = s.{spine_key})"
    ctes = {}
    for i, (suffix, test) in enumerate(spans.items()):
        cols = [f"{x} as {n}{suffix}" for n, x, only in measures if only is None or suffix in only]
        ctes[f"w{i}"] = f"select {key}_ as {key}, {', '.join(cols)} from {joined} where {test} group by {key}_"
    return full_join(ctes, key)


def measures():
    return [
        row_count("n_events"),
        count_where("n_finished", F.col("status") == "F"),
        count_where("n_urgent", F.col("priority") == "1-URGENT", strict=True),
        count_where("n_listed", is_in("priority", ["1-URGENT", "2-HIGH"])),
        count_where("n_known", F.col("priority").isNotNull()),
    ]


MEASURES_SQL = [
    ("n_events", "count(*)", None),
    ("n_finished", "count(*) filter (where status = 'F')", None),
    ("n_urgent", strict("priority = '1-URGENT'"), None),
    ("n_listed", "count(*) filter (where coalesce(priority in ('1-URGENT', '2-HIGH'), false))", None),
    ("n_known", "count(priority)", None),
]


def _measured(*suffixes):
    def run(spark, d):
        activity, spine = frame(spark, d, "activity"), frame(spark, d, "spine")
        return window_features(activity, spine, "person_id", "event_time", spans(*suffixes), measures())

    return run


def _measured_sql(suffixes):
    tests = {s: WINDOW_TESTS[s] for s in suffixes}
    body = windowed("activity", "spine", "person_id", "person_id", "cast(event_time as date)", tests, MEASURES_SQL, "person_id")
    return f"{with_frames('activity', 'spine')} select * from {body}"


def anchor_flags(spark, d):
    flagged = anchor_flag(frame(spark, d, "spine"), "ch_admission", "index_wave1", "CH_admission_flag")
    return flagged.select("person_id", "CH_admission_flag", both().alias("wave"))


def window_features_all(spark, d):
    spine = frame(spark, d, "spine")
    features = _measured("", "_5m", "_wave")(spark, d)
    linked = link_to_spine(spine.select("person_id", "segment"), {"activity": (features, "person_id")}, "person_id", check=[])
    return zero_fill(linked, prefix="n_")


def anchored_outcome_flag(spark, d):
    return window_features(
        frame(spark, d, "activity"),
        frame(spark, d, "spine"),
        "person_id",
        "event_time",
        [anchor_to_date("index_wave1", OUTCOME_END), *spans("_5m")],
        [
            any_where("died", F.col("status") == "P", spans=("",)),
            any_where("urgent_seen", F.col("priority") == "1-URGENT", spans=("",)),
            row_count("n_events", ("_5m",)),
        ],
        keep="",
    )


def distinct_services(spark, d):
    return window_features(
        frame(spark, d, "services"),
        frame(spark, d, "spine"),
        "person_id",
        "event_time",
        spans("", "_5m", "_wave"),
        [row_count("n_rows"), distinct_values("n_services", "service"), distinct_values("n_visits", "visit", ("_5m", "_wave"))],
    )


def timed_event_features(spark, d):
    calls = frame(spark, d, "calls")
    spine = frame(spark, d, "spine").withColumn("call_index", F.expr("date'2024-01-05' + cast(person_id % 10 as int)"))
    return window_features(
        calls,
        spine.withColumn("call_end", F.date_add("call_index", 10)),
        "person_id",
        "call_date",
        [fixed_period("2024-01-01", "2024-01-20"), between_anchors("call_index", "call_end", "_wave", both())],
        [
            row_count("n_calls"),
            count_where("n_out_of_hours", out_of_hours_by_hour("event_time"), strict=True),
            count_where("n_errors", F.col("kind") == "error"),
            count_where("n_valued", F.nullif("kind", F.lit("view")).isNotNull()),
            total("total_minutes", F.floor("value")),
        ],
    )


def out_of_hours_time(spark, d):
    """Calls per kind out of hours by each of the two rules."""
    timed = frame(spark, d, "calls").withColumn("clock", F.date_format("event_time", "HH:00:00"))
    timed = timed.withColumn("seconds", seconds_of_day("clock"))
    return timed.groupBy("kind").agg(
        F.count_if(out_of_hours_by_hour("event_time")).alias("n_by_hour"),
        F.count_if(out_of_hours_by_time("seconds")).alias("n_by_time"),
        F.count(F.lit(1)).alias("n"),
    )


def strict_sum(spark, d):
    """Strict and plain aggregates per person over values with gaps."""
    a = frame(spark, d, "activity").withColumn("flag", F.when(F.col("priority").isNotNull(), (F.col("priority") == "1-URGENT").cast("int")))
    return a.groupBy("person_id").agg(
        sum_strict("flag").alias("sum_strict"),
        F.sum("flag").alias("sum_known"),
        max_strict("flag").alias("max_strict"),
        count_if_strict(F.col("flag") == 0).alias("zero_strict"),
    )


def asof_one(spark, d):
    return asof_record(
        frame(spark, d, "activity"), frame(spark, d, "spine"), "person_id", "event_time", "index_wave1",
        ["event_id", "status", "priority"], ["event_id"],
    )


def asof_with_ties(spark, d):
    return asof_ties(
        frame(spark, d, "activity"), frame(spark, d, "spine"), "person_id", "event_time", "index_wave1",
        ["event_id", "status"],
    )


def asof_both_waves(spark, d):
    """The records at both index dates from one read of the history."""
    return asof_waves(
        frame(spark, d, "activity"), frame(spark, d, "spine"), "person_id", "event_time",
        {"_w1": "index_wave1", "_w2": "index_wave2"}, ["event_id", "status", "priority"], ["event_id"], exempt=["event_id", "status"],
    )


def asof_ties_both_waves(spark, d):
    anchors = {"one": "index_wave1", "two": "index_wave2"}
    return asof_ties(frame(spark, d, "activity"), frame(spark, d, "spine"), "person_id", "event_time", anchors, ["event_id", "status"])


def partials_of_months(spark, d):
    """The windows answered from sums by person and day, made of the events in three parts by their dates."""
    activity, spine = frame(spark, d, "services"), frame(spark, d, "spine")
    measures_ = [row_count("n_rows"), distinct_values("n_services", "service"), total("visits", F.col("visit") % 10, strict=True)]
    parts = [day_partials(activity.where(F.month("event_time") % 3 == i), "person_id", "event_time", measures_) for i in range(3)]
    whole = add_partials("person_id", add_partials("person_id", *parts[:2]), parts[2])
    return features_from_partials(whole, spine, "person_id", spans("", "_5m", "_wave"), measures_)


def about_distinct_services(spark, d):
    """Estimated numbers of services, within three percent of the exact ones (and one)."""
    services, spine = frame(spark, d, "services"), frame(spark, d, "spine")
    got = window_features(services, spine, "person_id", "event_time", spans("", "_5m"), [distinct_values("n", "visit"), about_distinct("about", "visit")])
    near = lambda s: (F.abs(F.col(f"about{s}") - F.col(f"n{s}")) <= 0.03 * F.col(f"n{s}") + 1).alias(f"near{s}")
    return got.select("person_id", "n", "n_5m", near(""), near("_5m"))


def asof_with_gaps_filled(spark, d):
    history = frame(spark, d, "activity").withColumn("state", F.nullif("status", F.lit("P")))
    return asof_filled(
        history, frame(spark, d, "spine"), "person_id", "event_time", "index_wave1",
        ["event_id", "state", "priority", "status"], ["event_id"], exempt=["status"],
    )


def latest_per_entity(spark, d):
    rows = frame(spark, d, "services").withColumn("late", F.when(F.col("visit") % 2 == 0, F.col("visit")))
    return latest_filled(rows, "service", "event_time", ["late", "person_id"], ["visit", "person_id"])


QUERIES = {
    "anchor_flag": anchor_flags,
    "lookback_features": _measured(""),
    "wave_features": _measured("_wave"),
    "period_features": _measured("_5m"),
    "window_features_all": window_features_all,
    "anchored_outcome_flag": anchored_outcome_flag,
    "distinct_services": distinct_services,
    "timed_event_features": timed_event_features,
    "out_of_hours_time": out_of_hours_time,
    "strict_sum": strict_sum,
    "asof_one": asof_one,
    "asof_ties": asof_with_ties,
    "asof_filled": asof_with_gaps_filled,
    "asof_waves": asof_both_waves,
    "asof_ties_waves": asof_ties_both_waves,
    "features_from_partials": partials_of_months,
    "about_distinct": about_distinct_services,
    "latest_filled": latest_per_entity,
}

_ALL = {s: WINDOW_TESTS[s] for s in ("", "_5m", "_wave")}
_VALID = """(select a.*, s.index_wave1, cast(a.event_time as date) as day, nullif(status, 'P') as state
             from activity a join spine s using (person_id) where a.event_time <= s.index_wave1)"""
_NAMES = [n + s for s in ("", "_5m", "_wave") for n, _, _ in MEASURES_SQL]

CHECKS = {
    "anchor_flag": f"""{with_frames('spine')}
        select person_id, ch_admission >= index_wave1 - 365 and ch_admission <= index_wave1 as CH_admission_flag,
               ascotwave1 = 1 and ascotwave2 = 1 as wave from spine""",
    "lookback_features": _measured_sql([""]),
    "wave_features": _measured_sql(["_wave"]),
    "period_features": _measured_sql(["_5m"]),
    "window_features_all": f"""{with_frames('activity', 'spine')}
        select s.person_id, s.segment, {', '.join(f'coalesce({n}, 0) as {n}' for n in _NAMES)}
        from spine s left join (select * from {windowed('activity', 'spine', 'person_id', 'person_id', 'cast(event_time as date)', _ALL, MEASURES_SQL, 'person_id')}) f
        on s.person_id = f.person_id""",
    "anchored_outcome_flag": f"""{with_frames('activity', 'spine')},
        joined as (select a.*, s.* exclude (person_id), cast(event_time as date) as day from activity a left join spine s on a.person_id = s.person_id),
        outcome as (select person_id, cast(max(case when status = 'P' then 1 else 0 end) as int) as died,
                           case when count(priority) = count(*) then cast(max(case when priority = '1-URGENT' then 1 else 0 end) as int) end as urgent_seen
                    from joined where day between index_wave1 and date '{OUTCOME_END}' group by person_id),
        period as (select person_id, count(*) as n_events_5m from joined where {WINDOW_TESTS['_5m']} group by person_id)
        select * from outcome left join period using (person_id)""",
    "distinct_services": f"""{with_frames('services', 'spine')} select * from """
    + windowed(
        "services", "spine", "person_id", "person_id", "cast(event_time as date)", _ALL,
        [
            ("n_rows", "count(*)", None),
            ("n_services", "count(distinct service) + cast(max(case when service is null then 1 else 0 end) as bigint)", None),
            ("n_visits", "count(distinct visit)", ("_5m", "_wave")),
        ],
        "person_id",
    ),
    "timed_event_features": f"""{with_frames('calls', 'spine')},
        indexed as (select *, date '2024-01-05' + cast(person_id % 10 as int) as call_index from spine) select * from """
    + windowed(
        "calls", "indexed", "person_id", "person_id", "call_date",
        {
            "_5m": "day between date '2024-01-01' and date '2024-01-20'",
            "_wave": "ascotwave1 = 1 and ascotwave2 = 1 and day between call_index and call_index + 10",
        },
        [
            ("n_calls", "count(*)", None),
            ("n_out_of_hours", "count(*) filter (where hour(event_time) >= 18 or hour(event_time) < 8)", None),
            ("n_errors", "count(*) filter (where kind = 'error')", None),
            ("n_valued", "count(*) filter (where kind <> 'view')", None),
            ("total_minutes", "cast(sum(floor(value)) as bigint)", None),
        ],
        "person_id",
    ),
    "out_of_hours_time": f"""{with_frames('calls')}
        select kind, count(*) filter (where hour(event_time) >= 18 or hour(event_time) < 8) as n_by_hour,
               count(*) filter (where hour(event_time) > 18 or hour(event_time) < 8) as n_by_time, count(*) as n
        from calls group by kind""",
    "strict_sum": f"""{with_frames('activity')},
        flagged as (select *, case when priority = '1-URGENT' then 1 when priority is not null then 0 end as flag from activity)
        select person_id, case when count(flag) = count(*) then cast(sum(flag) as bigint) end as sum_strict,
               cast(sum(flag) as bigint) as sum_known, case when count(flag) = count(*) then max(flag) end as max_strict,
               {strict('flag = 0')} as zero_strict
        from flagged group by person_id""",
    "asof_one": f"""{with_frames('activity', 'spine')}
        select person_id, event_id, status, priority from {_VALID}
        qualify row_number() over (partition by person_id order by event_time desc, event_id) = 1""",
    "asof_ties": f"""{with_frames('activity', 'spine')}
        select person_id, event_id, status from {_VALID}
        qualify rank() over (partition by person_id order by event_time desc) = 1""",
    "asof_filled": f"""{with_frames('activity', 'spine')},
        filled as (select person_id, event_time, event_id, status,
               first_value(state ignore nulls) over w as state, first_value(priority ignore nulls) over w as priority,
               row_number() over (partition by person_id order by event_time desc, event_id) as place
            from {_VALID}
            window w as (partition by person_id order by event_time desc, event_id rows between current row and unbounded following))
        select person_id, event_id, state, priority, status from filled where place = 1""",
    "asof_waves": f"""{with_frames('activity', 'spine')},
        valid as (select a.*, w.wave from activity a join (select person_id, 'w1' as wave, index_wave1 as anchor from spine union all select person_id, 'w2', index_wave2 from spine) w
                  on a.person_id = w.person_id and a.event_time <= w.anchor),
        filled as (select person_id, wave, event_id, status, first_value(priority ignore nulls) over w as priority,
                          row_number() over (partition by person_id, wave order by event_time desc, event_id) as place
                   from valid window w as (partition by person_id, wave order by event_time desc, event_id rows between current row and unbounded following)),
        one as (select * from filled where place = 1)
        select person_id, a.event_id as event_id_w1, a.status as status_w1, a.priority as priority_w1, b.event_id as event_id_w2, b.status as status_w2, b.priority as priority_w2
        from (select * from one where wave = 'w1') a full join (select * from one where wave = 'w2') b using (person_id)""",
    "asof_ties_waves": f"""{with_frames('activity', 'spine')}
        select a.person_id, w.wave, event_id, status
        from activity a join (select person_id, 'one' as wave, index_wave1 as anchor from spine union all select person_id, 'two', index_wave2 from spine) w
        on a.person_id = w.person_id and a.event_time <= w.anchor qualify rank() over (partition by a.person_id, w.wave order by event_time desc) = 1""",
    "features_from_partials": f"""{with_frames('services', 'spine')} select * from """
    + windowed(
        "services", "spine", "person_id", "person_id", "cast(event_time as date)", _ALL,
        [
            ("n_rows", "count(*)", None),
            ("n_services", "count(distinct service) + cast(max(case when service is null then 1 else 0 end) as bigint)", None),
            ("visits", "cast(sum(visit % 10) as bigint)", None),
        ],
        "person_id",
    ),
    "about_distinct": f"""{with_frames('services', 'spine')}, counted as (select * from """
    + windowed("services", "spine", "person_id", "person_id", "cast(event_time as date)", {s: WINDOW_TESTS[s] for s in ("", "_5m")}, [("n", "count(distinct visit)", None)], "person_id")
    + ") select *, n is not null or null as near, n_5m is not null or null as near_5m from counted",
    "latest_filled": f"""{with_frames('services')},
        filled as (select service, last_value(case when visit % 2 = 0 then visit end ignore nulls) over w as late, person_id,
               row_number() over (partition by service order by event_time desc, visit desc, person_id desc) as place
            from services
            window w as (partition by service order by event_time, visit, person_id rows between unbounded preceding and current row))
        select service, late, person_id from filled where place = 1""",
}
