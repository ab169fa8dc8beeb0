"""Queries for linking, harmonising and agreement, each with its check."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalog.frames import frame, load, with_frames
from spinewise.functions.dates import cap_date, out_of_hours_by_hour
from spinewise.functions.recode import any_source_flag, bed_capacity, differs, either_flag, years_registered
from spinewise.operators.agreement import (
    agreement_report,
    all_source_agreement,
    availability_coverage,
    crosstab,
    distinct_rows,
    frequency,
    link_checks,
    pairwise_agreement,
    source_coverage,
    tally,
    within_days,
)
from spinewise.operators.asof import latest_filled
from spinewise.operators.harmonise import area_fifth, date_disagreement, harmonise, prioritise
from spinewise.operators.link import Provider, assemble, entity_link, lookup, natural_left_join, waves_wide
from spinewise.operators.report import dictionary

VERDICTS = {"label": "by_label", "length": "by_length", "language": "by_language"}
LEVELS = ["Good", "Poor", "Missing"]
DAYS = {"first": "first_day", "last": "last_day", "finished": "finished_day"}
STATUS = {"F": "Finished", "O": "Open"}
CAP = "2000-01-01"


def waves(spark, d):
    people = frame(spark, d, "spine").select(
        "person_id", F.concat(F.lit("C"), F.col("person_id").cast("string")).alias("hashed_id"), (F.col("person_id") % 2 + 1).alias("group")
    )
    return waves_wide(
        people,
        frame(spark, d, "yearly"),
        [
            Provider(F.col("group") == 1, F.col("provider") == 1, "person_id", "client", drop={1: ["provider", "hashed"], 2: ["provider", "hashed"]}),
            Provider(
                F.col("group") == 2, F.col("provider") == 2, "hashed_id", "hashed", F.upper("hashed"),
                drop={1: ["provider", "client"], 2: ["provider", "client", "largest"]}, drop_people=["hashed_id"],
            ),
        ],
        wave="wave",
        lead=["person_id"],
    )


def assemble_full(spark, d):
    orders = frame(spark, d, "activity").groupBy("person_id").agg(F.count(F.lit(1)).alias("n_orders"), F.max("priority").alias("priority"))
    calls = frame(spark, d, "calls").groupBy("person_id").agg(F.count(F.lit(1)).alias("n_calls"), F.max("kind").alias("kind"))
    spine = frame(spark, d, "spine").select("person_id", "segment")
    return assemble({"orders": orders, "calls": calls, "spine": spine}, "person_id")


def any_flag(spark, d):
    sources = frame(spark, d, "sources")
    return sources.select("doc_id", either_flag("quality", "long_text").alias("either"), either_flag("english", "toxic").alias("second"))


def natural_join(spark, d):
    nation = load(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    left = load(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return natural_left_join(natural_left_join(left, nation), load(spark, d, "region"))


def lookup_band(spark, d):
    areas = load(spark, d, "nation").select("n_nationkey", (F.col("n_nationkey") % 12).alias("decile"))
    linked = area_fifth(frame(spark, d, "spine").select("person_id", "area"), areas, "area", "n_nationkey", "decile")
    return lookup(linked, load(spark, d, "nation"), "area", "n_nationkey", {"n_name": "area_name"})


def harmonised(spark, d):
    return harmonise(
        frame(spark, d, "activity").select("event_id", "status", "priority"),
        {"state": ("status", STATUS), "urgency": ("priority", {"1-URGENT": "High", "2-HIGH": "High", "3-MEDIUM": "Low"}), "listed": ("priority", None)},
    ).drop("status", "priority")


def prioritised(spark, d):
    docs = prioritise(frame(spark, d, "sources"), "final", list(VERDICTS.values()))
    return prioritise(docs, "flag", ["quality", "long_text", "english"], missing=None).select("doc_id", "final", "flag")


def capped_dates(spark, d):
    return frame(spark, d, "dated").select(
        "person_id", *[cap_date(c, CAP).alias(c) for c in DAYS.values()]
    )


def disagreeing_dates(spark, d):
    dated = frame(spark, d, "dated").withColumn("finished_day", cap_date("finished_day", CAP))
    flagged = date_disagreement(dated, {"first_last": ("first_day", "last_day"), "last_finished": ("last_day", "finished_day")})
    return flagged.select("person_id", "first_last", "last_finished", differs("first_day", "last_day").alias("exact"))


def any_source(spark, d):
    return frame(spark, d, "sources").select("doc_id", any_source_flag(["quality", "long_text", "english"]).alias("any_good"))


def coverage(spark, d):
    return source_coverage(frame(spark, d, "sources"), VERDICTS, LEVELS)


def coverage_of_found(spark, d):
    return source_coverage(frame(spark, d, "sources"), {"language": "lang", "label": "by_label", "toxic": "toxic"})


def availability(spark, d):
    return availability_coverage(frame(spark, d, "sources"), {"quality": "quality", "length": "long_text", "language": "english"})


def level_frequency(spark, d):
    return frequency(frame(spark, d, "activity"), "priority")


def valid_frequency(spark, d):
    return source_coverage(frame(spark, d, "sources"), {"quality": "quality", "length": "long_text"}, valid=True)


def out_of_hours_check(spark, d):
    """Calls marked out of hours though their hour lies well inside the day: none are expected."""
    hour, marked = F.hour("event_time"), out_of_hours_by_hour("event_time")
    return link_checks(frame(spark, d, "calls"), known=["value"], n_out_of_hours=marked, n_to_check=marked & (hour < 18) & (hour > 8))


def crosstab_totals(spark, d):
    a = frame(spark, d, "activity").select("status", F.col("priority"))
    return crosstab(a, "status", "priority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"])


def pairs(spark, d):
    return pairwise_agreement(frame(spark, d, "sources"), VERDICTS)


def everyone(spark, d):
    return all_source_agreement(frame(spark, d, "sources"), VERDICTS)


def agreement(spark, d):
    return agreement_report(frame(spark, d, "sources"), VERDICTS)


def date_agreement(spark, d):
    dated = frame(spark, d, "dated").withColumn("finished_day", cap_date("finished_day", CAP))
    return agreement_report(dated, DAYS, difference=within_days(500), missing=None)


def _homes(spark, d):
    newest = latest_filled(frame(spark, d, "deliveries"), "home", "event_time", ["last_part", "last_flag"], ["visit", "line"])
    homes = frame(spark, d, "homes")
    people = frame(spark, d, "activity").select("event_id", (F.col("event_id") % 113).alias("home"))
    regulator = homes.select("home", "beds_raw", "area")
    return entity_link(people, homes.select("home", "name"), {"regulator": (regulator, "home"), "newest": (newest, "home")}, "home")


def linked_entities(spark, d):
    return _homes(spark, d)[0]


def linked_people(spark, d):
    _, people = _homes(spark, d)
    return people.withColumns({"capacity": bed_capacity("beds_raw"), "years": years_registered("area")}).drop("name")


def link_qa(spark, d):
    docs = frame(spark, d, "sources")
    return link_checks(
        docs, keys=["doc_id", "lang", "quality"], known=["quality", "toxic"], n_long=F.col("n_chars") > 2000, n_disagree=differs("by_label", "by_length") == "Different"
    )


def distinct_projection(spark, d):
    docs = frame(spark, d, "sources")
    return distinct_rows(docs, ["lang", "quality", "by_length"])


def tallies(spark, d):
    return tally(frame(spark, d, "sources"), "lang", "quality")


def variable_dictionary(spark, d):
    """The variables of a table, each with its missing rows."""
    a = frame(spark, d, "activity")
    missing = source_coverage(a.select(*[F.col(c).isNull().cast("int").alias(c) for c in a.columns]), {c: c for c in a.columns}, ["0", "1"], total=False)
    counts = missing.where("level = '1'").unpivot([], [f"n_{c}" for c in a.columns], "counted", "n_missing")
    return dictionary(a).select("variable").join(counts.withColumn("variable", F.expr("substring(counted, 3)")), "variable").select("variable", "n_missing")


QUERIES = {
    "waves_wide": waves,
    "assemble_full": assemble_full,
    "any_flag": any_flag,
    "natural_join": natural_join,
    "lookup_band": lookup_band,
    "harmonise": harmonised,
    "priority_coalesce": prioritised,
    "cap_date": capped_dates,
    "date_disagreement": disagreeing_dates,
    "any_source_flag": any_source,
    "source_coverage": coverage,
    "source_coverage_found_levels": coverage_of_found,
    "availability_coverage": availability,
    "frequency": level_frequency,
    "frequency_valid": valid_frequency,
    "out_of_hours_check": out_of_hours_check,
    "crosstab_totals": crosstab_totals,
    "pairwise_agreement": pairs,
    "all_agreement": everyone,
    "agreement_report": agreement,
    "date_agreement_report": date_agreement,
    "entity_link": linked_entities,
    "capacity_band": linked_people,
    "link_qa": link_qa,
    "distinct_rows": distinct_projection,
    "tally": tallies,
    "dictionary": variable_dictionary,
}

_CAPPED = f"case when {{c}} >= date '{CAP}' then null else {{c}} end"
_DATED = f"dated2 as (select person_id, first_day, last_day, {_CAPPED.format(c='finished_day')} as finished_day from dated)"


def _agree(a: str, b: str, test: str) -> str:
    return f"case when {test.format(a=a, b=b)} then 'Different' else 'Same' end"


def group_shares(table: str, sources: dict[str, str], test: str, known: str, everyone: bool = True) -> dict[str, str]:
    """Per group of sources, a subquery with level, n and percent, and a total row."""
    groups = {"all": list(sources)} if everyone else {}
    groups |= {f"{a}_{b}": [a, b] for a, b in combinations(sources, 2)}
    out = {}
    for name, members in groups.items():
        cols = [sources[m] for m in members]
        verdicts = [_agree(a, b, test) for a, b in combinations(cols, 2)]
        same = " and ".join(f"({v}) = 'Same'" for v in verdicts)
        rows = f"select case when {same} then 'Same' else 'Different' end as level from {table} where {' and '.join(known.format(c=c) for c in cols)}"
        out[name] = f"""select l.level, count(r.level) as n, count(r.level) / nullif((select count(*) from ({rows})), 0) as percent
            from (values ('Same'), ('Different')) l(level) left join ({rows}) r on l.level = r.level group by l.level
            union all select 'Total', count(*), count(*) / nullif(count(*), 0) from ({rows})"""
    return out


def side_by_side(parts: dict[str, str]) -> str:
    first, *rest = parts
    cols = ", ".join(f"t{i}.n as n_{n}, t{i}.percent as percent_{n}" for i, n in enumerate(parts))
    joins = " ".join(f"join ({parts[n]}) t{i} on t0.level = t{i}.level" for i, n in enumerate(parts) if i)
    return f"select t0.level, {cols} from ({parts[first]}) t0 {joins}"


def covered(table: str, sources: dict[str, str], levels: list[str] | None, total: bool = True, valid: bool = False) -> str:
    listed = (
        "select * from (values " + ", ".join(f"('{x}')" for x in levels) + ") v(level)"
        if levels
        else " union ".join(f"select cast({c} as string) as level from {table}" for c in sources.values())
    )
    cols = ", ".join(
        f"(select count(*) from {table} where cast({c} as string) is not distinct from l.level) as n_{s}, "
        f"(select count(*) from {table} where cast({c} as string) is not distinct from l.level) / (select count(*) from {table}) as percent_{s}"
        for s, c in sources.items()
    )
    totals = ", ".join(f"count(*) as n_{s}, count(*) / count(*) as percent_{s}" for s in sources)
    if valid:
        cols += "".join(
            f", case when l.level is not null then (select count(*) filter (where cast({c} as string) = l.level) / count({c}) from {table}) end as valid_percent_{s}"
            for s, c in sources.items()
        )
        totals += "".join(f", count({c}) / count({c}) as valid_percent_{s}" for s, c in sources.items())
    bottom = f" union all select 'Total', {totals} from {table}" if total else ""
    if levels:  # whatever is counted in no row above, worked out from what is known in all
        inside = ", ".join(f"'{x}'" for x in levels)
        for level, test in (("'(not listed)'", f"cast({{c}} as string) not in ({inside})"), ("null", "{c} is null")):
            n = {s: f"(select count(*) from {table} where {test.format(c=c)})" for s, c in sources.items()}
            cells = ", ".join(f"{n[s]} as n_{s}, {n[s]} / (select count(*) from {table}) as percent_{s}" for s in sources)
            bottom += f" union all select {level}, {cells} where {' + '.join(n.values())} > 0"
    return f"select l.level, {cols} from ({listed}) l{bottom}"


_LABELS = "coalesce(nullif(by_label, 'Missing'), nullif(by_length, 'Missing'), nullif(by_language, 'Missing'), 'Missing')"
_KNOWN = "{c} <> 'Missing'"
_AVAILABLE = "case when {c} is null then 'Missing' else 'Available' end as {c}"
_NEWEST = """newest as (select home, last_part, last_flag from (
    select home, last_value(last_part ignore nulls) over w as last_part, last_value(last_flag ignore nulls) over w as last_flag,
           row_number() over (partition by home order by event_time desc, visit desc, line desc) as place
    from deliveries window w as (partition by home order by event_time, visit, line rows between unbounded preceding and current row)) where place = 1)"""
_OR = "case when {a} = 1 or {b} = 1 then 1 when {a} is not null and {b} is not null then 0 end"

CHECKS = {
    "waves_wide": f"""{with_frames('spine', 'yearly')}
        select s.person_id, concat('C', cast(s.person_id as string)) as hashed_id, s.person_id % 2 + 1 as group, a.n_orders, a.largest, b.n_orders as n_orders_w2, b.largest as largest_w2
        from spine s left join yearly a on s.person_id = a.client and a.wave = 1 and a.provider = 1
             left join yearly b on s.person_id = b.client and b.wave = 2 and b.provider = 1
        where s.person_id % 2 = 0
        union all
        select s.person_id, null, s.person_id % 2 + 1, a.n_orders, a.largest, b.n_orders, null
        from spine s left join yearly a on concat('C', cast(s.person_id as string)) = upper(a.hashed) and a.wave = 1 and a.provider = 2
             left join yearly b on concat('C', cast(s.person_id as string)) = upper(b.hashed) and b.wave = 2 and b.provider = 2
        where s.person_id % 2 = 1""",
    "assemble_full": f"""{with_frames('activity', 'calls', 'spine')}
        select * from (select person_id, count(*) as n_orders, max(priority) as priority from activity group by person_id) a
        full join (select person_id, count(*) as n_calls, max(kind) as kind from calls group by person_id) b using (person_id)
        full join (select person_id, segment from spine) c using (person_id)""",
    "any_flag": f"""{with_frames('sources')}
        select doc_id, {_OR.format(a='quality', b='long_text')} as either, {_OR.format(a='english', b='toxic')} as second from sources""",
    "natural_join": """select r_regionkey, n_nationkey, s_suppkey, s_name, s_acctbal, n_name, r_name
        from supplier left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "lookup_band": f"""{with_frames('spine')},
        areas as (select n_nationkey, n_name, n_nationkey % 12 as decile from nation)
        select person_id, area, decile as IMD_decile, n_name as area_name,
               case when decile in (1, 2) then 'Most deprived fifth' when decile in (3, 4) then 'Second most deprived fifth'
                    when decile in (5, 6) then 'Middle fifth' when decile in (7, 8) then 'Second least deprived fifth'
                    when decile in (9, 10) then 'Least deprived fifth' end as IMD_quintile
        from spine left join areas on area = n_nationkey""",
    "harmonise": f"""{with_frames('activity')}
        select event_id, case status when 'F' then 'Finished' when 'O' then 'Open' else 'Missing' end as state,
               case priority when '1-URGENT' then 'High' when '2-HIGH' then 'High' when '3-MEDIUM' then 'Low' else 'Missing' end as urgency,
               coalesce(priority, 'Missing') as listed from activity""",
    "priority_coalesce": f"""{with_frames('sources')}
        select doc_id, {_LABELS} as final, coalesce(quality, long_text, english) as flag from sources""",
    "cap_date": f"""{with_frames('dated')}
        select person_id, {', '.join(_CAPPED.format(c=c) + ' as ' + c for c in DAYS.values())} from dated""",
    "date_disagreement": f"""{with_frames('dated')}, {_DATED}
        select person_id, case when abs(last_day - first_day) > 30 then 'Disagree' else 'Agree' end as first_last,
               case when finished_day is not null then case when abs(last_day - finished_day) > 30 then 'Disagree' else 'Agree' end end as last_finished,
               case when first_day <> last_day then 'Different' else 'Same' end as exact from dated2""",
    "any_source_flag": f"""{with_frames('sources')}
        select doc_id, case when quality = 1 or long_text = 1 or english = 1 then 1
               when quality is null and long_text is null and english is null then null else 0 end as any_good from sources""",
    "source_coverage": f"{with_frames('sources')} {covered('sources', VERDICTS, LEVELS)}",
    "source_coverage_found_levels": f"{with_frames('sources')} {covered('sources', {'language': 'lang', 'label': 'by_label', 'toxic': 'toxic'}, None)}",
    "availability_coverage": f"""{with_frames('sources')},
        flags as (select {', '.join(_AVAILABLE.format(c=c) for c in ('quality', 'long_text', 'english'))} from sources)
        {covered('flags', {'quality': 'quality', 'length': 'long_text', 'language': 'english'}, ['Available', 'Missing'])}""",
    "frequency": f"""{with_frames('activity')}
        select priority as level, count(*) as n, count(*) / (select count(*) from activity) as percent from activity group by priority
        union all select 'Total', count(*), count(*) / count(*) from activity""",
    "frequency_valid": f"{with_frames('sources')} {covered('sources', {'quality': 'quality', 'length': 'long_text'}, None, valid=True)}",
    "out_of_hours_check": f"""{with_frames('calls')},
        marked as (select *, hour(event_time) >= 18 or hour(event_time) < 8 as outside from calls)
        select count(*) as rows, count(value) as known_value, count(*) - count(value) as missing_value,
               count(*) filter (where outside) as n_out_of_hours,
               count(*) filter (where outside and hour(event_time) < 18 and hour(event_time) > 8) as n_to_check from marked""",
    "crosstab_totals": f"""{with_frames('activity')}
        select case when grouping(status) = 1 then 'Total' else status end as status,
               {', '.join(f"count(*) filter (where priority = '{x}') as " + f'"{x}"' for x in ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'))},
               count(*) filter (where priority not in ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')) as "(not listed)",
               count(*) filter (where priority is null) as "(unknown)", count(*) as Total from activity group by rollup (status)""",
    "pairwise_agreement": f"{with_frames('sources')} "
    + " union all ".join(
        f"select '{n}' as pair, level, n, percent from ({sql})" for n, sql in group_shares("sources", VERDICTS, "{a} <> {b}", _KNOWN, False).items()
    ),
    "all_agreement": f"{with_frames('sources')} select * from ({group_shares('sources', VERDICTS, '{a} <> {b}', _KNOWN)['all']})",
    "agreement_report": f"{with_frames('sources')} {side_by_side(group_shares('sources', VERDICTS, '{a} <> {b}', _KNOWN))}",
    "date_agreement_report": f"""{with_frames('dated')}, {_DATED}
        {side_by_side(group_shares('dated2', DAYS, 'abs({a} - {b}) > 500', '{c} is not null'))}""",
    "entity_link": f"""{with_frames('homes', 'deliveries')}, {_NEWEST}
        select h.home, h.name, h.beds_raw, h.area, last_part, last_flag from homes h left join newest using (home)""",
    "capacity_band": f"""{with_frames('homes', 'deliveries', 'activity')}, {_NEWEST}
        select a.event_id, a.event_id % 113 as home, beds_raw, area, last_part, last_flag,
               case when beds_raw is null then 'Missing' when beds_raw <= 24 then '0-24' when beds_raw <= 49 then '25-49' else '50+' end as capacity,
               case when area is null then 'Missing' when area <= 10 then 'Less than 10 years' else 'More than 10 years' end as years
        from activity a left join homes h on a.event_id % 113 = h.home left join newest w on h.home = w.home""",
    "link_qa": f"""{with_frames('sources')}
        select count(*) as rows, count(distinct doc_id) as distinct_doc_id, count(distinct lang) as distinct_lang,
               (select count(*) from (select distinct quality from sources)) as distinct_quality,
               count(quality) as known_quality, count(*) - count(quality) as missing_quality,
               count(toxic) as known_toxic, count(*) - count(toxic) as missing_toxic,
               count(*) filter (where n_chars > 2000) as n_long, count(*) filter (where by_label <> by_length) as n_disagree from sources""",
    "distinct_rows": f"{with_frames('sources')} select count(*) as n from (select distinct lang, quality, by_length from sources)",
    "tally": f"{with_frames('sources')} select lang, quality, count(*) as n from sources group by lang, quality",
    "dictionary": f"{with_frames('activity')} "
    + " union all ".join(
        f"select '{c}' as variable, count(*) filter (where {c} is null) as n_missing from activity"
        for c in ("event_id", "person_id", "event_time", "status", "priority", "amount")
    ),
}
