"""Cohort first, several anchors, partials, sketches, incomplete rows, variable lists."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_operators import INDEX, SECOND, events, fails, spine, three_spans
from test_queries import SMALL, exchanges_of, plan_of

from __spark_entry__ import queries
from spinewise.operators import asof, report, windowed
from spinewise.operators.varlist import Variable, VariableList
from spinewise.plans import reports

PRESETS = ["inpatient_features", "community_features", "emergency_features", "outpatient_features", "ambulance_features"]


# --- cohort first ------------------------------------------------------------------------------------


@pytest.mark.parametrize("collapse", [True, False])
def test_people_outside_the_spine_are_left_out_unless_asked_for(spark, collapse):
    df = events(spark, [("a", INDEX, 1, "x"), ("z", date(2023, 7, 1), 1, "x"), ("0", date(2023, 7, 1), 1, "x"), ("b", date(2023, 7, 1), 1, "x")])
    measures = [windowed.row_count("n"), windowed.distinct_values("codes", "code")]
    own = windowed.window_features(df, spine(spark), "who", "day", three_spans(), measures, collapse=collapse)
    assert rows(own) == [("a", 1, 1, None, None, 1, 1), ("b", None, None, 1, 1, 1, 1)]
    every = windowed.window_features(df, spine(spark), "who", "day", three_spans(), measures, collapse=collapse, outsiders=True)
    assert rows(every) == [("0", None, None, 1, 1, None, None), *rows(own), ("z", None, None, 1, 1, None, None)]
    fixed = [windowed.fixed_period("2023-06-01", "2023-10-31")]
    assert rows(windowed.window_features(df, spine(spark), "who", "day", fixed, measures, collapse=collapse)) == [("b", 1, 1)]


@pytest.mark.parametrize("name", PRESETS)
def test_events_of_a_preset_meet_the_cohort_below_the_first_exchange(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "_person" in line]
    assert len(joins) == 1 and "Inner" in joins[0] and "LeftOuter" not in joins[0]
    below = plan[plan.index(joins[0]) :]
    # Below the join there is the test of the spine, and what the source itself is derived by.
    assert [e for e in exchanges_of(below) if e not in (["pseudonhsno"], ["l_orderkey"], ["o_orderkey"])] == []


def test_a_large_cohort_reaches_the_scan_by_its_keys(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        activity, people = _frames(spark)
        got = windowed.window_features(activity, people, "person_id", "event_time", [windowed.fixed_period("1998-01-01", "1998-05-31")], [windowed.row_count("n")], collapse=True)
        plan = plan_of(got)
        want = rows(activity.join(people, "person_id").where("event_time >= '1998-01-01' and event_time < '1998-06-01'").groupBy("person_id").count())
        assert rows(got) == want
    finally:
        for k in settings:
            spark.conf.unset(k)
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "o_orderdate" in line)
    assert "GreaterThanOrEqual(o_custkey" in scan and "LessThanOrEqual(o" in scan
    assert "might_contain" in plan


def _frames(spark):
    from catalog.frames import frame

    return frame(spark, SMALL, "activity"), frame(spark, SMALL, "spine").where("person_id % 5 = 1").select("person_id", "index_wave1")


# --- several anchors ---------------------------------------------------------------------------------


def history(spark, seed, people=40, n=600):
    rng = random.Random(seed)
    start = datetime(2023, 1, 1)
    data = [(f"p{rng.randrange(people)}" if rng.random() > 0.3 else "p0", start + timedelta(days=rng.randrange(300)), i, rng.choice([None, "x", "y"]), rng.choice([None, 1, 2])) for i in range(n)]
    return data, spark.createDataFrame(data, "who string, start timestamp, id int, a string, b int")


def anchored(spark, people=30):
    rng = random.Random(1)
    data = [(f"p{i}", INDEX + timedelta(days=rng.randrange(-100, 100)), None if i % 7 == 3 else SECOND) for i in range(people)]
    return data, spark.createDataFrame(data, "person string, one date, two date")


@pytest.mark.parametrize("large", [False, True])
def test_records_at_two_anchors_equal_those_at_each(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(asof, "fits", lambda *a: False)
    data, df = history(spark, 5)
    people, sp = anchored(spark)
    got = asof.asof_waves(df, sp, "who", "start", {"_1": "one", "_2": "two"}, ["id", "a", "b"], ["id"], exempt=["id"], spine_key="person")
    want = []
    for who, *anchors in people:
        row = [who]
        for anchor in anchors:
            valid = [] if anchor is None else sorted((r for r in data if r[0] == who and r[1] <= datetime.combine(anchor, datetime.min.time())), key=lambda r: (-r[1].timestamp(), r[2]))
            row += [valid[0][2] if valid else None, *[next((r[k] for r in valid if r[k] is not None), None) for k in (3, 4)]]
        if any(v is not None for v in row[1:]):
            want.append(tuple(row))
    assert rows(got) == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
    ties = asof.asof_ties(df, sp, "who", "start", {"one": "one", "two": "two"}, ["id"], spine_key="person")
    for name in ("one", "two"):
        alone = asof.asof_ties(df, sp.where(F.col(name).isNotNull()), "who", "start", name, ["id"], spine_key="person")
        assert rows(ties.where(F.col("wave") == name).drop("wave")) == rows(alone)


def test_both_anchors_take_one_read(spark):
    for name in ("asof_waves", "asof_ties_waves"):
        plan = plan_of(queries()[name](spark, SMALL))
        assert plan.count("o_orderdate") and len([x for x in plan.splitlines() if "FileScan" in x and "orders.parquet" in x]) == 1


@pytest.mark.parametrize("large", [False, True])
def test_a_second_spine_row_fails_every_record_operator(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(asof, "fits", lambda *a: False)
    _, df = history(spark, 6, n=30)
    twice = spark.createDataFrame([("p0", INDEX), ("p0", SECOND), ("p1", INDEX)], "who string, index date")
    for got in (
        asof.asof_ties(df, twice, "who", "start", "index", ["id"]),
        asof.asof_record(df, twice, "who", "start", "index", ["id"]),
        asof.asof_filled(df, twice, "who", "start", "index", ["a"], ["id"]),
        asof.asof_waves(df, twice, "who", "start", {"": "index"}, ["id"]),
    ):
        fails(got, "spine: more than one row")


# --- partials and sketches ---------------------------------------------------------------------------


def many_events(spark, seed, n=3000, months=range(1, 13)):
    rng = random.Random(seed)
    data = [
        (rng.choice(["a", "a", "a", "b", "c", "z", None]), date(2023, rng.choice(list(months)), rng.randrange(1, 28)), rng.choice([None, 0, 1, 1]), rng.choice([None, *"uvwxyz"]))
        for _ in range(n)
    ]
    return events(spark, data)


def measures():
    return [
        windowed.row_count("n"),
        windowed.count_where("strict", F.col("flag") == 1, strict=True),
        windowed.total("sum", "flag"),
        windowed.any_where("ever", F.col("code") == "u"),
        windowed.distinct_values("codes", "code"),
        windowed.about_distinct("about", "code"),
    ]


def test_a_month_appended_equals_a_full_run(spark):
    old, new = many_events(spark, 1, months=range(1, 7)), many_events(spark, 2, n=900, months=[7])
    kept = windowed.day_partials(old, "who", "day", measures())
    extended = windowed.add_partials("who", kept, windowed.day_partials(new, "who", "day", measures()))
    full = windowed.window_features(old.union(new), spine(spark), "who", "day", three_spans(), measures())
    assert rows(windowed.features_from_partials(extended, spine(spark), "who", three_spans(), measures())) == rows(full)
    again = windowed.day_partials(old.union(new), "who", "day", measures()).drop("_sketch4")
    same = extended.drop("_sketch4")
    assert rows(same.select(*again.columns)) == rows(again)
    assert extended.count() < old.count() + new.count()


def test_partials_keep_windows_that_nobody_thought_of(spark):
    old = many_events(spark, 3)
    kept = windowed.day_partials(old, "who", "day", measures()[:3])
    span = [windowed.look_back("index_wave1", 17, "_short"), windowed.anchor_to_date("index_wave2", "2023-09-09", "_rest")]
    assert rows(windowed.features_from_partials(kept, spine(spark), "who", span, measures()[:3])) == rows(
        windowed.window_features(old, spine(spark), "who", "day", span, measures()[:3])
    )


@pytest.mark.parametrize("collapse", [True, False])
def test_sketches_are_near_whatever_the_number_of_values(spark, collapse):
    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 1000 == 1, "b").otherwise("c").alias("who"),
        F.expr("date'2023-02-01' + cast(id % 20 as int)").alias("day"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("v"), F.col("id") % 40_000)).alias("value"),
    )
    both = [windowed.distinct_values("exact", "value"), windowed.about_distinct("about", "value"), windowed.row_count("n")]
    got = windowed.window_features(df, spine(spark), "who", "day", three_spans()[:1], both, collapse=collapse)
    found = {r["who"]: r for r in got.collect()}
    assert len(found) == 3 and found["a"]["exact"] > 10_000
    for r in found.values():
        assert abs(r["about"] - r["exact"]) <= 0.03 * r["exact"]
    assert found["b"]["about"] == found["b"]["exact"]


@pytest.mark.parametrize("collapse", [True, False])
def test_sketches_beside_distinct_values_found_in_one_of_the_windows_only(spark, collapse):
    data = [("a", date(2023, 2, 1), 1, "u"), ("a", date(2023, 4, 1), 1, "v"), ("a", date(2023, 4, 2), 1, None)]
    ends = [windowed.fixed_period("2023-02-01", "2023-02-28", "_feb"), windowed.fixed_period("2023-04-01", "2023-04-30", "_apr"), windowed.fixed_period("2023-02-01", "2023-04-30", "_all")]
    both = [windowed.distinct_values("exact", "code"), windowed.about_distinct("about", "code")]
    got = windowed.window_features(events(spark, data), spine(spark), "who", "day", ends, both, collapse=collapse)
    assert [(r["exact_feb"], r["about_feb"], r["exact_apr"], r["about_apr"], r["exact_all"], r["about_all"]) for r in got.collect()] == [(1, 1, 2, 2, 3, 3)]


# --- reports -----------------------------------------------------------------------------------------


def test_incomplete_rows_are_counted_by_their_first_cause_as_they_go(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (None, None, 2.0), (3, None, 3.0), (4, "y", float("nan")), (5, "z", None), (6, "w", 6.0)], "a int, b string, c double")
    kept, seen = report.complete_rows(df)
    assert rows(kept) == [(1, "x", 1.0), (6, "w", 6.0)]
    assert seen.get == {"kept": 2, "a": 1, "b": 1, "c": 2}
    assert rows(report.missing_causes(df)) == [("(complete)", 2), ("a", 1), ("b", 1), ("c", 2)]
    assert rows(report.missing_causes(df, ["c", "a"])) == [("(complete)", 3), ("a", 1), ("c", 2)]
    assert rows(report.complete_rows(df.limit(0))[0]) == []


@pytest.mark.parametrize("most,buckets", [(10, 4), (3, 2), (10_000, 64)])
def test_quantiles_rank_no_more_values_than_allowed(spark, monkeypatch, most, buckets):
    rng = np.random.default_rng(4)
    wide = np.concatenate([rng.normal(size=3000), np.full(1500, 0.5), np.exp(rng.normal(0, 9, 500))])
    df = spark.createDataFrame([(float(v), float(i % 13) if i % 3 else None) for i, v in enumerate(wide)], "x double, y double")
    got = {r["variable"]: list(r)[1:] for r in report.quantiles(df, ["x", "y"], (0.0, 0.1, 0.5, 0.75, 1.0), buckets, most).collect()}
    few = [float(i % 13) for i in range(len(wide)) if i % 3]
    for name, values in (("x", wide), ("y", few)):
        assert got[name][0] == len(values)
        assert got[name][1:] == pytest.approx([np.quantile(values, p) for p in (0, 0.1, 0.5, 0.75, 1)])


def test_quantiles_take_nan_as_unknown(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double")
    assert [tuple(r) for r in report.quantiles(df, ["x"], (0.0, 0.5, 1.0)).collect()] == [("x", 2, 1.0, 2.0, 3.0)]
    assert report.quantiles(df.where("x is null"), ["x"]).collect() == []


def people(spark, sexes):
    data = [(s, float(i), i % 3) for i, s in enumerate(sexes)]
    return spark.createDataFrame(data, "sex_final string, score double, n_events int")


LEVELS = {"sex_final": ["Female", "Male"], report.OVERALL: [report.OVERALL]}


def test_a_merged_table_has_a_block_for_every_level_found(spark):
    df = people(spark, ["Male", "Female", "Other", None, "Other", "Any"])
    wide = reports.stratified_tables(df, {"score": "Score"}, ["merged"], LEVELS)["merged"]
    blocks = list(dict.fromkeys(c.rsplit(": ", 1)[0] for c in wide.columns[2:]))
    assert blocks == ["sex_final: Female", "sex_final: Male", "sex_final: Any", "sex_final: Other", "sex_final: (Missing)", "Overall: Overall"]
    row = wide.collect()[0]
    assert row["sex_final: Other: known"] == 2 and row["sex_final: Other: mean"] == 3.0
    assert sum(row[f"{b}: known"] for b in blocks[:-1]) == row["Overall: Overall: known"] == 6


def test_a_listed_level_that_nobody_has_keeps_its_block(spark):
    wide = reports.stratified_tables(people(spark, ["Male"] * 3), {"score": "Score"}, ["merged", "printed"], LEVELS)
    assert wide["merged"].collect()[0]["sex_final: Female: known"] == 0
    row = wide["printed"].collect()[0]
    assert (row["sex_final: Male: text"], row["sex_final: Female: text"], row["Overall: Overall: text"]) == ("1.00 (1.00)", None, "1.00 (1.00)")


def test_a_stratum_of_too_many_levels_fails(spark):
    df = people(spark, [f"s{i}" for i in range(30)])
    table = report.stratified_table(df, {"score": "Score"}, ["sex_final"])
    with pytest.raises(ValueError, match="more than 10 levels: sex_final"):
        report.found_levels(table, LEVELS, most=10)


def test_all_listed_outcomes_are_one_grouping(spark):
    df = people(spark, ["Male", "Female"] * 5)
    listed = VariableList([Variable("score", "Score"), Variable("n_events")])
    table = reports.stratified_tables(df, listed, ["means"], LEVELS)["means"]
    assert len(exchanges_of(plan_of(table))) == 1
    assert {r["label"] for r in table.collect()} == {"Score", "n_events"}
    with pytest.raises(ValueError, match="no such variable: weight"):
        reports.stratified_tables(df, VariableList([Variable("weight")]), ["means"], LEVELS)
    with pytest.raises(ValueError, match="sex_final is string"):
        reports.stratified_tables(df, VariableList([Variable("sex_final")]), ["means"], LEVELS)


def test_tables_in_words(spark):
    df = spark.createDataFrame([(1, 3.0, 0), (0, None, 4), (1, 1.0, 0)], "f_a int, score double, n_visits int")
    assert rows(report.in_words(report.condition_table(df, ["f_a"], ["score"]))) == [("f_a", 3, "67%"), ("score", 2, "2.00 (1.41)")]
    assert rows(report.in_words(report.event_share(df, ["n_visits"]))) == [("n_visits", 3, "33%")]
    assert rows(report.in_words(report.activity_table(df, ["n_visits"]))) == [("n_visits", 3, "1.33 (2.31)")]
