"""Windowed measures, as-of records, linking, agreement and reports on small literal frames."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from spinewise.operators import agreement, asof, harmonise, link, report, windowed

INDEX, SECOND = date(2023, 3, 1), date(2023, 8, 1)


def spine(spark, people=("a", "b", "c")):
    return spark.createDataFrame(
        [(p, INDEX, SECOND, 1, 0 if p == "c" else 1) for p in people],
        "who string, index_wave1 date, index_wave2 date, w1 int, w2 int",
    )


def three_spans():
    both = (F.col("w1") == 1) & (F.col("w2") == 1)
    return [
        windowed.look_back("index_wave1"),
        windowed.fixed_period("2023-06-01", "2023-10-31"),
        windowed.between_anchors("index_wave1", "index_wave2", "_wave", both),
    ]


def events(spark, data):
    return spark.createDataFrame(data, "who string, day date, flag int, code string")


def test_boundary_days_of_every_window(spark):
    days = [
        INDEX, INDEX - timedelta(365), INDEX - timedelta(366), SECOND, SECOND + timedelta(1),
        date(2023, 5, 31), date(2023, 6, 1), date(2023, 10, 31), date(2023, 11, 1),
    ]
    df = events(spark, [("a", d, 1, "x") for d in days])
    got = windowed.window_features(df, spine(spark), "who", "day", three_spans(), [windowed.row_count("n")])
    assert rows(got) == [("a", 2, 4, 4)]


def test_windows_without_events_are_null_and_people_without_any_are_absent(spark):
    df = events(spark, [("a", INDEX, 1, "x"), ("b", date(2020, 1, 1), 1, "x"), (None, INDEX, 1, "x"), ("z", date(2023, 7, 1), 1, "x"), ("c", INDEX, 1, "x")])
    got = windowed.window_features(df, spine(spark), "who", "day", three_spans(), [windowed.row_count("n")])
    assert rows(got) == [("a", 1, None, 1), ("c", 1, None, None)]


def test_strict_measures_and_unknown_flags(spark):
    df = events(spark, [("a", INDEX, 1, "x"), ("a", INDEX, None, "x"), ("b", INDEX, 1, None), ("b", INDEX, 0, "y")])
    measures = [
        windowed.count_where("strict", F.col("flag") == 1, strict=True),
        windowed.count_where("loose", F.col("flag") == 1),
        windowed.any_where("ever", F.col("flag") == 1),
        windowed.total("sum", "flag"),
        windowed.total("sum_strict", "flag", strict=True),
        windowed.distinct_values("codes", "code"),
    ]
    got = windowed.window_features(df, spine(spark), "who", "day", three_spans()[:1], measures)
    assert rows(got.select("who", "strict", "loose", "ever", "sum", "sum_strict", "codes")) == [
        ("a", None, 1, None, 1, None, 1),
        ("b", 1, 1, 1, 1, 1, 2),
    ]


def test_keep_one_window(spark):
    df = events(spark, [("a", INDEX, 1, "x"), ("b", date(2023, 10, 1), 1, "x")])
    got = windowed.window_features(df, spine(spark), "who", "day", three_spans(), [windowed.row_count("n")], keep="")
    assert rows(got.select("who")) == [("a",)]


def brute(data, people, spans):
    out = {}
    for who in {d[0] for d in data}:
        mine = [d for d in data if d[0] == who]
        row = []
        for low, high, needs in spans:
            hit = [d for d in mine if low <= d[1] <= high and (not needs or who in people)]
            known = [d[2] for d in hit]
            strict = None if None in known else sum(known)
            row += [len(hit) or None, strict if hit else None, len({d[3] for d in hit}) or None]
        if any(v is not None for v in row[::3]):
            out[who] = tuple(row)
    return out


def test_one_person_with_a_third_of_all_rows_against_brute_force(spark):
    rng = random.Random(7)
    people = [f"p{i}" for i in range(40)]
    data = [
        ("p0" if i % 3 == 0 else rng.choice(people + ["stranger"]), date(2022, 1, 1) + timedelta(rng.randrange(700)), rng.choice([0, 1, 1, None if i % 50 == 0 else 0]), f"u{rng.randrange(900)}")
        for i in range(6000)
    ]
    anchors = spark.createDataFrame([(p, INDEX, SECOND) for p in people], "who string, index_wave1 date, index_wave2 date")
    spans = [windowed.look_back("index_wave1"), windowed.fixed_period("2023-06-01", "2023-10-31"), windowed.between_anchors("index_wave1", "index_wave2")]
    measures = [windowed.row_count("n"), windowed.count_where("hit", F.col("flag") == 1, strict=True), windowed.distinct_values("codes", "code")]
    expected = brute(data, people, [(INDEX - timedelta(365), INDEX, True), (date(2023, 6, 1), date(2023, 10, 31), False), (INDEX, SECOND, True)])
    for threshold, collapse in (("-1", True), ("10485760", True), ("10485760", False)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for outsiders in (True, False):
            got = windowed.window_features(events(spark, data), anchors, "who", "day", spans, measures, collapse=collapse, outsiders=outsiders)
            assert {r[0]: tuple(r)[1:] for r in got.collect()} == {k: v for k, v in expected.items() if outsiders or k in people}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def history(spark, data):
    return spark.createDataFrame(data, "who string, start timestamp, tie int, x string, y string, until string")


def records(spark):
    d = datetime
    return history(
        spark,
        [
            ("a", d(2023, 1, 1), 1, "old", "oldy", "u1"),
            ("a", d(2023, 2, 1), 2, None, "newy", None),
            ("a", d(2023, 3, 1, 0, 0, 1), 3, "late", "late", "u3"),
            ("b", d(2023, 3, 1), 5, "tie5", None, None),
            ("b", d(2023, 3, 1), 4, "tie4", None, "u4"),
            ("c", d(2023, 4, 1), 6, "after", "after", "u6"),
            ("a", None, 7, "undated", "undated", None),
            (None, d(2023, 1, 1), 8, "nobody", None, None),
        ],
    )


def test_asof_takes_the_latest_record_on_or_before_the_anchor(spark):
    got = asof.asof_record(records(spark), spine(spark), "who", "start", "index_wave1", ["x", "y", "until"], ["tie"])
    assert rows(got) == [("a", None, "newy", None), ("b", "tie4", None, "u4")]


def test_asof_ties_are_kept(spark):
    got = asof.asof_ties(records(spark), spine(spark), "who", "start", "index_wave1", ["x"])
    assert rows(got) == [("a", None), ("b", "tie4"), ("b", "tie5")]
    own = records(spark).withColumn("anchor", F.lit(INDEX))
    assert rows(asof.asof_ties(own, None, "who", "start", "anchor", ["x"])) == rows(got)


def test_asof_fills_gaps_but_not_the_exempt_column(spark):
    got = asof.asof_filled(records(spark), spine(spark), "who", "start", "index_wave1", ["x", "y", "until"], ["tie"], exempt=["until"])
    assert rows(got) == [("a", "old", "newy", None), ("b", "tie4", None, "u4")]
    own = records(spark).withColumn("anchor", F.lit(INDEX))
    same = asof.asof_filled(own, None, "who", "start", "anchor", ["x", "y", "until"], ["tie"], exempt=["until"])
    assert rows(same) == rows(got)


def test_latest_filled_takes_an_undated_row_as_newest(spark):
    got = asof.latest_filled(records(spark).where("who is not null"), "who", "start", ["x", "until"], ["tie"])
    assert rows(got) == [("a", "undated", "u3"), ("b", "tie5", "u4"), ("c", "after", "u6")]


def test_link_keeps_the_spine_and_renames_clashes(spark):
    people = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "who string, wave int")
    other = spark.createDataFrame([("a", 9, "x"), ("z", 8, "y"), (None, 7, "n")], "id string, wave int, note string")
    got = link.link_to_spine(people, {"notes": (other, "id")}, "who")
    assert got.columns == ["who", "wave", "wave_notes", "note"]
    assert rows(got) == [("a", 1, 9, "x"), ("b", 2, None, None), (None, 3, None, None)]
    safe = link.link_to_spine(people, {"notes": (other, "id")}, "who", null_safe=True)
    assert (None, 3, 7, "n") in rows(safe)


def test_link_fails_on_a_second_row_for_a_person(spark):
    people = spark.createDataFrame([("a",), ("b",)], "who string")
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "who string, n int")
    with pytest.raises(Exception, match="twice: more than one row for who a"):
        link.link_to_spine(people, {"twice": (twice, "who")}, "who").collect()
    assert link.link_to_spine(people, {"twice": (twice, "who")}, "who", check=[]).count() == 3


def test_assemble_is_a_full_join(spark):
    a = spark.createDataFrame([("a", 1), ("b", None)], "who string, x int")
    b = spark.createDataFrame([("b", "q"), ("c", "r")], "who string, y string")
    assert rows(link.assemble({"a": a, "b": b}, "who")) == [("a", 1, None), ("b", None, "q"), ("c", None, "r")]
    with pytest.raises(ValueError):
        link.assemble({"a": a, "b": a}, "who")
    with pytest.raises(Exception, match="more than one row"):
        link.assemble({"a": a.union(a), "b": b}, "who").collect()


def test_zero_fill_skips_absent_columns(spark):
    df = spark.createDataFrame([(None, None, None)], "n_a int, N_b int, other int")
    got = link.zero_fill(df, ["other", "not_there"], prefix="n_")
    assert rows(got) == [(0, None, 0)]


def test_waves_side_by_side(spark):
    people = spark.createDataFrame([("p1", "N", "n1", None), ("p2", "P", None, "AB"), ("p3", "N", "n3", None), ("p4", "N", None, None)], "who string, prov string, idn string, idp string")
    recs = spark.createDataFrame(
        [("n1", None, 1, 1, 10), ("n1", None, 1, 2, 11), (None, "ab", 2, 2, 20), ("n9", None, 1, 1, 99)],
        "client string, hashed string, provider int, wave int, score int",
    )
    got = link.waves_wide(
        people, recs,
        [
            link.Provider(F.col("prov") == "N", F.col("provider") == 1, "idn", "client", drop={1: ["provider", "hashed"], 2: ["provider", "hashed"]}),
            link.Provider(F.col("prov") == "P", F.col("provider") == 2, "idp", "hashed", F.upper("hashed"), {1: ["provider", "client"], 2: ["provider", "client"]}),
        ],
        wave="wave", lead=["prov", "who"],
    )
    assert got.columns == ["prov", "who", "idn", "idp", "score", "score_w2"]
    assert rows(got.select("who", "score", "score_w2")) == [("p1", 10, 11), ("p2", None, 20), ("p3", None, None), ("p4", None, None)]


def test_entity_link_keeps_people_of_a_hot_entity(spark):
    people = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), (F.col("id") % 7).cast("string"))).alias("home"))
    homes = spark.createDataFrame([("hot",), ("h1",), ("h9",)], "home string")
    beds = spark.createDataFrame([("hot", 30), ("h9", 5)], "home string, beds int")
    level, linked = link.entity_link(people, homes, {"beds": (beds, "home")}, "home")
    assert rows(level) == [("h1", None), ("h9", 5), ("hot", 30)]
    assert linked.count() == 300 and linked.where("beds = 30").count() == 100


def test_harmonise_and_age_band(spark):
    df = spark.createDataFrame([(1, "x", date(1958, 6, 1)), (7, None, None)], "code int, text string, born date")
    got = harmonise.harmonise(df, {"sex": ("code", {1: "Male"}), "kept": ("text", None)})
    assert rows(got.select("sex", "kept")) == [("Male", "x"), ("Missing", "Missing")]
    aged = harmonise.age_band(df.withColumn("at", F.lit(date(2023, 6, 1))), "born", "at", age="age")
    assert rows(aged.select("age", "age_cat")) == [(65, "65-79"), (None, None)]
    assert rows(harmonise.available(df, {"has": "born"}).select("has")) == [("Available",), ("Missing",)]


def sources(spark):
    return spark.createDataFrame(
        [("W", "W", "W"), ("W", "B", "W"), ("W", "Missing", "B"), ("Missing", "Missing", "Missing"), ("B", "B", "B")],
        "a string, b string, c string",
    )


NAMED = {"one": "a", "two": "b", "three": "c"}


def test_coverage_counts_and_shares_add_up(spark):
    got = agreement.source_coverage(sources(spark), NAMED, ["W", "B", "Missing"])
    table = {r.level: r for r in got.collect()}
    assert table["W"].n_one == 3 and table["B"].n_two == 2 and table["Missing"].n_three == 1
    assert table["Total"].n_one == 5 and sum(table[x].percent_one for x in ("W", "B", "Missing")) == pytest.approx(1)
    found = agreement.source_coverage(sources(spark), NAMED)
    assert rows(found) == rows(got)


def test_agreement(spark):
    table = {r.level: r for r in agreement.agreement_report(sources(spark), NAMED).collect()}
    assert (table["Same"].n_all, table["Different"].n_all, table["Total"].n_all) == (2, 1, 3)
    assert (table["Same"].n_one_two, table["Total"].n_one_two) == (2, 3)
    assert (table["Same"].n_one_three, table["Different"].n_one_three) == (3, 1)
    nothing = agreement.agreement_report(sources(spark).where("a = 'none'"), NAMED).collect()
    assert {r.percent_all for r in nothing} == {None}


def test_date_agreement_is_by_tolerance(spark):
    df = spark.createDataFrame([(date(2023, 1, 1), date(2023, 1, 31)), (date(2023, 1, 1), date(2023, 2, 1)), (date(2023, 1, 1), None)], "x date, y date")
    got = agreement.pairwise_agreement(df, {"x": "x", "y": "y"}, difference=agreement.within_days(30), missing=None)
    assert {(r.level, r.n) for r in got.collect()} == {("Same", 1), ("Different", 1), ("Total", 2)}


def test_crosstab_totals(spark):
    got = {r.a: tuple(r)[1:] for r in agreement.crosstab(sources(spark), "a", "b", ["W", "B", "Missing"]).collect()}
    assert got == {"W": (1, 1, 1, 0, 0, 3), "B": (0, 1, 0, 0, 0, 1), "Missing": (0, 0, 1, 0, 0, 1), "Total": (1, 2, 2, 0, 0, 5)}


def test_crosstab_columns_add_up_with_unlisted_and_unknown_levels(spark):
    df = spark.createDataFrame([("W", "x"), ("W", None), ("B", "odd"), (None, "x")], "a string, b string")
    for r in agreement.crosstab(df, "a", "b", ["x"]).collect():
        assert sum(r[1:-1]) == r[-1]


@pytest.mark.parametrize("levels", [["W"], ["W", "none"], ["W", "B", "Missing"]])
def test_coverage_adds_up_whatever_the_levels(spark, levels):
    df = sources(spark).union(spark.createDataFrame([(None, "odd", "W")], "a string, b string, c string"))
    got = [r for r in agreement.source_coverage(df, NAMED, levels).collect() if r.level != "Total"]
    for name in NAMED:
        assert sum(r[f"n_{name}"] for r in got) == 6
        assert sum(r[f"percent_{name}"] for r in got) == pytest.approx(1)


def test_every_coverage_preset_adds_up():
    """The label lists of the data model hold every label that its recodes make."""
    from spinewise.functions import recode

    assert set(recode.HOSPITAL_ETHNICITY.values()) | set(recode.COMMUNITY_ETHNICITY.values()) <= set(recode.ETHNICITY_LEVELS)
    assert set(recode.SEX.values()) <= set(recode.SEX_LEVELS)


def fails(df, message):
    with pytest.raises(Exception, match=message):
        df.collect()


@pytest.mark.parametrize("collapse", [None, True, False])
def test_a_second_spine_row_of_a_person_fails(spark, collapse):
    df = events(spark, [("a", INDEX, 1, "x"), ("a", INDEX, 0, "y")])
    twice = spine(spark, ("a", "a", "b"))
    with pytest.raises(Exception, match="spine: more than one row"):
        windowed.window_features(df, twice, "who", "day", three_spans(), [windowed.row_count("n")], collapse=collapse).collect()
    fails(link.link_to_spine(twice, {"e": (df.select("who", "flag").limit(1), "who")}, "who"), "spine: more than one row")


def test_assemble_leaves_out_rows_without_a_key(spark):
    one = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, x int")
    two = spark.createDataFrame([("b", 4), (None, 5)], "k string, y int")
    assert rows(link.assemble({"one": one, "two": two}, "k")) == [("a", 1, None), ("b", None, 4)]


@pytest.mark.parametrize("large", [False, True])
def test_a_missing_tiebreak_loses(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(asof, "fits", lambda *a: False)
    day = datetime(2023, 1, 1)
    df = history(spark, [("a", day, None, "untied", None, None), ("a", day, 7, "tied", None, None), ("b", day, None, "alone", None, None)])
    got = asof.asof_record(df, spine(spark), "who", "start", "index_wave1", ["x"], tiebreak=["tie"])
    assert rows(got) == [("a", "tied"), ("b", "alone")]


def test_several_distinct_measures_in_one_pass(spark):
    df = events(spark, [("a", INDEX, 1, "x"), ("a", INDEX, 1, "y"), ("a", INDEX, None, "y"), ("b", INDEX, 0, None)])
    measures = [windowed.distinct_values("codes", "code"), windowed.row_count("n"), windowed.distinct_values("flags", "flag"), windowed.total("sum", "flag")]
    for collapse in (True, False):
        got = windowed.window_features(df, spine(spark), "who", "day", three_spans()[:1], measures, collapse=collapse)
        assert rows(got) == [("a", 2, 3, 2, 2), ("b", 1, 1, 1, 0)]


def test_link_checks(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, None)], "k string, x int")
    got = agreement.link_checks(df, keys=["k"], known=["x"], low=F.col("x") < 5).collect()[0].asDict()
    assert got == {"rows": 3, "distinct_k": 3, "known_x": 1, "missing_x": 2, "low": 1}


@pytest.mark.parametrize("shape", ["even", "long tail", "few values", "one value"])
def test_quantiles_are_exact(spark, shape):
    rng = np.random.default_rng(3)
    values = {
        "even": rng.uniform(0, 1, 5000),
        "long tail": np.exp(rng.normal(0, 4, 5001)),
        "few values": rng.choice([1.0, 2.0, 7.0], 5002, p=[0.34, 0.33, 0.33]),
        "one value": np.full(17, 4.0),
    }[shape]
    df = spark.createDataFrame([(float(v), None) for v in values], "x double, y double")
    got = report.quantiles(df, ["x", "y"], (0.0, 0.25, 0.5, 0.9, 1.0)).collect()
    assert len(got) == 1 and got[0].known == len(values)
    assert list(got[0])[2:] == pytest.approx([np.quantile(values, p) for p in (0, 0.25, 0.5, 0.9, 1)])


def test_level_table_names_unknown_rows(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "v string")
    assert rows(report.level_table(df, ["v"])) == [("v", "Unknown", 1, None, None), ("v", "x", 2, 3, 2 / 3), ("v", "y", 1, 3, 1 / 3)]
    assert len(rows(report.level_table(df, ["v"], unknown=None))) == 2


def test_event_tables_take_unknown_as_none(spark):
    df = spark.createDataFrame([(0,), (2,), (None,), (4,)], "n_x int")
    assert rows(report.event_share(df, ["n_x"])) == [("n_x_binary", 4, 2, 0.5)]
    activity = report.activity_table(df, ["n_x"]).collect()[0]
    assert (activity.total_activity, activity.known, activity.mean) == (6, 4, 1.5)
    assert report.event_counts_by(df, ["n_x"], "n_x").where("label = 'Overall'").collect()[0].n_x is None


def test_stratified_table_has_the_missing_level_and_the_overall_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None)], "s string, x double")
    table = {(r.stratum, r.level): (r.known, r.mean) for r in report.stratified_table(df, {"x": "X"}, ["s"]).collect()}
    assert table == {("s", "a"): (2, 2.0), ("s", "(Missing)"): (1, 5.0), ("s", "b"): (0, None), ("Overall", "Overall"): (3, 3.0)}
    sizes = {(r.stratum, r.level): r.n for r in report.stratum_sizes(df, ["s"]).collect()}
    assert sizes == {("s", "a"): 2, ("s", "(Missing)"): 1, ("s", "b"): 1, ("Overall", "Overall"): 4}
    ordered = report.in_level_order(report.stratum_sizes(df, ["s"]), "level", ["b", "a"])
    assert {r.level: r.ord for r in ordered.collect()} == {"b": 1, "a": 2, "(Missing)": 3, "Overall": 3}


def test_score_table_leaves_out_values_above_a_bound(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (15000.0,), (None,)], "stay double")
    got = report.score_table(df, ["stay"], {"stay": 14000}).collect()[0]
    assert (got.known, got.mean) == (2, 2.0)


def test_texts(spark):
    df = spark.createDataFrame([(1.005, 2.0, 0.5), (None, None, 0.05), (3.0, None, 0.0005), (0.0, 0.0, 0.0)], "m double, s double, p double")
    got = df.select(report.mean_sd_text("m", "s"), report.percent_text("p")).collect()
    assert [r[0] for r in got][1:] == [None, "3.00 (NA)", "0.00 (0.00)"]
    assert [r[1] for r in got] == ["50%", "5.0%", "<0.1%", "0%"]
    assert df.select(report.strip_suffix(F.lit("n_x_colsum"), "_colsum")).first()[0] == "n_x"


def test_dictionary(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert rows(report.dictionary(df)) == [("a", "int"), ("b", "string")]


def test_assemble_sorts_nothing_before_its_exchange(spark):
    """A person's rows stand in different tables, so a combine before the exchange would find nothing to combine."""
    frames = {"one": spark.sql("select 1 as who, 'x' as a"), "two": spark.sql("select 1 as who, 2 as b")}
    made = link.assemble(frames, "who")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan[plan.rindex("Exchange hashpartitioning") :]
    assert rows(made) == [(1, "x", 2)]


def widest_aggregate(df):
    """The most columns that one aggregate of the plan has."""

    def walk(node):
        own = node.aggregateExpressions().size() if node.nodeName() == "Aggregate" else 0
        return max([own, *[walk(node.children().apply(i)) for i in range(node.children().size())]])

    return walk(df._jdf.queryExecution().optimizedPlan())


def many_counts(spark):
    names = [f"n_{i}" for i in range(2 * report.BLOCK + 3)]
    rows = [(i, *[None if (i + j) % 5 == 0 else i * j for j in range(len(names))]) for i in range(4)]
    return names, spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} int" for n in names))


def test_activity_of_many_counts_is_a_narrow_aggregate(spark):
    names, people = many_counts(spark)
    for df in (people, people.where("id < 0")):
        table, found = report.activity_table(df, names), df.collect()
        assert widest_aggregate(table) <= 4 * report.BLOCK + 3
        sums = [sum(r[n] or 0 for r in found) for n in names]
        expected = [(n, len(found), v, v / len(found)) if found else (n, 0, None, None) for n, v in zip(names, sums, strict=True)]
        assert [(r.variable, r.known, r.total_activity, r.mean) for r in table.collect()] == expected


def test_event_shares_of_many_counts_are_a_narrow_aggregate(spark):
    names, people = many_counts(spark)
    for df in (people, people.where("id < 0")):
        table, found = report.event_share(df, names), df.collect()
        assert widest_aggregate(table) <= 2 * report.BLOCK + 3
        happened = [sum((r[n] or 0) >= 1 for r in found) for n in names]
        expected = [(f"{n}_binary", len(found), k, k / len(found) if found else None) for n, k in zip(names, happened, strict=True)]
        assert [tuple(r) for r in table.collect()] == expected


def test_strata_of_many_outcomes_are_a_narrow_aggregate(spark):
    names, people = many_counts(spark)
    table = report.stratified_table(people, {n: n.upper() for n in names}, ["id"])
    assert widest_aggregate(table) <= 3 * report.BLOCK + 3
    found, expected = people.collect(), set()
    for level, some in [("Overall", found), *[(str(r.id), [r]) for r in found]]:
        for n in names:
            known = [r[n] for r in some if r[n] is not None]
            expected.add((n, n.upper(), level, len(known), sum(known) / len(known) if known else None))
    assert {(r.variable, r.label, r.level, r.known, r.mean) for r in table.collect()} == expected
    assert report.stratified_table(people.where("id < 0"), dict.fromkeys(names, "x"), ["id"]).collect() == []
