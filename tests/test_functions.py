"""Missing-value rules, dates, recodes and column-name selection on small literal frames."""

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spinewise.functions import dates, missing, names, recode


def one(spark, **values):
    row = ", ".join(f"{v} as {k}" for k, v in values.items())
    return spark.sql(f"select {row}")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


def test_if_else_is_null_for_an_unknown_test(spark):
    df = spark.sql("select * from values (1), (2), (null) t(x)")
    got = df.select("x", missing.if_else(F.col("x") == 1, F.lit("a"), F.lit("b")).alias("v"))
    assert {r.x: r.v for r in got.collect()} == {1: "a", 2: "b", None: None}


def test_membership_is_never_null(spark):
    df = spark.sql("select * from values (1), (2), (null) t(x)")
    got = df.select("x", missing.is_in("x", [1, 7]).alias("v")).collect()
    assert {r.x: r.v for r in got} == {1: True, 2: False, None: False}


@pytest.mark.parametrize("place", [0, 1, 2])
def test_strict_aggregates_are_null_with_one_missing_value_anywhere(spark, place):
    xs = [1, 0, 1]
    whole = spark.createDataFrame([(x,) for x in xs], "x int")
    xs[place] = None
    gap = spark.createDataFrame([(x,) for x in xs], "x int")
    aggs = [missing.sum_strict("x"), missing.max_strict("x"), missing.count_if_strict(F.col("x") == 1)]
    assert tuple(whole.agg(*aggs).collect()[0]) == (2, 1, 2)
    assert tuple(gap.agg(*aggs).collect()[0]) == (None, None, None)


def test_distinct_counts_a_missing_value_once(spark):
    df = spark.sql("select * from values (1, 'a'), (1, null), (1, null), (2, 'a'), (2, 'a') t(k, x)")
    got = df.groupBy("k").agg(missing.n_distinct("x").alias("n"), missing.count_known("x").alias("known"), missing.count_missing("x").alias("gone"))
    assert rows(got) == [(1, 2, 1, 2), (2, 1, 2, 0)]


def test_row_sum_and_flag(spark):
    df = spark.sql("select * from values (0, 0), (1, 2), (1, null) t(a, b)")
    got = df.select(missing.row_sum(["a", "b"]).alias("s"), missing.row_any(["a", "b"]).alias("f"))
    assert rows(got) == [(0, 0), (3, 1), (None, None)]


def test_known_in_all(spark):
    df = spark.sql("select * from values ('x', 'y'), ('Missing', 'y'), ('x', null) t(a, b)")
    assert [r[0] for r in df.select(missing.known_in_all(["a", "b"])).collect()] == [True, False, False]
    assert [r[0] for r in df.select(missing.known_in_all(["a", "b"], None)).collect()] == [True, True, False]


def test_value_to_null_and_blank_to_null(spark):
    df = spark.sql("select * from values ('ZZZZZ', ''), ('ED', 'a'), (null, null) t(a, b)")
    assert [r[0] for r in df.select(missing.value_to_null("a", "ZZZZZ")).collect()] == [None, "ED", None]
    assert [r.b for r in missing.blank_to_null(df).collect()] == [None, "a", None]


def test_rounding_is_half_to_even(spark):
    got = [value(spark, missing.round_even(F.lit(x).cast("double"))) for x in (0.5, 1.5, 2.5)]
    assert got == [0, 2, 2]


def test_null_safe_keys(spark):
    df = spark.sql("select cast(null as int) as a, cast(null as int) as b")
    assert df.select(missing.equal_keys(F.col("a"), F.col("b"), True)).collect()[0][0] is True
    assert df.select(missing.equal_keys(F.col("a"), F.col("b"))).collect()[0][0] is None


@pytest.mark.parametrize(
    "text,order,expected",
    [
        ("01/06/2023", "dmy", date(2023, 6, 1)),
        ("1-6-2023", "dmy", date(2023, 6, 1)),
        ("1.6.2023", "dmy", date(2023, 6, 1)),
        ("01062023", "dmy", date(2023, 6, 1)),
        ("1 Jun 2023", "dmy", date(2023, 6, 1)),
        ("31/02/2023", "dmy", None),
        ("", "dmy", None),
        ("2023-06-01", "ymd", date(2023, 6, 1)),
        ("2023/6/1", "ymd", date(2023, 6, 1)),
        ("20230601", "ymd", date(2023, 6, 1)),
        ("nothing", "ymd", None),
    ],
)
def test_parse_date(spark, text, order, expected):
    assert value(spark, dates.parse_date(F.lit(text), order)) == expected


def test_parse_timestamp(spark):
    texts = ["2023-06-01 18:00:00", "2023-06-01T18:00:00Z", "2023/6/1 18:00:00.25", "20230601180000"]
    for text in texts:
        got = value(spark, F.date_format(dates.parse_timestamp(F.lit(text)), "yyyy-MM-dd HH:mm:ss"))
        assert got == "2023-06-01 18:00:00", text
    assert value(spark, dates.parse_timestamp(F.lit("later"))) is None


def test_year_month(spark):
    assert value(spark, dates.parse_year_month(F.lit(193005))) == date(1930, 5, 1)
    assert value(spark, dates.parse_year_month(F.lit(None).cast("int"))) is None
    assert value(spark, dates.format_dmy(dates.parse_year_month(F.lit(193005)))) == "01/05/1930"


@pytest.mark.parametrize(
    "clock,by_hour,by_time",
    [
        ("07:59:59", True, True),
        ("08:00:00", False, False),
        ("17:59:59", False, False),
        ("18:00:00", True, False),
        ("18:00:01", True, True),
        ("9:05:00", False, False),
    ],
)
def test_the_two_out_of_hours_rules(spark, clock, by_hour, by_time):
    ts = F.concat(F.lit("2023-06-01 "), F.lpad(F.lit(clock), 8, "0")).cast("timestamp")
    assert value(spark, dates.out_of_hours_by_hour(ts)) is by_hour
    assert value(spark, dates.out_of_hours_by_time(dates.seconds_of_day(F.lit(clock)))) is by_time


@pytest.mark.parametrize("text", ["24:00:00", "12:60:00", "noon", ""])
def test_no_time_of_day(spark, text):
    assert value(spark, dates.seconds_of_day(F.lit(text))) is None


def test_lookback_has_both_ends(spark):
    df = spark.sql("select * from values (date'2023-06-01'), (date'2022-06-01'), (date'2022-05-31'), (date'2023-06-02'), (null) t(d)")
    flags = df.select("d", dates.within_lookback("d", F.lit("2023-06-01").cast("date")).alias("v")).collect()
    assert [r.v for r in flags] == [True, True, False, False, None]


def test_cap_date_and_days_apart(spark):
    df = spark.sql("select * from values (date'2023-10-31'), (date'2023-11-01'), (null) t(d)")
    assert [r[0] for r in df.select(dates.cap_date("d", "2023-11-01")).collect()] == [date(2023, 10, 31), None, None]
    assert [value(spark, dates.days_apart(F.lit(a).cast("date"), F.lit("2023-01-31").cast("date"))) for a in ("2023-01-01", "2023-03-03")] == [30, 31]


def test_ceil_day(spark):
    stamps = {"2023-06-01 00:00:00": date(2023, 6, 1), "2023-06-01 00:00:01": date(2023, 6, 2)}
    for text, expected in stamps.items():
        assert value(spark, dates.ceil_day(F.lit(text).cast("timestamp"))) == expected
    assert value(spark, dates.ceil_day(F.lit("2023-06-01").cast("date"))) == date(2023, 6, 1)


@pytest.mark.parametrize(
    "born,at,years",
    [
        ("1958-06-01", "2023-06-01", 65.0),
        ("1958-06-02", "2023-06-01", 64 + 364 / 365),
        ("1944-02-29", "2023-02-28", 79.0),
        ("1944-02-29", "2023-02-27", 78 + 364 / 365),
        ("1943-12-01", "2023-06-01", 79 + 182 / 365),
    ],
)
def test_age(spark, born, at, years):
    got = value(spark, dates.age_years(F.lit(born).cast("date"), F.lit(at).cast("date")))
    assert got == pytest.approx(years)


def test_age_groups(spark):
    got = [value(spark, recode.age_group(F.lit(a))) for a in (64, 65, 79, 80)]
    assert got == ["<65", "65-79", "65-79", ">=80"]
    assert value(spark, recode.age_group(F.lit(None).cast("int"))) is None


def test_recodes(spark):
    codes = spark.sql("select * from values (1), (3), (0), (9), (8), (null) t(x)")
    got = [r[0] for r in codes.select(recode.recode("x", recode.HOSPITAL_ETHNICITY, "Missing")).collect()]
    assert got == ["White", "Asian or Asian British", "Missing", "Missing", "Missing", "Missing"]
    fifths = [value(spark, recode.decile_to_fifth(F.lit(d))) for d in (1, 2, 3, 10, 0, 11)]
    assert fifths == ["Most deprived fifth", "Most deprived fifth", "Second most deprived fifth", "Least deprived fifth", None, None]


def test_bands(spark):
    beds = [value(spark, recode.bed_capacity(F.lit(b).cast("int"))) for b in (None, 24, 25, 49, 50)]
    assert beds == ["Missing", "0-24", "25-49", "25-49", "50+"]
    years = [value(spark, recode.years_registered(F.lit(y).cast("double"))) for y in (None, 10.0, 10.5)]
    assert years == ["Missing", "Less than 10 years", "More than 10 years"]


def test_priority_and_flags(spark):
    df = spark.sql("select * from values ('Missing', 'b'), ('a', 'b'), ('Missing', 'Missing'), (null, 'Missing') t(x, y)")
    assert [r[0] for r in df.select(recode.priority_coalesce(["x", "y"])).collect()] == ["b", "a", "Missing", "Missing"]
    flags = spark.sql("select * from values (1, null), (0, null), (null, null), (0, 0), (0, 1) t(a, b)")
    got = flags.select(recode.any_source_flag(["a", "b"]).alias("any"), recode.either_flag("a", "b").alias("either")).collect()
    assert [tuple(r) for r in got] == [(1, 1), (0, None), (None, None), (0, 0), (1, 1)]


def test_differs(spark):
    df = spark.sql("select * from values (date'2023-01-01', date'2023-01-31'), (date'2023-01-01', date'2023-02-01'), (date'2023-01-01', null) t(a, b)")
    assert [r[0] for r in df.select(recode.differs("a", "b", 30)).collect()] == ["Same", "Different", None]
    assert [r[0] for r in df.select(recode.differs("a", "b")).collect()] == ["Different", "Different", None]


def test_column_names(spark):
    df = one(spark, c_a="1", C_b="2", nc="'x'", x_sum="1.5D")
    assert names.with_prefix(df, "c_") == ["c_a", "C_b"]
    assert names.with_prefix(df, "c_", ignore_case=False) == ["c_a"]
    assert names.with_suffix(df, "_sum") == ["x_sum"]
    assert names.numeric(df) == ["c_a", "C_b", "x_sum"]
    assert names.without(df, ["nc"]) == ["c_a", "C_b", "x_sum"]
    assert names.present(df, ["zz", "nc"]) == ["nc"]
    assert names.add_suffix(df, "_w2", keep=["nc"]).columns == ["c_a_w2", "C_b_w2", "nc", "x_sum_w2"]
    assert names.lead_with(df, "nc").columns == ["nc", "c_a", "C_b", "x_sum"]


@pytest.mark.parametrize("text", ["29/02/2023", "29/02/2024", "00/01/2020", "01/13/2020", "01/01/0000", "01/01/0001", "01/02/2020\n", "1/2/2020"])
def test_usual_dates_are_parsed_as_by_their_layout(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    plain = df.select(dates.parse_date_as("t", "dd/MM/yyyy").cast("string").alias("v"), F.try_to_date("t", "dd/MM/yyyy").cast("string").alias("w")).collect()[0]
    assert plain["v"] == plain["w"]


def test_usual_timestamps_are_parsed_as_by_their_layout(spark):
    texts = ["2020-02-29 23:59:59", "2020-02-30 00:00:00", "2020-01-01 24:00:00", "2020-01-01 23:59:60", "2020-01-01 10:00:00\n", "2020-1-1 1:2:3"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", dates.parse_timestamp("t").cast("string").alias("v")).collect()
    assert {r.t: r.v for r in got} == dict.fromkeys(texts) | {texts[0]: texts[0], texts[5]: "2020-01-01 01:02:03"}
