"""Every query against its check, and the shape of the plans."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import features, files, linkage, people, summaries
from catalog.check import compare

SMALL = "/root/testdata/sf0.001"
NAMES = [n for part in (features, linkage, summaries, people, files) for n in part.QUERIES]


@pytest.fixture(scope="module", autouse=True)
def given():
    pytest.importorskip("duckdb")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_check():
    assert set(NAMES) <= set(queries()) and set(NAMES) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_check(spark, name):
    n, difference = compare(spark, SMALL, queries()[name], oracle_sql()[name])
    assert difference is None
    assert n > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["person_id", "segment"] and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_plans_have_no_python_and_no_cross_join(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    assert not re.search("PythonUDF|EvalPython|InPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)


def exchanges_of(plan: str) -> list[list[str]]:
    found = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    return [re.sub(r"#\d+L?", "", e).split(", ")[:-1] for e in found]


def test_events_meet_the_spine_before_any_shuffle(spark):
    """One exchange of sums by person; events of other people and days in no window are gone by then."""
    plan = plan_of(queries()["lookback_features"](spark, SMALL))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "o_orderdate" in line)
    assert "o_totalprice" not in scan and "o_orderkey" not in scan
    assert "o_orderdate" in scan.split("DataFilters")[1] and "subquery" in plan.lower()
    assert "BroadcastHashJoin [person_id" in plan and "Inner" in plan
    assert exchanges_of(plan).count(["person_id"]) <= 2  # the events' sums, and the test of the spine


@pytest.mark.parametrize("name", ["wave_features", "asof_one", "asof_ties"])
def test_records_meet_the_spine_before_any_shuffle(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    join = plan.index("BroadcastHashJoin")
    events = [line for line in plan[join:].splitlines() if "Exchange hashpartitioning" in line]
    assert len(events) <= 1  # below the join, only the test of the spine


@pytest.mark.parametrize("name,table", [("distinct_services", "lineitem"), ("community_features", "lineitem"), ("emergency_features", "lineitem"), ("asof_ties", "orders"), ("waves_wide", "orders")])
def test_a_source_is_read_once(spark, name, table):
    plan = plan_of(queries()[name](spark, SMALL))
    assert len(re.findall(rf"FileScan.*{table}\.parquet", plan)) == 1


def test_a_large_spine_has_events_combined_before_every_shuffle(spark):
    from spinewise.operators.windowed import look_back, row_count, window_features
    from catalog.frames import frame

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        activity, spine = frame(spark, SMALL, "activity"), frame(spark, SMALL, "spine").select("person_id", "index_wave1")
        got = window_features(activity, spine, "person_id", "event_time", [look_back("index_wave1")], [row_count("n")], collapse=True)
        keys = exchanges_of(plan_of(got))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ["person_id", "_day"] in keys and ["person_id"] in keys


def test_reports_share_one_scan(spark):
    for name in ("agreement_report", "source_coverage", "pairwise_agreement"):
        plan = plan_of(queries()[name](spark, SMALL))
        assert plan.count("documents.parquet") == 1


def test_quantiles_rank_from_stored_counts(spark):
    """The source is read once, when its values are counted; what is ranked meets ranges that are broadcast."""
    plan = plan_of(queries()["quantiles"](spark, SMALL))
    assert "orders.parquet" not in plan and plan.count("FileScan parquet") == 1 and "value-counts" in plan
    assert "BroadcastHashJoin" in plan


def test_the_link_over_stored_stages_exchanges_no_source(spark):
    store = people.stored(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        linked = people.linked_from(store, people.frame(spark, SMALL, "areas"))
        keys = exchanges_of(plan_of(linked))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert keys and all(k in (["LSOA_PDS"], ["_key"], ["LSOA_IMD"]) for k in keys)
    plan = plan_of(queries()["report_scores"](spark, SMALL))
    assert "FileScan" in plan and not [e for e in exchanges_of(plan) if "pseudonhsno" in e]


@pytest.fixture
def small_partitions(spark):
    """Thresholds low enough that the skew of a small table counts as skew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def final_plan(df) -> str:
    """The plan after it ran, with what Spark changed on the way."""
    df._jdf.queryExecution().toRdd().count()
    return plan_of(df)


def test_a_hot_person_is_split_where_values_meet_the_spine(spark, small_partitions):
    from pyspark.sql import functions as F

    from spinewise.operators.windowed import distinct_values, look_back, window_features

    who = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
    events = spark.range(0, 60000, 1, 16).select(
        who.alias("who"), F.expr("date'2023-01-01' + cast(id % 30 as int)").alias("day"), F.col("id").alias("visit")
    )
    spine = spark.range(0, 500, 1, 4).select(F.col("id").alias("who"), F.lit("2023-02-01").cast("date").alias("index"))
    got = window_features(events, spine, "who", "day", [look_back("index")], [distinct_values("n", "visit")], collapse=True, unique_spine=True)
    assert "skew=true" in final_plan(got)
    counts = {r.who: r.n for r in got.collect()}
    assert counts[0] == 20000 + 80 and sum(counts.values()) == 60000


def test_a_hot_entity_is_split_where_people_meet_it(spark, small_partitions):
    from pyspark.sql import functions as F

    from spinewise.operators.link import entity_link

    people = spark.range(0, 60000, 1, 16).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200).alias("home"), F.sha2(F.col("id").cast("string"), 256).alias("note")
    )
    homes = spark.range(0, 200, 1, 2).select(F.col("id").alias("home"))
    beds = homes.withColumn("beds", F.col("home") % 60)
    _, linked = entity_link(people, homes, {"beds": (beds, "home")}, "home")
    assert "skew=true" in final_plan(linked)
    assert linked.count() == 60000


def test_a_hot_area_is_split_where_people_meet_the_lookup(spark, small_partitions):
    from pyspark.sql import functions as F

    from spinewise.operators.link import lookup

    people = spark.range(0, 60000, 1, 16).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200).alias("area"), F.sha2(F.col("id").cast("string"), 256).alias("note")
    )
    areas = spark.range(0, 200, 1, 2).select(F.col("id").alias("code"), (F.col("id") % 10).alias("value"))
    linked = lookup(people, areas, "area", "code", {"value": "decile"})
    assert "skew=true" in final_plan(linked)
    assert linked.where("decile is not null").count() == 60000
