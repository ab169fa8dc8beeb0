"""Reading and writing files."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spinewise.operators.link import link_to_spine
from spinewise.sources import schemas, stages, tables
from spinewise.sources.store import StageStore


def write(path, text):
    path.write_text(text)
    return str(path)


CSV = '"","id","score","code","note"\n"1","a",5,"1048031000000100",""\n"2","b",NA,"NA",x\n"3",c,bad,,"q, z"\n'


def test_csv_blank_and_na_are_missing_and_types_go_by_name(spark, tmp_path):
    path = write(tmp_path / "a.csv", CSV)
    df = tables.read_csv(spark, path, {"score": "int"})
    assert df.columns == ["id", "score", "code", "note"]
    assert rows(df) == [("a", 5, "1048031000000100", None), ("b", None, None, "x"), ("c", None, None, "q, z")]


def test_csv_can_keep_blank_text(spark, tmp_path):
    path = write(tmp_path / "a.csv", CSV)
    df = tables.read_csv(spark, path, {"score": "int"}, blank_as_null=False)
    assert rows(df.select("id", "code", "note")) == [("a", "1048031000000100", ""), ("b", None, "x"), ("c", "", "q, z")]


def test_csv_row_names_column_x_is_dropped_and_prefixes_typed(spark, tmp_path):
    path = write(tmp_path / "a.csv", "X,id,Q3_a,Q3_b\n1,h,1.5,NA\n")
    df = tables.read_csv(spark, path, prefix_types=schemas.SURVEY_PREFIXES)
    assert df.dtypes == [("id", "string"), ("Q3_a", "double"), ("Q3_b", "double")]
    assert rows(df) == [("h", 1.5, None)]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", None, "q, z")], "id string, n int, t string")
    tables.write_csv(df, str(tmp_path / "out"))
    back = tables.read_csv(spark, str(tmp_path / "out"), {"n": "int"})
    assert back.columns == df.columns and rows(back) == rows(df)


def test_plain_csv_has_no_quotes(spark, tmp_path):
    df = spark.createDataFrame([('say "x"', 1)], "t string, n int")
    tables.write_plain_csv(df, str(tmp_path / "out"))
    assert set(rows(spark.read.text(str(tmp_path / "out")))) == {('say "x",1',), ("t,n",)}


def test_frames_keep_types(spark, tmp_path):
    df = spark.sql("select 'a' as id, date'2023-06-01' as d, cast(null as int) as n")
    tables.write_frame(df, str(tmp_path / "f"))
    assert tables.read_frame(spark, str(tmp_path / "f")).dtypes == df.dtypes
    assert tables.read_frame(spark, str(tmp_path / "f"), ["d"]).columns == ["d"]


def test_lookup_keeps_two_renamed_columns(spark, tmp_path):
    area, decile = schemas.AREA_LOOKUP_COLUMNS
    path = write(tmp_path / "l.csv", f'{area},Name,"{decile}"\nE01,x,3\nE02,y,NA\n')
    df = tables.read_lookup(spark, path, schemas.AREA_LOOKUP_COLUMNS, {"IMD_decile": "int"})
    assert df.dtypes == [("LSOA_IMD", "string"), ("IMD_decile", "int")]
    assert rows(df) == [("E01", 3), ("E02", None)]


def test_a_variable_list_is_checked_against_the_table(spark, tmp_path):
    path = write(tmp_path / "v.csv", "Label,Variables,Filter 1,Filter 2\nOne,n_a,1,x\n,n_b,,\nThree,n_z,,y\nText,who,1,\nAgain,n_a,1,\n")
    listed = tables.read_variables(spark, path)
    assert listed.outcomes() == {"n_a": "Again", "n_b": "n_b", "n_z": "Three", "who": "Text"}
    assert [v.name for v in listed.filled("filter1")] == ["n_a", "who", "n_a"]
    assert [v.name for v in listed.filled("filter2", "y")] == ["n_z"]
    df = spark.sql("select 'p' as who, 1 as n_a, 2 as n_b, 3 as other")
    assert listed.faults(df, numeric=True) == ["row 3: no such variable: n_z", "row 4: who is string, not a number", "row 5: n_a is listed twice"]
    with pytest.raises(ValueError, match="no such variable: n_z"):
        listed.checked(df)
    assert listed[:2].checked(df, numeric=True).outcomes() == {"n_a": "One", "n_b": "n_b"}


def test_a_variable_list_that_is_no_list_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_VARIABLES", 2)
    with pytest.raises(ValueError, match="more than 2"):
        tables.read_variables(spark, write(tmp_path / "v.csv", "label,variables\na,b\nc,d\ne,f\n"))


def test_files_are_matched_by_column_name(spark, tmp_path):
    one = write(tmp_path / "one.csv", "id,a,b\n1,2,x\n")
    other = write(tmp_path / "two.csv", "id,b,a\n2,y,3\n")
    more = write(tmp_path / "three.csv", '"","b","c","id"\n"1","z","7","3"\n')
    df = tables.read_csv(spark, [one, other, more], {"a": "int", "c": "int"})
    assert df.columns == ["id", "a", "b", "c"]
    assert rows(df) == [("1", 2, "x", None), ("2", 3, "y", None), ("3", None, "z", 7)]


def test_a_folder_of_several_layouts_fails_instead_of_misaligning(spark, tmp_path):
    write(tmp_path / "one.csv", "id,a,b\n1,2,x\n")
    write(tmp_path / "two.csv", "id,b,a\n2,y,3\n")
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        rows(tables.read_csv(spark, str(tmp_path)))


def test_bad_records_are_kept_and_counted(spark, tmp_path):
    one = write(tmp_path / "one.csv", "id,a\n1,2\n3\n4,5,6\n")
    other = write(tmp_path / "two.csv", "a,id\n7,8\n")
    df = tables.read_csv(spark, [one, other], {"a": "int"}, bad_records="_bad", file_column="file")
    assert rows(df.select("id", "a", "_bad")) == [("1", 2, None), ("3", None, "3"), ("4", 5, "4,5,6"), ("8", 7, None)]
    assert rows(tables.count_bad_records(df, "_bad", ["file"])) == [("one.csv", 3, 2), ("two.csv", 1, 0)]
    assert rows(tables.count_bad_records(df, "_bad")) == [(4, 2)]


def test_plain_csv_leaves_commas_and_blanks_alone(spark, tmp_path):
    df = spark.createDataFrame([(" a, b ", None), ('"q"', "")], "t string, u string")
    tables.write_plain_csv(df, str(tmp_path / "out"))
    assert set(rows(spark.read.text(str(tmp_path / "out")))) == {(" a, b ,NA",), ('"q",',), ("t,u",)}


def test_dictionary_sink(spark, tmp_path):
    tables.write_dictionary(spark.sql("select 1 as a, 'x' as b"), str(tmp_path / "d"))
    assert rows(tables.read_csv(spark, str(tmp_path / "d"))) == [("a", "int"), ("b", "string")]


def test_stages_share_their_partitioning_and_count_what_they_hold(spark, tmp_path):
    store = StageStore(spark, str(tmp_path / "stages"), buckets=3)
    people = spark.range(200).select(F.concat(F.lit("p"), "id").alias("who"), F.col("id").alias("n"), F.lit(None).alias("nothing"))
    visits = people.where("n % 2 = 0").select(F.col("who").alias("person"), (F.col("n") * 2).alias("m"))
    store.put("people", people, "who", {"known": F.count("n"), "large": F.count_if(F.col("n") > 150)})
    store.put("visits", visits, "person")
    store.put("loose", visits)
    assert "people" in store and "other" not in store
    assert rows(store.counts()) == [("loose", "rows", 100), ("people", "known", 200), ("people", "large", 49), ("people", "rows", 200), ("visits", "rows", 100)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        linked = link_to_spine(store.get("people"), {"visits": (store.get("visits"), "person")}, "who")
        plan = linked._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert linked.count() == 200 and linked.where("m is not null").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="written already"):
        store.put("people", people, "who")


def test_a_cluster_must_name_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return default

    class Cluster:
        conf, sparkContext = Conf(), type("C", (), {"master": "spark://somewhere:7077"})()

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        stages.shared_folder(Cluster())


def test_values_that_do_not_fit_are_counted(spark):
    df = spark.createDataFrame([("1", "x", "2023-01-01"), ("two", "x", "01/02/2023"), (None, "x", ""), ("3", "y", None)], "a string, b string, c string")
    got = {tuple(r) for r in tables.misfits(df, {"a": "int", "c": "date"}).collect()}
    assert got == {("a", 3, 1), ("c", 2, 1)}
    assert tables.misfits(df, {}).count() == 0
