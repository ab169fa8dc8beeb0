"""Scans and sinks: delimited text, parquet, lookups, variable lists."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spinewise.functions.missing import blank_to_null
from spinewise.operators.report import dictionary
from spinewise.operators.varlist import MOST_VARIABLES, Variable, VariableList

# Fixed value: the name given to the row-name column of files written with one.
ROW_NAMES = "X"
# The columns of a variable list.
VARIABLE_COLUMNS = ["label", "variables", "filter1", "filter2", "filter3"]


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    return tuple(spark.read.option("header", True).csv(path).columns)


def _scan(spark: SparkSession, header: Sequence[str], paths: Sequence[str], bad_records: str | None) -> DataFrame:
    """Files of one layout as text columns, null nowhere but in the column of bad records."""
    fields = [StructField(c, StringType()) for c in header]
    reader = spark.read.option("header", True).option("nullValue", "\u0000")
    # A folder may hold files of several layouts; Spark then compares each header with the schema and fails.
    reader = reader.option("enforceSchema", any(re.fullmatch(r"_c\d+", c) for c in header))
    if bad_records:
        fields.append(StructField(bad_records, StringType()))
        # Whole records are parsed, as the number of fields of one is known by its end alone.
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_records).option("columnPruning", False)
    return reader.schema(StructType(fields)).csv(list(paths)).fillna("", subset=list(header))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    types: Mapping[str, str] | None = None,
    prefix_types: Mapping[str, str] | None = None,
    blank_as_null: bool = True,
    drop: Sequence[str] = (ROW_NAMES,),
    bad_records: str | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """CSV files with a header, columns matched and typed by name; a column not named stays text.

    The header of each path is read before the job runs; paths whose columns are in another order, or are more or
    fewer, are matched by name, a column that a path lacks being null. A path that is a folder is one layout: files in it
    with another header fail the job. ``types`` maps columns and ``prefix_types`` column-name prefixes to types.
    Values that do not fit become null. 'NA' is null; so is blank text unless ``blank_as_null`` is off.
    ``bad_records`` names a column for the whole text of records with too few or too many fields, null for the
    others, and ``file_column`` one for the name of a record's file; see ``count_bad_records``. Without ``bad_records`` only the columns used are parsed.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for p in [path] if isinstance(path, str) else path:
        layouts.setdefault(_header(spark, p), []).append(p)
    # Spark turns unquoted blanks to null but not quoted ones; make them one thing before choosing.
    parts = []
    for header, paths in layouts.items():
        df = _scan(spark, header, paths, bad_records)
        df = df.drop(*drop, *[c for c in header[:1] if c in ("", "_c0")])
        named = [c for c in df.columns if c != bad_records]
        df = df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("NA")) for c in named})
        df = blank_to_null(df) if blank_as_null else df
        parts.append(df.withColumn(file_column, F.element_at(F.split("_metadata.file_path", "/"), -1)) if file_column else df)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if bad_records:
        whole = whole.select(*[c for c in whole.columns if c != bad_records], bad_records)
    return typed(whole, types or {}, prefix_types or {})


def count_bad_records(df: DataFrame, bad_records: str, by: Sequence[str] = ()) -> DataFrame:
    """rows and bad, in all or by other columns, such as that of the file. The column is that of ``read_csv``."""
    # Spark parses records only where a column of theirs is asked for.
    field = next(F.col(f"`{c}`") for c in df.columns if c != bad_records and c not in by)
    return df.groupBy(*by).agg((F.count(field) + F.count_if(field.isNull())).alias("rows"), F.count(bad_records).alias("bad"))


def _casts(df: DataFrame, types: Mapping[str, str], prefix_types: Mapping[str, str] | None) -> dict[str, Column]:
    wanted = {}
    for c in df.columns:
        hit = types.get(c) or next((t for p, t in (prefix_types or {}).items() if c.startswith(p)), None)
        if hit and hit != "string":
            wanted[c] = F.col(f"`{c}`").try_cast(hit)
    return wanted


def typed(df: DataFrame, types: Mapping[str, str], prefix_types: Mapping[str, str] | None = None) -> DataFrame:
    """Cast columns by name or prefix; values that do not fit become null, see ``misfits``."""
    wanted = _casts(df, types, prefix_types)
    return df.withColumns(wanted) if wanted else df


def misfits(df: DataFrame, types: Mapping[str, str], prefix_types: Mapping[str, str] | None = None) -> DataFrame:
    """How many values of each column ``typed`` would lose: variable, known, misfits. One pass over the untyped table."""
    wanted = _casts(df, types, prefix_types)
    text = {c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in wanted}
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(text[c]).alias(f"k{i}") for i, c in enumerate(wanted)],
        *[F.count_if(text[c].isNotNull() & cast.isNull()).alias(f"m{i}") for i, (c, cast) in enumerate(wanted.items())],
    )
    entries = [F.struct(F.lit(c).alias("variable"), F.col(f"k{i}").alias("known"), F.col(f"m{i}").alias("misfits")) for i, c in enumerate(wanted)]
    none = "array<struct<variable:string,known:bigint,misfits:bigint>>"
    return counted.select(F.inline(F.array(*entries) if entries else F.array().cast(none)))


def read_frame(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table kept in Spark's own columnar format."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def read_lookup(spark: SparkSession, path: str, columns: Mapping[str, str], types: Mapping[str, str] | None = None) -> DataFrame:
    """A published lookup, ``columns`` mapping the names kept to the new ones."""
    df = read_csv(spark, path)
    return typed(df.select(*[F.col(f"`{c}`").alias(n) for c, n in columns.items()]), types or {})


def read_variables(spark: SparkSession, path: str) -> VariableList:
    """A variable list; the columns of the file are, by place, label, variables, filter1, filter2 and filter3.

    A list names report columns, so it comes to the driver; one of more than ``MOST_VARIABLES`` rows is no such list and fails.
    """
    df = read_csv(spark, path)
    named = df.toDF(*[*VARIABLE_COLUMNS, *df.columns[len(VARIABLE_COLUMNS) :]][: len(df.columns)])
    filters = [c for c in VARIABLE_COLUMNS[2:] if c in named.columns]
    listed = named.select("variables", "label", *filters).limit(MOST_VARIABLES + 1).collect()
    if len(listed) > MOST_VARIABLES:
        raise ValueError(f"{path}: more than {MOST_VARIABLES} variables")
    return VariableList([Variable(r["variables"], r["label"], {f: r[f] for f in filters if r[f] is not None}) for r in listed])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header and no row-name column, null written as 'NA'."""
    df.write.mode(mode).option("header", True).option("nullValue", "NA").csv(path)


def write_plain_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """As ``write_csv`` without any quoting: the values as they are, commas in them included."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")) for c in df.columns]
    line = F.concat_ws(",", *cells).alias(",".join(df.columns))
    # A whole line is one value; with a separator that is in none of them, nothing calls for quotes.
    writer = df.select(line).write.mode(mode).option("header", True).option("sep", "\u0001").option("quote", "").option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_frame(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_dictionary(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_csv(dictionary(df), path, mode)
