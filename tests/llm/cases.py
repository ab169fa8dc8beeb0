"""Rows that every operator must take: nulls, empty and long texts, repeated rows, clashing columns, no rows at all."""

from pyspark.sql import functions as F

#: Names that operators use inside or return; as input columns they must do no harm.
CLASHING = ["n", "ids", "spans", "shard", "slot", "node", "key", "score", "w", "bucket", "place", "task", "rank", "block", "text_crc32", "start", "before", "v", "dim", "floor"]
LONG = " ".join(f"w{i % 977} of{i % 13}" for i in range(12_000))


def documents(spark, rows, extra=True):
    """Rows of (doc_id, text), with the other columns of the table and clashing ones."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if extra else df


ODD = [
    (1, "One plain text, of ten words or so, under the MIT License."),
    (1, "One plain text, of ten words or so, under the MIT License."),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (None, "a text that nothing names"),
    (None, None),
    (5, LONG),
    (6, "ß É 字 😀   é don't  two  blanks \n x"),
    (7, "password = hunter2hunter2 and token: abc"),
]


def odd_documents(spark):
    return documents(spark, ODD)


def no_documents(spark):
    return documents(spark, [])


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumn("label", F.lit(1)).withColumns({c: F.lit("x") for c in CLASHING})


def collected(df):
    return [tuple(r) for r in df.collect()]
