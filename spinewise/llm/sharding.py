"""Shards by a two-pass external shuffle: scatter into memory-sized buckets, shuffle each, cut the sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import new_path, running_offsets, staged


def _swapped(items: Column, i: Column, j: Column) -> Column:
    """`items` with places j <= i (from 1) exchanged."""
    moved = F.concat(
        F.slice(items, F.lit(1), j - 1),
        F.slice(items, i, F.lit(1)),
        F.slice(items, j + 1, i - j - 1),
        F.slice(items, j, F.lit(1)),
        F.slice(items, i + 1, F.size(items) - i),
    )
    return F.when(i == j, items).otherwise(moved)


def permutation(size: Column, bucket: Column, seed: int) -> Column:
    """Fisher-Yates over 1..size: from the last place down, each is exchanged with a drawn one not after it.

    The draws are hashes of seed, bucket and place, so that a task that runs again makes the same order.
    """
    identity = F.sequence(F.lit(1), size)

    def step(items: Column, k: Column) -> Column:
        i = size + 2 - k
        draw = F.pmod(F.xxhash64(F.lit(seed), bucket, i), i.cast("long")).cast("int") + 1
        return _swapped(items, i, draw)

    return F.when(size < 2, identity).otherwise(F.aggregate(F.sequence(F.lit(2), size), identity, step))


def _spread_repeats(named: DataFrame, seed: int, most: int) -> DataFrame:
    """Rows (h, item), those of which more than `most` share h hashed anew with a number of their own.

    A repeated row is no other than its copies, so it is counted, and its copies are made again with numbers from 0 on:
    which of them has which number is nothing that a task that runs twice could change.
    """
    many = staged(named.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("h"), "repeats")
    if not many.limit(1).count():
        return named
    alike = named.join(many, "h", "left_semi").groupBy("h", "item").agg(F.count(F.lit(1)).cast("int").alias("n"))
    copies = alike.select("h", "item", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    return named.join(many, "h", "left_anti").union(copies.select(F.xxhash64(F.lit(seed), "h", "item", "copy").alias("h"), "item"))


def external_shuffle(
    docs: DataFrame,
    n_shards: int,
    seed: int = 2024,
    key: str = "doc_id",
    text: str = "text",
    bucket_rows: int = 512,
    bucket_bytes: int = 8 << 20,
) -> DataFrame:
    """The records in a seeded random order, cut into `n_shards` runs whose counts differ by one at most.

    Pass one scatters records into buckets by a seeded hash of key and text; the number of buckets follows
    rows and bytes, so that one fits in memory. Pass two orders each bucket by Fisher-Yates. A bucket's place
    in the whole is the sum of the sizes before it, hence `shard` (int) and `slot` (long, gapless from 0).

    Null keys and texts are hashed like values; equal rows are kept, each with a place of its own, and where they are more than
    a bucket holds they are spread over all buckets; an empty table gives an empty one. No bucket is longer than chance makes it, so
    ordering one is bounded work. Input columns named shard or slot are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    columns = docs.columns
    sizes = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    n, total = sizes["n"], sizes["b"] or 0
    buckets = max(1, -(-n // bucket_rows), -(-total // bucket_bytes))
    record = F.struct(*[F.col(f"`{c}`") for c in columns])
    named = docs.select(F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("h"), F.struct(F.col(key).alias("k"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("c"), record.alias("r")).alias("item"))
    scattered = _spread_repeats(named, seed, bucket_rows).select(F.pmod("h", F.lit(buckets)).alias("bucket"), "item")
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    offsets = running_offsets(counts, "bucket", "size", "before")
    tasks = min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    filled = scattered.repartitionByRange(tasks, "bucket").groupBy("bucket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    order = permutation(F.size("items"), F.col("bucket"), seed)
    drawn = filled.join(offsets, "bucket").withColumn("order", order)
    placed = drawn.select("before", F.posexplode(F.transform("order", lambda p: F.get("items", p - 1)["r"])).alias("pos", "r"))
    place = F.col("before") + F.col("pos")
    shard = F.expr(f"(before + pos) * {n_shards} div {max(n, 1)}")
    placed = placed.select("r", shard.cast("int").alias("shard"), place.alias("place"))
    first = F.expr(f"(shard * {n}L + {n_shards - 1}) div {n_shards}")
    return placed.select("r.*", "shard", (F.col("place") - first).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> DataFrame:
    """One folder of Parquet files for each shard; returns what was written, read again."""
    sharded.write.partitionBy("shard").parquet(path)
    return sharded.sparkSession.read.schema(sharded.schema).parquet(path)


def shard_digest(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """What each written shard holds: size and crc of each text, and its shard and slot."""
    whole = external_shuffle(docs.select("doc_id", "text"), n_shards)
    kept = write_shards(whole, new_path(docs.sparkSession, "shards"))
    body = F.coalesce(F.col("text"), F.lit(""))
    return kept.select(
        "doc_id",
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
