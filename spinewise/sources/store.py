"""Stages of a study kept as tables that share one partitioning, with the counts that their writing gave."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from spinewise.sources.stages import new_path


class StageStore:
    """Tables of a study in one folder. Those with a key are bucketed by it, all into the same number of buckets.

    Joins and groupings of such tables by their keys need no exchange, whatever the keys are called. A stage is written once and read
    by all that follows, so a lost executor costs the running stage and no more. Each write also counts what it
    writes: rows, and what else is asked for, in the same pass (``checks``); ``counts`` shows them.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.folder = folder or new_path(spark, "stages")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._name = f"stages_{uuid.uuid4().hex[:12]}"
        self._measured: dict[str, dict[str, int | None]] = {}

    def _table(self, name: str) -> str:
        return f"{self._name}_{name}"

    def put(self, name: str, df: DataFrame, key: str | None = None, checks: Mapping[str, Column] | None = None) -> DataFrame:
        """The stage written, and read again. ``checks`` names aggregates over its rows; distinct counts are not among those Spark can observe."""
        if name in self._measured:
            raise ValueError(f"stage {name} is written already")
        unknown = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema if isinstance(f.dataType, NullType)}
        df = df.withColumns(unknown) if unknown else df
        seen = Observation(f"{self._name}_{name}")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (checks or {}).items()])
        if key:
            # One task a bucket, so a bucket is one file.
            writer = df.repartition(self.buckets, key).write.bucketBy(self.buckets, key).sortBy(key)
        else:
            writer = df.write
        writer.format("parquet").option("path", f"{self.folder}/{name}").saveAsTable(self._table(name))
        self._measured[name] = dict(seen.get)
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        return self.spark.table(self._table(name))

    def __contains__(self, name: str) -> bool:
        return name in self._measured

    def counts(self) -> DataFrame:
        """stage, measure, value: what the writes counted. No table is read for it."""
        rows = [(stage, measure, value) for stage, found in self._measured.items() for measure, value in found.items()]
        return self.spark.createDataFrame(rows, "stage string, measure string, value long")
