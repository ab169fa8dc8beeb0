"""Where results between stages are kept."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Where stages are written: the folder that the cluster names in ``spark.checkpoint.dir``.

    With a master of one machine a temporary folder is made where none is named; elsewhere that is an error, as the
    executors would not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='stage-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: later work survives lost executors."""
    path = new_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
