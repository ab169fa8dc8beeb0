"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import re
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

T = TypeVar("T")
#: ASCII letters whose case is folded; other letters are left as they are.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; with a master of one machine (tests) a temporary one where none is named."""
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
    """The frame written to a table of the shared folder and read again: later work survives lost executors."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; plain lower() where the text is ASCII, which is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def running_offsets(frame: DataFrame, key: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Sum of `value` over all smaller keys (integers from 0), in two levels so that no task sees all keys."""
    blocks = frame.withColumn("_block", F.floor(F.col(key) / block))
    within = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inner = blocks.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    outer = blocks.groupBy("_block").agg(F.sum(value).alias("_total"))
    outer = outer.select("_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_outer"))
    joined = inner.join(outer, "_block")
    return joined.select(key, (F.col("_inner") + F.col("_outer")).cast("long").alias(out))


def per_process(key: tuple, make: Callable[[], T]) -> T:
    """What `make` gives, made once in a Python worker, which Spark uses for many tasks.

    Functions reach the worker by value, each time with globals of their own, so this is kept beside the modules.
    """
    held = sys.modules.setdefault("_spinewise_per_process", types.ModuleType("_spinewise_per_process")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def release() -> None:
    """Give back to the system what the allocators of a Python worker would keep from one task to the next."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def runs(classes: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of one non-zero class; a run never goes past a position in `breaks`."""
    edge = np.empty(len(classes) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(classes[1:], classes[:-1], out=edge[1:-1])
    edge[breaks] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    kept = classes[starts] != 0
    return starts[kept], ends[kept]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run: eight bytes a step, so that equal bytes give equal hashes."""
    length = ends - starts
    out = mix(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    mask = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], np.uint64)
    live, at = np.arange(len(starts)), 0
    while len(live):
        left = np.minimum(length[live] - at, 8)
        piece = np.ascontiguousarray(words[starts[live] + at]).view("<u8").ravel() & mask[left]
        out[live] = mix(out[live] * np.uint64(0x9E3779B97F4A7C15) + piece)
        at += 8
        live = live[length[live] > at]
    return out


def slices(batch: pa.RecordBatch, column: int, rows: int = 2048, nbytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of so many rows and bytes of one text or binary column at most; a longer value is a part alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + nbytes, side="right"))), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def joined_bytes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and where each begins (with the end of the last); null counts as empty."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    begins = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=begins[1:])
    return np.frombuffer(b"".join(raw), np.uint8), begins
