"""Concatenate and cut: documents end to end, global offsets by two-pass prefix sums, windows of fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import per_process, release, running_offsets, slices, staged
from spinewise.llm.tokens import FileEncoder


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """First pass, written to the shared folder: ids of each text with `end_id`, and the ids before it in its task."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before, task = per_process(("encoder", tokenizer), lambda: FileEncoder(tokenizer)), 0, TaskContext.get().partitionId()
        last = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            for part in slices(batch, 1, 2048, 3 << 20):
                ids = [b + last for b in encoder.encode(part.column(1))]
                counts = np.array([len(b) // encoder.dtype.itemsize for b in ids], np.int64)
                ends = before + np.cumsum(counts)
                columns = [part.column(0), pa.array([task] * len(ids), pa.int32()), pa.array(ends - counts), pa.array(counts), pa.array(ids, pa.binary())]
                before = int(ends[-1])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "task", "before", "n", "ids"])
            release()

    schema = "doc_id long, task int, before long, n long, ids binary"
    return staged(docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(encode, schema), "packed-ids")


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of documents in sequences of `length` ids: every sequence is full but the last.

    The first pass encodes each text, adds `end_id` and writes the ids. Sums over the tasks' totals then place
    every document in one global row of ids, which the second pass cuts at multiples of `length`. A document
    that crosses a cut has a piece on either side; `start` and `offset` are its boundary record. No text or
    id is shuffled. Padding is less than one sequence for the whole corpus.

    Per piece: doc_id, start, length, doc_tokens, sequence_id, offset, and ids (binary, unsigned 32-bit little-endian).
    Null and empty texts are the end id alone; repeated rows and null doc_ids are packed like others; an
    empty table gives no piece; other columns of the input are left out.
    """
    first = tokenised(docs, tokenizer, end_id, key, text)
    totals = first.groupBy("task").agg(F.sum("n").alias("total"))
    # One row for each task of the first pass, a few bytes each, so its size is bounded by the number of input splits.
    placed = first.join(F.broadcast(running_offsets(totals, "task", "total", "base")), "task")
    placed = placed.select("doc_id", (F.col("base") + F.col("before")).alias("at"), "n", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3):
                at, n = (np.asarray(part.column(c), np.int64) for c in (1, 2))
                windows = (at + n - 1) // length - at // length + 1
                doc = np.repeat(np.arange(len(n)), windows)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
                sequence = at[doc] // length + nth
                begin = np.maximum(sequence * length, at[doc])
                end = np.minimum((sequence + 1) * length, at[doc] + n[doc])
                raw = [b.as_py() for b in part.column(3)]
                ids = [np.frombuffer(b, f"<u{len(b) // int(k)}").astype("<u4") for b, k in zip(raw, n, strict=True)]
                pieces = [ids[d][s:e].tobytes() for d, s, e in zip(doc, begin - at[doc], end - at[doc], strict=True)]
                numbers = [begin - at[doc], end - begin, n[doc], sequence, begin - sequence * length]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), *map(pa.array, numbers), pa.array(pieces, pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return placed.mapInArrow(cut, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: ids of all pieces of one, in order, and how many."""
    grouped = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("length"))
    joined = F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return grouped.select("sequence_id", "length", joined.alias("ids"))


def piece_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
