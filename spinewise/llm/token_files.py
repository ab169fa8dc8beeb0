"""Token files: raw ids in shards, and for each shard a minimal perfect hash from document keys to records.

A shard is two files. `shard-N.ids` is the ids of its documents, one after the other, two bytes each where
the vocabulary allows it, else four, little-endian. `shard-N.idx` is a line of JSON and then the arrays it
names. A key is looked up in constant time: the levels of a bit array are tried in turn; the bit found,
counted by a rank table, is the key's slot; the slot holds a fingerprint of the key, its first record and
how many records it has; a record is where the ids begin and how many there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import mix, new_path, per_process, running_offsets, slices, staged
from spinewise.llm.tokens import FileEncoder

#: Bits of a level for each key that reaches it; more bits, fewer levels.
SPREAD = 2.0
#: Bytes of text of a shard; a larger one has fewer distinct words to encode for each byte.
SHARD_BYTES = 48 << 20
#: Stands for a null key.
NULL_KEY = np.uint64(1 << 63)


def keys_of(doc_ids: pa.Array) -> np.ndarray:
    values = np.asarray(doc_ids.fill_null(0).cast(pa.int64()), np.int64).astype(np.uint64)
    values[np.asarray(doc_ids.is_null())] = NULL_KEY
    return values


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(keys ^ mix(np.array([level + 1], np.uint64))) % np.uint64(size)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys + np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Distinct keys to 0..n-1: a key alone at its place of a level stays there, the others go on to the next."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.first = np.concatenate([[0], np.cumsum([s // 64 for s in sizes])]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            size = 64 * max(1, -(-int(SPREAD * len(left)) // 64))
            place = _place(left, len(sizes), size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[place.astype(np.int64)]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, "<u8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; a key that was never added gets any slot or -1."""
        out, live = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            place = _place(keys[live], level, size)
            word = self.first[level] + (place >> np.uint64(6)).astype(np.int64)
            bit = place & np.uint64(63)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[live[hit]] = (self.rank[word] + np.bitwise_count(below))[hit]
            live = live[~hit]
        return out


class ShardIndex:
    def __init__(self, width: int, table: PerfectHash, arrays: dict[str, np.ndarray]):
        self.width, self.table, self.arrays = width, table, arrays

    @classmethod
    def of(cls, width: int, keys: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> ShardIndex:
        """keys: of each record, equal ones side by side; begins and counts: in ids."""
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        distinct, times = keys[heads], np.diff(np.append(heads, len(keys)))
        table = PerfectHash.of(distinct)
        order = np.argsort(table.slots(distinct))
        arrays = {
            "words": table.words.astype("<u8"),
            "prints": _fingerprint(distinct)[order].astype("<u4"),
            "heads": heads[order].astype("<u4"),
            "times": times[order].astype("<u4"),
            "begins": begins.astype("<u8"),
            "counts": counts.astype("<u8"),
        }
        return cls(width, table, arrays)

    def to_bytes(self) -> bytes:
        head = {"width": self.width, "sizes": self.table.sizes, "arrays": [[k, v.dtype.str, len(v)] for k, v in self.arrays.items()]}
        return json.dumps(head).encode() + b"\n" + b"".join(v.tobytes() for v in self.arrays.values())

    @classmethod
    def from_bytes(cls, raw: bytes) -> ShardIndex:
        line = raw.index(b"\n") + 1
        head, at, arrays = json.loads(raw[:line]), line, {}
        for name, kind, n in head["arrays"]:
            arrays[name] = np.frombuffer(raw, kind, n, at)
            at += n * np.dtype(kind).itemsize
        return cls(head["width"], PerfectHash(head["sizes"], arrays["words"]), arrays)

    def records(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which key, which record) for all records of the keys; keys whose fingerprint differs have none."""
        slot = self.table.slots(keys)
        known = np.flatnonzero(slot >= 0)
        known = known[self.arrays["prints"][slot[known]] == _fingerprint(keys[known])]
        times = self.arrays["times"][slot[known]].astype(np.int64)
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(known, times), np.repeat(self.arrays["heads"][slot[known]].astype(np.int64), times) + nth


# Names that Spark's file systems have for stores, and those of pyarrow.
SCHEMES = {"s3a://": "s3://", "s3n://": "s3://", "dbfs:/": "/dbfs/", "file:///": "/", "file:/": "/"}


def store_of(path: str):
    """The file system of a path and the path in it. Other stores than pyarrow knows must be mounted as folders on all machines."""
    from pyarrow.fs import FileSystem

    for name, own in SCHEMES.items():
        if path.startswith(name):
            return FileSystem.from_uri(own + path[len(name) :])
    return FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the files under `path`, shards in ascending key order; returns (shard, doc_id, n), read from a table.

    The key range of a shard is found by Spark; rows of one key that are too many for a shard are told apart
    by a hash of their text, and equal ones by their place. `path` may name any store that pyarrow has a file system for; the names that
    Spark has for some of them are understood too, see ``store_of``. A task writes under a name of its own and then renames, so a task that runs twice
    leaves one file. Null keys come first; null texts are the end id alone; an empty table has no file.
    Keys are longs; the smallest long stands for null and is no key of its own.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(-(-total // SHARD_BYTES), min(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # Equal rows are told apart by their place, so that a key with a third of all rows is many shards.
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("place")]
    rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = store_of(path)
        task = TaskContext.get()
        shard, own = task.partitionId(), f"{folder}/_part-{task.taskAttemptId()}"
        encoder, keys, counts, ids_file = per_process(("encoder", tokenizer), lambda: FileEncoder(tokenizer)), [], [], None
        last = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            if ids_file is None and batch.num_rows:
                store.create_dir(folder, recursive=True)
                ids_file = store.open_output_stream(f"{own}.ids")
            for part in slices(batch, 1, 4096, 6 << 20):
                ids = [b + last for b in encoder.encode(part.column(1))]
                ids_file.write(b"".join(ids))
                n = np.array([len(b) // encoder.dtype.itemsize for b in ids], np.int64)
                keys.append(keys_of(part.column(0)))
                counts.append(n)
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(n), pa.int32()), part.column(0), pa.array(n)], names=["shard", "doc_id", "n"])
        if ids_file is not None:
            ids_file.close()
            n = np.concatenate(counts)
            index = ShardIndex.of(encoder.dtype.itemsize, np.concatenate(keys), np.cumsum(n) - n, n)
            with store.open_output_stream(f"{own}.idx") as out:
                out.write(index.to_bytes())
            for kind in ("ids", "idx"):
                store.move(f"{own}.{kind}", f"{folder}/shard-{shard:06d}.{kind}")

    return staged(rows.mapInArrow(write, "shard int, doc_id long, n long"), "token-manifest")


def read_token_files(wanted: DataFrame, path: str) -> DataFrame:
    """Keyed access: (shard, doc_id) to (shard, doc_id, before, ids), `before` being the ids of the shard before it.

    Each wanted pair is looked up once, whatever its number of rows, and gives all records of its key there.
    """

    def read(table: pa.Table) -> pa.Table:
        shard = table.column(0)[0].as_py()
        store, folder = store_of(path)
        with store.open_input_file(f"{folder}/shard-{shard:06d}.idx") as f:
            index = ShardIndex.from_bytes(f.read())
        doc_ids = table.column(1).combine_chunks()
        which, record = index.records(keys_of(doc_ids))
        begins, counts = (index.arrays[k][record].astype(np.int64) for k in ("begins", "counts"))
        out = []
        with store.open_input_file(f"{folder}/shard-{shard:06d}.ids") as f:
            for b, n in zip(begins.tolist(), counts.tolist(), strict=True):
                f.seek(b * index.width)
                out.append(np.frombuffer(f.read(n * index.width), f"<u{index.width}").astype("<u4").tobytes())
        return pa.table([pa.array([shard] * len(out), pa.int32()), doc_ids.take(pa.array(which)), pa.array(begins), pa.array(out, pa.binary())], names=["shard", "doc_id", "before", "ids"])

    # So many partitions that the files are read by as many tasks, however small the list of keys is.
    tasks = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = wanted.select("shard", "doc_id").distinct().repartition(tasks, "shard")
    return distinct.groupBy("shard").applyInArrow(read, "shard int, doc_id long, before long, ids binary")


def token_file_digest(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    path = new_path(docs.sparkSession, "token-files")
    manifest = write_token_files(docs, path, tokenizer, end_id)
    totals = manifest.groupBy("shard").agg(F.sum("n").alias("total"))
    # One row for each shard.
    found = read_token_files(manifest, path).join(F.broadcast(running_offsets(totals, "shard", "total", "base")), "shard")
    return found.select(
        "doc_id",
        (F.col("base") + F.col("before")).alias("start"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
