"""Conversation prefix trie: fingerprints of prefixes as products of a monoid, never the prefixes themselves.

A sequence of turns is the element (n, v): its length and the sum of s_i * B^i, s_i being the turn's symbol. Two
sequences one after the other are (n + m, v + B^n * w), and what follows the first n turns of a known sequence is
found by taking them away again. So:

1. Turns get a name of 128 bits from role and text, their reference into the stored turns. A name must stand for
   one role and text only, which is tested on the stored turns.
2. Turns are dealt out by ranges of (conversation, turn), and every task makes the running products of its stretch of each
   conversation. The few conversations that go on over several tasks get the product before each stretch from
   the totals of the stretches: a conversation with a third of all turns is many stretches.
3. A rebuilt conversation is a head of another and its own suffix. Its running products come from the products of
   the two, by arithmetic; no turn is copied.
4. Rows with the same depth and product are a node. All of a node must refer to one last turn: equal
   products and equal last turns give equal products before, so by induction the whole prefixes are equal. If this
   test or that of the names fails, all is done again with another base and other names.
5. What is summed over subtrees is summed over conversations instead: every node belongs to its smallest member,
   the nodes that a conversation owns are the end of its path, and running sums along the path give what
   each of its nodes is to count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import mix, release, staged

#: The modulus of the products, a Mersenne prime.
PRIME = np.uint64((1 << 61) - 1)
#: Bytes of joined ids that are sent on at a time.
PIECE = 1 << 20

_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_WORD = r"[^\x20\x09-\x0D]+"


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, of values below it; halves of 31 and 30 bits keep every step in 64 bits."""
    a, b = np.asarray(a, np.uint64), np.asarray(b, np.uint64)
    ah, al, bh, bl = a >> np.uint64(31), a & _LOW31, b >> np.uint64(31), b & _LOW31
    middle = ah * bl + al * bh
    return _reduced(_reduced(np.uint64(2) * ah * bh + (middle >> np.uint64(30))) + _reduced((middle & _LOW30) << np.uint64(31)) + _reduced(al * bl))


def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _reduced(np.asarray(a, np.uint64) + np.asarray(b, np.uint64))


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _reduced(np.asarray(a, np.uint64) + (PRIME - np.asarray(b, np.uint64)))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^n."""
    out = np.ones(n + 1, np.uint64)
    have = 1
    while have <= n:
        step = np.uint64(pow(base, have, int(PRIME)))
        out[have : 2 * have] = times(out[: min(have, n + 1 - have)], step)
        have *= 2
    return out


def bases(seed: int) -> tuple[int, int]:
    """Two bases of the products, and of their symbols, by the seed."""
    drawn = mix(np.array([2 * seed + 1, 2 * seed + 2], np.uint64)) % (PRIME - np.uint64(1000)) + np.uint64(500)
    return int(drawn[0]), int(drawn[1])


def symbols(name: np.ndarray) -> np.ndarray:
    return name.view(np.uint64) % (PRIME - np.uint64(1)) + np.uint64(1)


def after(base: int, n: int, v: int, w: np.ndarray) -> np.ndarray:
    """The product of a sequence (n, v) and then one of product w."""
    return plus(np.uint64(v), times(w, np.uint64(pow(base, n, int(PRIME)))))


def running(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums modulo PRIME from the last head to each place, inclusive."""
    high, low = np.cumsum(values >> np.uint64(31), dtype=np.uint64), np.cumsum(values & _LOW31, dtype=np.uint64)
    first = np.maximum.accumulate(np.where(heads, np.arange(len(values)), 0))
    high -= high[first] - (values[first] >> np.uint64(31))
    low -= low[first] - (values[first] & _LOW31)
    return plus(times(high % PRIME, np.uint64(1 << 31)), low % PRIME)


def _named(conversations: DataFrame, key: str, turn: str, role: str, text: str, seed: int) -> DataFrame:
    """(conv_id, turn, d1, d2, words) of all turns; d1 and d2 are the name of role and text."""
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    return conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(F.lit(2 * seed), who, said).alias("d1"),
        F.xxhash64(F.lit(2 * seed + 1), said, who).alias("d2"),
        F.regexp_count(said, F.lit(_WORD)).cast("long").alias("words"),
    )


def names_are_unique(conversations: DataFrame, role: str, text: str, seed: int) -> bool:
    """Whether each name stands for one role and text, by comparing the stored turns that have it."""
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    whole = F.struct(who.alias("role"), said.alias("text"))
    named = conversations.select(F.xxhash64(F.lit(2 * seed), who, said).alias("d1"), F.xxhash64(F.lit(2 * seed + 1), said, who).alias("d2"), whole.alias("whole"))
    kinds = named.groupBy("d1", "d2").agg(F.min("whole").alias("low"), F.max("whole").alias("high"))
    return not kinds.where("low <> high").limit(1).count()


_SCAN = "conv_id long, task int, total boolean, at long, w long, v1 long, v2 long, words long, d1 long, d2 long"


def scanned(turns: DataFrame, seed: int) -> DataFrame:
    """Running products of each task's stretches, and (total) the product of its first and of its last stretch."""
    base = bases(seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        first = None  # the conversation the task begins with, and its product once it has ended
        conv, n, w, v = None, 0, 0, (0, 0)  # the stretch that is open
        names = [c.split()[0] for c in _SCAN.split(", ")]

        def rows(total: bool, *columns) -> pa.RecordBatch:
            size = len(columns[0])
            kinds = [pa.int64(), None, None] + [pa.int64()] * 7
            whole = [columns[0], pa.array([task] * size, pa.int32()), pa.array([total] * size), *columns[1:]]
            return pa.RecordBatch.from_arrays([x if k is None else pa.array(np.asarray(x).astype(np.int64), k) for x, k in zip(whole, kinds, strict=True)], names=names)

        def summary() -> pa.RecordBatch:
            return rows(True, [conv], [n], [w], [v[0]], [v[1]], [0], [0], [0])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, d1, d2, words = (np.asarray(batch.column(c), np.int64) for c in (0, 2, 3, 4))
            heads = np.ones(len(ids), bool)
            heads[1:] = ids[1:] != ids[:-1]
            place = np.arange(len(ids))
            begin = np.maximum.accumulate(np.where(heads, place, 0))
            local = place - begin
            sums = np.cumsum(words)
            sums = sums - sums[begin] + words[begin]
            parts = [running(times(symbols(d), powers(b, int(local.max()))[local]), heads) for d, b in zip((d1, d2), base, strict=True)]
            at = local + 1
            if ids[0] == conv:  # the open stretch goes on
                more = begin == 0
                at = at + np.where(more, n, 0)
                sums = sums + np.where(more, w, 0)
                parts = [np.where(more, after(b, n, old, p), p) for b, old, p in zip(base, v, parts, strict=True)]
            elif conv is not None and first == conv:
                yield summary()
            if first is None:
                first = int(ids[0])
            changes = np.flatnonzero(heads[1:])
            if first == ids[0] and len(changes):  # the first stretch ends in this batch
                end = int(changes[0])
                conv, n, w, v = first, int(at[end]), int(sums[end]), (int(parts[0][end]), int(parts[1][end]))
                yield summary()
            conv, n, w, v = int(ids[-1]), int(at[-1]), int(sums[-1]), (int(parts[0][-1]), int(parts[1][-1]))
            yield rows(False, ids, at, sums, parts[0], parts[1], words, d1, d2)
        if conv is not None:
            yield summary()
        release()

    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("d1"), F.col("d2")]
    return turns.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(run, _SCAN)


def own_products(turns: DataFrame, seed: int) -> DataFrame:
    """(conv_id, at, w, v1, v2, words, d1, d2): the product of the first `at` turns of each conversation, and their words."""
    base = bases(seed)
    found = staged(scanned(turns, seed), "stretches")
    before: dict[int, tuple[int, int, int, int, int]] = {}
    open_: tuple[int, int, int, int, int] | None = None
    # Two rows for each task at most.
    for r in found.where("total").select("task", "conv_id", "at", "w", "v1", "v2").distinct().orderBy("task", "conv_id").collect():
        if open_ is not None and open_[0] == r["conv_id"]:
            _, n, w, v1, v2 = open_
            if r["task"] not in before:
                before[r["task"]] = open_
            both = [int(after(b, n, old, np.array([new], np.uint64))[0]) for b, old, new in zip(base, (v1, v2), (r["v1"], r["v2"]), strict=True)]
            open_ = (r["conv_id"], n + r["at"], w + r["w"], *both)
        else:
            open_ = (r["conv_id"], r["at"], r["w"], r["v1"], r["v2"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, w, v1, v2 = (np.asarray(batch.column(c), np.int64) for c in (0, 2, 3, 4, 5))
            task = np.asarray(batch.column(1), np.int64)
            at, w, v = at.copy(), w.copy(), [v1.view(np.uint64).copy(), v2.view(np.uint64).copy()]
            for t in np.unique(task).tolist():
                if t in before:
                    conv, n, old_w, *old = before[t]
                    some = np.flatnonzero((task == t) & (ids == conv))
                    at[some] += n
                    w[some] += old_w
                    for k in range(2):
                        v[k][some] = after(base[k], n, old[k], v[k][some])
            columns = [batch.column(0), pa.array(at), pa.array(w), *(pa.array(x.view(np.int64)) for x in v), *batch.columns[6:]]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "at", "w", "v1", "v2", "words", "d1", "d2"])
        release()

    rows = found.where("not total").select("conv_id", "task", "at", "w", "v1", "v2", "words", "d1", "d2")
    return staged(rows.mapInArrow(place, "conv_id long, at long, w long, v1 long, v2 long, words long, d1 long, d2 long"), "own-products")


def _at(values: list[Column], n: Column) -> Column:
    """The n-th of the values (from 1), 0 for n = 0."""
    out = F.lit(0).cast("long")
    for k, value in enumerate(values, 1):
        out = F.when(n == k, value).otherwise(out)
    return out


def rebuilt(own: DataFrame, group: int, heads: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (conv_id, turns), and their running products (conv_id, depth, last, w, f1, f2, words, d1, d2)."""
    base = bases(seed)
    fields = ["w", "v1", "v2", "words", "d1", "d2"]
    first = [F.max(F.when(F.col("at") == k, F.col(c))).alias(f"{c}_{k}") for k in range(1, heads) for c in fields]
    convs = staged(own.groupBy("conv_id").agg(F.max("at").alias("size"), *first), "conversations")
    theirs = convs.where(F.col("conv_id") % group == 0).select(*[F.col(c).alias(f"b_{c}") for c in convs.columns])
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    joined = convs.join(theirs, convs.conv_id - convs.conv_id % group == theirs.b_conv_id, "left").withColumn("h", h)
    joined = joined.withColumn("g", F.least("h", F.coalesce("b_size", F.lit(0))))
    joined = joined.withColumn("turns", F.col("g") + F.greatest(F.lit(0), F.col("size") - F.col("h")))
    for c in ("w", "v1", "v2"):
        joined = joined.withColumn(f"o_{c}", _at([F.col(f"{c}_{k}") for k in range(1, heads)], F.col("h")))
        joined = joined.withColumn(f"g_{c}", _at([F.col(f"b_{c}_{k}") for k in range(1, heads)], F.col("g")))
    info = staged(joined, "rebuilt-conversations")

    taken = F.array(*[F.struct(F.lit(k).cast("long").alias("depth"), *[F.col(f"b_{c}_{k}").alias(c) for c in fields]) for k in range(1, heads)])
    head = info.withColumn("x", F.explode(F.filter(taken, lambda x: x["depth"] <= F.col("g"))))
    head = head.select("conv_id", "x.depth", (F.col("x.depth") == F.col("turns")).alias("last"), "x.w", F.col("x.v1").alias("f1"), F.col("x.v2").alias("f2"), "x.words", "x.d1", "x.d2")

    # Dealt by another value than the join's key, so that Spark may split a hot conversation.
    narrow = info.select("conv_id", "h", "g", "turns", "o_w", "o_v1", "o_v2", "g_w", "g_v1", "g_v2").repartition(F.xxhash64("conv_id"))
    suffix = own.join(narrow, "conv_id").where(F.col("at") > F.col("h"))
    suffix = suffix.withColumn("depth", F.col("at") - F.col("h") + F.col("g")).withColumn("last", F.col("depth") == F.col("turns"))
    suffix = suffix.withColumn("w", F.col("w") - F.col("o_w") + F.col("g_w"))
    columns = ["conv_id", "depth", "last", "w", "words", "d1", "d2", "h", "g", "v1", "v2", "o_v1", "o_v2", "g_v1", "g_v2"]

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = [np.array([[pow(b, g - h, int(PRIME)) for g in range(heads)] for h in range(heads)], np.uint64) for b in base]
        for batch in batches:
            at = {c: i for i, c in enumerate(columns)}
            value = lambda c: np.asarray(batch.column(at[c]), np.int64).view(np.uint64)  # noqa: E731, B023
            h, g = value("h").astype(np.int64), value("g").astype(np.int64)
            out = [plus(value(f"g_v{k}"), times(minus(value(f"v{k}"), value(f"o_v{k}")), shift[k - 1][h, g])) for k in (1, 2)]
            whole = [*batch.columns[:4], *(pa.array(x.view(np.int64)) for x in out), *batch.columns[4:7]]
            yield pa.RecordBatch.from_arrays(whole, names=["conv_id", "depth", "last", "w", "f1", "f2", "words", "d1", "d2"])
        release()

    schema = "conv_id long, depth long, last boolean, w long, f1 long, f2 long, words long, d1 long, d2 long"
    rows = suffix.select(*columns).mapInArrow(shifted, schema)
    return info.select("conv_id", "turns"), staged(head.union(rows), "rebuilt-rows")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of rows (conv_id, depth, member): the members in order, comma-joined, hashed.

    Members are dealt out by ranges, so that those of one node may be in many tasks; each sends on its part as
    text, and what a node has in several parts is hashed from the parts in their order, one after the other.
    """
    names = ["conv_id", "depth", "sha", "task", "nth", "part"]

    def one(conv, depth, sha, nth, part) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
        values = [conv, depth, sha, [TaskContext.get().partitionId()] * len(conv), nth, part]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, text, nth, first = None, [], 0, True
        size = 0
        for batch in batches:
            ids, depths, members = (np.asarray(c, np.int64) for c in batch.columns)
            cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (depths[1:] != depths[:-1])) + 1 if len(ids) else []
            done: list[tuple[int, int, str]] = []
            for lo, hi in zip([0, *cuts], [*cuts, len(ids)], strict=True) if len(ids) else ():
                here = (int(ids[lo]), int(depths[lo]))
                if here != node:
                    if node is not None and (first or nth):
                        if text:
                            yield one([node[0]], [node[1]], [None], [nth], [b",".join(text)])
                    elif node is not None:
                        done.append((*node, hashlib.sha256(b",".join(text)).hexdigest()))
                    first, node, text, nth, size = node is None, here, [], 0, 0
                text.append(",".join(map(str, members[lo:hi].tolist())).encode())
                size += len(text[-1])
                if size > PIECE:
                    yield one([node[0]], [node[1]], [None], [nth], [b",".join(text)])
                    text, nth, size = [], nth + 1, 0
            yield one([d[0] for d in done], [d[1] for d in done], [d[2] for d in done], [0] * len(done), [None] * len(done))
        if node is not None and text:
            yield one([node[0]], [node[1]], [None], [nth], [b",".join(text)])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done = []
            for conv, depth, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv, depth) != node:
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (conv, depth), hashlib.sha256(part)
                else:
                    sha.update(b"," + part)
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=names[:3])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], names=names[:3])

    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "depth", "member"]
    sent = ends.select(*order).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    sent = staged(sent.mapInArrow(join, "conv_id long, depth long, sha string, task int, nth int, part binary"), "ends")
    parts = sent.where("part is not null").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "task", "nth")
    parts = parts.select("conv_id", "depth", "part").mapInArrow(hashed, "conv_id long, depth long, sha string")
    return sent.where("part is null").select("conv_id", "depth", "sha").union(parts).withColumnRenamed("sha", "ends_sha256")


def prefix_trie(
    conversations: DataFrame,
    group: int = 20,
    heads: int = 4,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    seed: int = 1,
) -> DataFrame:
    """The nodes of the trie over all rebuilt conversations, one row each.

    Conversation c is rebuilt from the first h turns of conversation c - c % group and its own turns after the
    first h, h being crc32 of c in decimal modulo `heads`. A node is a distinct sequence of first turns (role and text);
    its members are the rebuilt conversations that begin with it. Columns: conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless nodes of the subtree, itself
    included), saved_tokens (over the subtree, members less one times the words of the last turn) and ends_sha256 (of
    the ids, comma-joined in order, of members that end here).

    Turns are ordered by `turn`, null first, turns of equal number by the hash of role and text; repeated rows are
    further turns. Null roles and texts are empty ones. Rows with a null conversation are left out. An empty
    table gives an empty result; other columns are left out, whatever their names.
    """
    if heads < 2:
        raise ValueError("heads must be 2 at least")
    while True:
        turns = _named(conversations, key, turn, role, text, seed)
        convs, rows = rebuilt(own_products(turns, seed), group, heads, seed)
        at = ["depth", "f1", "f2"]
        found = rows.groupBy(*at).agg(
            F.min("conv_id").alias("node"),
            F.count(F.lit(1)).alias("n_convs"),
            F.count(F.when(F.col("last"), 1)).alias("n_ends"),
            *[f(d).alias(f"{f.__name__}_{d}") for f in (F.min, F.max) for d in ("d1", "d2")],
        )
        nodes = staged(found, "nodes")
        apart = nodes.where("min_d1 <> max_d1 or min_d2 <> max_d2").limit(1).count()
        if not apart and names_are_unique(conversations, role, text, seed):
            break
        seed += 1
    whole = convs.agg(F.min("conv_id"), F.count(F.lit(1)), F.count(F.when(F.col("turns") == 0, 1)), F.count(F.when(F.col("turns") > 0, 1))).first()
    top, n_convs, n_ends, n_longer = whole
    kept = nodes.select(*at, "node", "n_convs", (F.col("n_ends") == F.col("n_convs")).alias("childless"))
    # Both sides of the join come straight from a shuffle, so that Spark may split a hot node.
    labelled = rows.select("conv_id", "last", "w", "words", *at).join(kept.select(*at, "node", "childless"), at)
    labelled = staged(labelled.select("conv_id", "depth", "last", "w", "words", "node", "childless", (F.col("conv_id") == F.col("node")).alias("owns")), "labelled")

    paths = labelled.groupBy("conv_id").agg(
        F.min(F.when(F.col("owns"), F.col("depth"))).alias("own"),
        F.coalesce(F.sum(F.when(~F.col("owns"), F.col("words"))), F.lit(0)).alias("spare"),
        F.max(F.when(F.col("owns") & F.col("last") & F.col("childless"), 1).otherwise(0)).alias("leaf"),
    )
    paths = staged(paths, "paths")
    share = labelled.select("conv_id", "node", "depth", "last", "w", "words").join(paths.repartition(F.xxhash64("conv_id")), "conv_id")
    share = share.select(
        "node",
        "depth",
        F.greatest(F.lit(0), F.col("spare") - F.col("w") + F.col("words")).alias("saved"),
        "leaf",
        F.when(~F.col("last") & (F.col("depth") + 1 >= F.col("own")), 1).otherwise(0).alias("child"),
    )
    root = F.lit(top).cast("long")
    of_root = paths.select(root.alias("node"), F.lit(0).cast("long").alias("depth"), F.col("spare").alias("saved"), "leaf", F.when(F.col("own") == 1, 1).otherwise(0).alias("child"))
    sums = share.union(of_root).groupBy("node", "depth").agg(F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    above = labelled.select(F.col("conv_id").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    inner = kept.select("node", "depth", "n_convs").join(sums, ["node", "depth"]).join(above, ["node", "depth"], "left")
    inner = inner.select("node", "depth", F.coalesce("parent", root).alias("parent"), "n_convs", "n_children", "n_leaves", "saved_tokens")
    outer = convs.limit(0).select(F.lit(None).cast("long").alias("node"), F.lit(None).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), *[F.lit(None).cast("long").alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    if n_convs:
        # The root alone, when no rebuilt conversation has a turn; else its sums are among the others.
        one = conversations.sparkSession.createDataFrame([(top, 0, None, n_convs)], "node long, depth long, parent long, n_convs long")
        zero = F.lit(0).cast("long")
        if n_longer:
            outer = one.join(sums.where("depth = 0"), ["node", "depth"]).select(*outer.columns)
        else:
            outer = one.select("*", zero.alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"))
    ends = labelled.where("last").select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    ends = ends.union(convs.where("turns = 0").select(root, F.lit(0).cast("long"), "conv_id"))
    digests = ends_digest(ends).withColumnRenamed("conv_id", "node")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    out = inner.union(outer).join(digests, ["node", "depth"], "left")
    return out.select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
