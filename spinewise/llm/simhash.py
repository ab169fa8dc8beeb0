"""SimHash near duplicates: pigeonhole blocks of fingerprints, joined by block, verified by Hamming distance.

1. A fingerprint has a bit where more than half of the hashes of a text's word n-grams have it. Equal ones are one node.
2. The bits are split into blocks. Fingerprints that differ in `distance` bits at most agree in all but so many
   blocks, so for some choice of that many blocks they have the same key: the mask of the chosen blocks and
   the bits under it.
3. A key that too many fingerprints share is split by the same rule over the bits that its mask leaves free:
   what agrees under the mask differs in the free bits only. Each split leaves fewer free bits, and f of
   them have 2^f values at most, so every key ends small enough and nothing is dropped on the way.
4. Fingerprints under one key are compared; the links found are the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import release, slices, staged
from spinewise.llm.components import components, forest

#: Fingerprints under one key that are compared with each other; keys with more are split.
BUCKET = 1024
#: Bytes of a text that are cut into words at a time; hashes whose bits are counted at a time.
PIECE, HASHES = 1 << 20, 1 << 16

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLANKS = b" \t\n\x0b\x0c\r"


def _word_runs(raw: bytes, overlap: int) -> Iterator[tuple[list[bytes], bool]]:
    """(words, whether they are the last) of a text, piece by piece; a piece begins with the last `overlap` words before it."""
    at, held = 0, []
    while True:
        to = min(at + PIECE, len(raw))
        while to < len(raw) and raw[to] not in _BLANKS:
            to += 1
        words = held + raw[at:to].translate(_FOLD).split()
        yield words, to >= len(raw)
        if to >= len(raw):
            return
        held, at = words[len(words) - overlap :] if len(words) > overlap else words, to


def fingerprint(raw: bytes, n: int, seed: int) -> int:
    """The SimHash of a text (UTF-8), unsigned; 0 for a text without words."""
    import xxhash

    counts, total = np.zeros(64, np.int64), 0
    for words, last in _word_runs(raw, n - 1):
        if len(words) < n:
            # Fewer words than a shingle has: the one sequence of all words, if the whole text has no more.
            if not (last and words and total == 0):
                continue
            grams = [b" ".join(words)]
        else:
            line = b" ".join(words)
            length = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(length + 1) - 1
            starts = ends - length
            grams = [line[a:b] for a, b in zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)]
        total += len(grams)
        digest = xxhash.xxh64_intdigest
        for at in range(0, len(grams), HASHES):
            some = grams[at : at + HASHES]
            hashes = np.fromiter((digest(g, seed) for g in some), np.uint64, len(some))
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 3, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = [fingerprint(t or b"", n, seed) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])
        release()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def block_masks(free: int, distance: int, blocks: int) -> list[int]:
    """Masks of all choices of `blocks - distance` of the blocks that the free bits are split into."""
    bits = [i for i in range(64) if free >> i & 1]
    cuts = [len(bits) * k // blocks for k in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    return sorted({sum(chosen) for chosen in combinations(parts, blocks - distance)})


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_keys(nodes: DataFrame, distance: int, blocks: int, bucket: int = BUCKET) -> DataFrame:
    """(mask, part, fp): every fingerprint under its keys, none of which holds more than `bucket` of them."""
    key = ["mask", "part"]
    finer = {0: block_masks((1 << 64) - 1, distance, blocks)}
    keyed = nodes.select("fp", F.lit(0).cast("long").alias("mask"))
    done: list[DataFrame] = []
    while True:
        # The masks of a round are known before it: the choices under each mask of the round before.
        under = F.create_map(*[x for m, below in finer.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(m | b)) for b in below]))])
        keyed = keyed.select("fp", F.explode(under[F.col("mask")].cast("array<long>")).alias("mask"))
        if done:  # several masks of the round before may lead to one
            keyed = keyed.distinct()
        keyed = keyed.withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        full = staged(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket).select(*key), "full-blocks")
        if not full.limit(1).count():
            done.append(keyed)
            break
        done.append(keyed.join(full, key, "left_anti"))
        keyed = staged(keyed.join(full, key, "left_semi").select("fp", "mask"), "split-blocks")
        masks = {m | b for m, below in finer.items() for b in below}
        finer = {m: block_masks(~m & ((1 << 64) - 1), distance, blocks) for m in masks if (1 << (64 - m.bit_count())) > bucket}
    out = done[0]
    for frame in done[1:]:
        out = out.unionByName(frame)
    return out.select(*key, "fp")


def close_pairs(mask: np.ndarray, part: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all fingerprints of one key that are close; rows come in the order of their keys."""
    one, other = [], []
    at, step = np.arange(len(fp) - 1), 1
    while len(at):
        at = at[(part[at] == part[at + step]) & (mask[at] == mask[at + step])]
        near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= distance]
        one.append(fp[near])
        other.append(fp[near + step])
        step += 1
        at = at[at + step < len(fp)]
    a, b = (np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for x in (one, other))
    return forest(a, b)


def close_links(keyed: DataFrame, distance: int) -> DataFrame:
    """(a, b): links between fingerprints, no more under a key than it takes to connect them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]

        def linked(rows: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in close_pairs(*rows, distance)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [np.asarray(batch.column(c), np.int64) for c in range(3)]
            held = [np.concatenate([h, x]) for h, x in zip(held, [new[0], new[1], new[2].view(np.uint64)], strict=True)]
            # The last key may go on in the next batch.
            inside = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            to = inside[-1] + 1 if len(inside) else 0
            yield linked([h[:to] for h in held])
            held = [h[to:] for h in held]
        yield linked(held)
        release()

    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(tasks, "mask", "part").sortWithinPartitions("mask", "part").mapInArrow(run, "a long, b long")


def simhash_components(
    docs: DataFrame,
    n: int = 3,
    distance: int = 2,
    blocks: int = 4,
    seed: int = 42,
    bucket: int = BUCKET,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id): every row with its SimHash and the smallest doc_id it is connected to.

    Words are runs of other than ASCII white space, A-Z folded; shingles are `n` words joined by a space,
    repeats included, of the whole text, or all words of a text with fewer. Their hash is XXH64 of the UTF-8
    bytes with `seed`. Rows link when `distance` bits or fewer of their fingerprints differ.

    Null, empty and blank texts have the fingerprint zero and are linked like others. Equal fingerprints are one
    node however many rows have them; repeated rows are further rows of one. Null ids are no component's id, and a
    row with one gets the id of its component, or null. An empty table gives an empty result; other columns are
    left out. A long text is cut into words a piece at a time.
    """
    found = staged(fingerprints(docs, n, seed, key, text), "simhash")
    firsts = staged(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    linked = components(close_links(block_keys(firsts.select("fp"), distance, blocks, bucket), distance))
    rooted = firsts.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = rooted.join(least, "root").select("fp", "component_id")
    return found.join(of_node, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
