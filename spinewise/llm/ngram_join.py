"""N-gram Jaccard join, exact: part signatures bring candidates together, signature trees settle them.

1. A text's set is its distinct word n-grams as 64-bit hashes; equal sets are one node, named by a set hash.
2. The hash range is cut into more parts than two linked sets can differ in elements. One part at least then
   holds the same elements in both, so linked sets share a part signature. Nodes that share any signature,
   directly or through others, are a candidate component.
3. In each candidate component a tree is built over the sets: a leaf holds a few, a node the OR of their token
   bitmaps and the range of their sizes. Walking the tree against itself drops node pairs whose sizes do not
   fit, whose bitmaps cannot overlap enough, or whose sets are all linked already; the rest are compared.
   A component too large for one task is first walked with bitmaps alone, which are a small part of the sets,
   by pairs of blocks; what may still be linked then is a set of much smaller components.
4. The links found are the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spinewise.llm.common import joined_bytes, mix, release, run_hashes, runs, slices, staged
from spinewise.llm.components import components, forest

#: Sets of a leaf; children of a node.
LEAF, FANOUT = 8, 4
#: Bits of a bitmap for each element of the largest set: so many that a leaf's OR is far from full.
TREE_BITS = 16
#: Sets, and elements in all, of a block of a candidate component; larger components are done by pairs of blocks.
BLOCK_SETS, BLOCK_ELEMENTS = 1024, 2_000_000
#: Sets of a leaf when only bitmaps are compared: their ORs are full, so larger leaves are walked faster.
SKETCH_LEAF = 64
#: Sets of a block when only bitmaps are compared, and bits of a bitmap for each element, a power of two at least.
SKETCH_SETS, SKETCH_BITS = 4096, 2
#: Links that a task gathers before it makes a forest of them; nodes that it keeps in mind.
FLUSH = 1_000_000
#: Signatures that a task gathers before it sends them on, as one batch, which Python and the JVM each hold as a whole.
SENT = 250_000
#: Bits of the filter that keeps sets out that have no candidate; when it is full it only filters less.
FILTER_BITS = 1 << 24

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.ones(256, np.uint8)
_WORD[[32, *range(9, 14)]] = 0
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams; a text of fewer words has one, of all its words."""
    data, begins = joined_bytes(texts)
    starts, ends = runs(_WORD[data], begins)
    words = run_hashes(_FOLD[data], starts, ends)
    bounds = np.searchsorted(starts, begins)
    grams = words.copy()
    for k in range(1, n):
        grams = mix(grams[:-1] * _GOLDEN + words[k:]) if len(grams) > 1 else grams[:0]
    out = []
    for lo, hi in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        if hi - lo >= n:
            own = np.sort(grams[lo : hi - n + 1])
            first = np.empty(len(own), bool)
            first[0] = True
            np.not_equal(own[1:], own[:-1], out=first[1:])
            out.append(own[first])
        elif hi > lo:
            short = np.array([hi - lo], np.uint64)
            for w in words[lo:hi]:
                short = mix(short * _GOLDEN + w)
            out.append(short)
        else:
            out.append(grams[:0])
    return out


def node_of(own: np.ndarray) -> int:
    """A hash of the set as a long, the same for equal sets."""
    return int(mix(mix(own + _GOLDEN).sum(keepdims=True) + np.uint64(len(own))).view(np.int64)[0])


class Levels:
    """Size classes: linked sets are in one class or in neighbouring ones. A level serves a class with the next.

    With a and b elements, i of them common, i >= t (a + b - i) leaves (a + b) (1 - t) / (1 + t) differences
    at most, t being `num` / `den`. A level has more parts than that, plus some, so that a set with
    a few empty parts still has enough that are not.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.tops, self.parts, self.spare = [], [], []
        low = 1
        while low < 1 << 31:
            top = low * den // num
            differences = (top + top * den // num) * (den - num) // (den + num)
            spare = 2 + differences // 25
            self.tops.append(top)
            self.parts.append(differences + 1 + spare if differences else 0)
            self.spare.append(spare)
            low = top + 1
        self.bounds = np.array(self.tops)

    def level(self, size: int) -> int:
        return int(np.searchsorted(self.bounds, size))

    def signatures(self, own: np.ndarray) -> np.ndarray:
        """Of a set in class c: its signatures at level c, and at level c - 1 where smaller sets meet it."""
        c, out = self.level(len(own)), []
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(own ^ _GOLDEN))])
        high = own >> np.uint64(32)
        for level in (c, c - 1):
            if level < 0 or not self.parts[level]:
                continue
            parts = self.parts[level]
            part = (high * np.uint64(parts)) >> np.uint64(32)  # parts are runs of the sorted hashes
            ends = np.searchsorted(part, np.arange(parts, dtype=np.uint64), side="right")
            begins = np.concatenate([[0], ends[:-1]])
            tag = np.uint64(level << 32) + np.arange(parts, dtype=np.uint64)
            found = mix(mix(sums[ends] - sums[begins] + tag) * _GOLDEN + tag)
            filled = ends > begins
            # A set with more empty parts than spare ones also shows which are empty.
            out.append(found if parts - filled.sum() > self.spare[level] else found[filled])
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def nodes(rows: DataFrame, n: int) -> DataFrame:
    """(doc_id, node, n_shingles, print) of every row; print is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sets = shingle_sets(part.column(1).to_pylist(), n)
                columns = [part.column(0), pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, part.column(2)], names=["doc_id", "node", "n_shingles", "print"])

    return rows.select("doc_id", "text", F.xxhash64("text").alias("print")).mapInArrow(run, "doc_id long, node long, n_shingles long, print long")


def _stars(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the first row of each key, after ordering; and (node, first node of its key) of the others."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    first = node[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
    apart = node != first
    return order[head], node[apart], first[apart]


def signature_rows(found: Iterator[tuple[np.ndarray, int]], most: int = SENT) -> Iterator[pa.RecordBatch]:
    """(sig, a, x) of sets given as (signatures, node), a batch for each `most` signatures gathered.

    One row for each signature, with x 0; the links among the nodes of a batch are rows under a hash of a, x being the other node xored.
    """
    held: list[tuple[np.ndarray, int]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        sig = np.concatenate([h[0] for h in held]).view(np.int64) if held else np.zeros(0, np.int64)
        node = np.repeat(np.array([h[1] for h in held], np.int64), [len(h[0]) for h in held])
        held.clear()
        heads, a, b = _stars(sig, node)
        heads.sort()  # rows of one node together, which the shuffle's compression likes
        a, b = forest(a, b)
        spread = mix(a.view(np.uint64)).view(np.int64)
        columns = [np.concatenate([sig[heads], spread]), np.concatenate([node[heads], a]), np.concatenate([np.zeros(len(heads), np.int64), b ^ a])]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["sig", "a", "x"])

    for one in found:
        held.append(one)
        size += len(one[0])
        if size >= most:
            yield flush()
            size = 0
    yield flush()


def candidate_links(rows: DataFrame, n: int, levels: Levels) -> DataFrame:
    """(a, b) such that nodes with a common signature are connected.

    A task sends one row for each signature, however many of its texts have it, and the links among those;
    so a signature of a third of all texts reaches the task that gathers it once from every task.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def new_sets() -> Iterator[tuple[np.ndarray, int]]:
            for batch in batches:
                for part in slices(batch, 0):
                    for own in shingle_sets(part.column(0).to_pylist(), n):
                        node = node_of(own) if len(own) else None
                        if node is None or node in seen:
                            continue
                        seen.add(node)
                        yield levels.signatures(own), node
                    if len(seen) > FLUSH:
                        seen.clear()

        yield from signature_rows(new_sets())
        release()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, last, leader, size = [], [], None, 0, 0
        for batch in batches:
            sig, one, other = (np.asarray(batch.column(c), np.int64) for c in range(3))
            if not len(sig):
                continue
            link = other != 0  # links among the texts of one task: the second column is the other node, xored
            a.append(one[link])
            b.append(one[link] ^ other[link])
            sig, node = sig[~link], one[~link]
            if len(sig):
                head = np.ones(len(sig), bool)
                head[1:] = sig[1:] != sig[:-1]
                if sig[0] == last:
                    head[0] = False
                first = np.maximum.accumulate(np.where(head, np.arange(len(sig)), -1))
                top = np.where(first >= 0, node[first], leader)
                apart = top != node
                a.append(node[apart])
                b.append(top[apart])
                last, leader = sig[-1], int(top[-1])
            size += len(a[-1]) + (len(a[-2]) if len(a) > 1 else 0)
            if size > FLUSH:
                x, y = forest(np.concatenate(a), np.concatenate(b))
                a, b, size = [x], [y], 0
        x, y = forest(np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    sent = rows.select("text").mapInArrow(emit, "sig long, a long, x long")
    return sent.repartition("sig").sortWithinPartitions("sig").mapInArrow(gather, "a long, b long")


def _filter_words(named: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of the nodes, two bits each, of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            for place in _filter_places(np.asarray(batch.column(0), np.int64), bits):
                np.bitwise_or.at(words, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some].view(np.int64))], names=["at", "word"])

    out = np.zeros(bits // 64, np.int64)
    for row in named.select("node").mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).collect():
        out[row["at"]] = row["word"]
    return out.view(np.uint64)


def _filter_places(node: np.ndarray, bits: int) -> list[np.ndarray]:
    one = mix(node.view(np.uint64))
    return [one & np.uint64(bits - 1), (one >> np.uint64(32)) & np.uint64(bits - 1)]


def _texts_of(rows: DataFrame, named: DataFrame, n: int, schema: str, columns) -> DataFrame:
    """`columns(sets)` of the nodes in `named` (and few others), made again from the texts; a task gives a node once."""
    words = _filter_words(named, FILTER_BITS)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, 0):
                sets = shingle_sets(part.column(0).to_pylist(), n)
                node = np.array([node_of(s) for s in sets], np.int64)
                hit = np.ones(len(node), bool)
                for place in _filter_places(node, FILTER_BITS):
                    hit &= (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
                new = [i for i in np.flatnonzero(hit) if len(sets[i]) and not (node[i] in seen or seen.add(node[i]))]
                if len(seen) > FLUSH:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([pa.array(node[new], pa.int64()), *columns([sets[i] for i in new])], names=["node", *names])
        release()

    return rows.select("text").mapInArrow(run, f"node long, {schema}")


def _bitmap(own: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width // 64, np.uint64)
    place = own & np.uint64(width - 1)
    np.bitwise_or.at(bits, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
    return bits


def _width(size: int, bits: int) -> int:
    return min(1 << 16, 1 << max(9, (bits * size - 1).bit_length()))


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """The bitmap of fewer bits that the same elements have."""
    return np.bitwise_or.reduce(bits.reshape(-1, width // 64), axis=0)


class SignatureTree:
    """Sets in leaves; above them, nodes with the OR of token bitmaps and the range of sizes.

    Without the sets themselves, what cannot be ruled out counts as linked.
    """

    def __init__(self, sizes: np.ndarray, bitmaps: list[np.ndarray], least: np.ndarray, sets: list[np.ndarray] | None, num: int, den: int, leaf: int):
        self.num, self.den, self.leaf = num, den, leaf
        # Alike sets tend to have the same least hash, so this order puts them into one leaf.
        self.order = np.lexsort((sizes, least))
        self.sizes = sizes[self.order]
        self.sets = [sets[i] for i in self.order] if sets else None
        width = 64 * min(len(b) for b in bitmaps)
        self.bits = np.stack([_folded(bitmaps[i], width) for i in self.order])
        # Elements that share a bit with another one of their set: so many more may be common than bits are.
        self.shared = self.sizes - np.bitwise_count(self.bits).sum(1).astype(np.int64)
        self.levels = [self._group(self.bits, self.sizes, self.sizes, self.shared, leaf)]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._group(*self.levels[-1], FANOUT))

    @classmethod
    def of(cls, sets: list[np.ndarray], num: int, den: int) -> SignatureTree:
        sizes = np.array([len(s) for s in sets], np.int64)
        width = _width(int(sizes.max()), TREE_BITS)
        return cls(sizes, [_bitmap(s, width) for s in sets], np.array([s[0] for s in sets], np.uint64), sets, num, den, LEAF)

    @staticmethod
    def _group(bits, low, high, shared, by):
        at = np.arange(0, len(low), by)
        return np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(shared, at)

    def _rows(self, level: int, i: int) -> slice:
        span = self.leaf * FANOUT**level
        return slice(i * span, min((i + 1) * span, len(self.sizes)))

    def needed(self, a, b):
        """The least overlap of linked sets of a and b elements."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def _possible(self, level: int, i: int, j: np.ndarray) -> np.ndarray:
        """Which nodes j may hold a set linked to one in node i of the same level."""
        bits, low, high, shared = self.levels[level]
        fits = (high[i] * self.den >= self.num * low[j]) & (high[j] * self.den >= self.num * low[i])
        j = j[fits]
        spare, needed = np.minimum(shared[i], shared[j]), self.needed(low[i], low[j])
        fits = np.bitwise_count(bits[i] & bits[j]).sum(1) + spare >= needed
        if level == 0 and fits.any():
            # No set of the one leaf has more in common with the OR of the other than this.
            j, spare, needed = j[fits], spare[fits], needed[fits]
            own = self.bits[self._rows(0, i)]
            fits = np.bitwise_count(own[:, None, :] & bits[j][None, :, :]).sum(2).max(0) + spare >= needed
        return j[fits]

    def links(self) -> list[tuple[int, int]]:
        """Pairs of positions (of the sets as given) that connect all linked sets: no more than it takes."""
        label = np.arange(len(self.sizes))
        out: list[tuple[int, int]] = []
        top = len(self.levels) - 1
        pairs = [(top, 0, 0)]
        while pairs:
            level, i, j = pairs.pop()
            one, other = self._rows(level, i), self._rows(level, j)
            if (label[one] == label[one.start]).all() and (label[other] == label[one.start]).all():
                continue
            if level:
                below = len(self.levels[level - 1][1])
                left = range(i * FANOUT, min((i + 1) * FANOUT, below))
                right = np.arange(j * FANOUT, min((j + 1) * FANOUT, below))
                for x in left:
                    # Popped last to first: a node with itself comes first, and links found there spare the rest.
                    pairs += [(level - 1, x, int(y)) for y in self._possible(level - 1, x, right[right >= x])[::-1]]
                continue
            self._compare(one, other, label, out)
        return [(int(self.order[a]), int(self.order[b])) for a, b in out]

    def _compare(self, one: slice, other: slice, label: np.ndarray, out: list[tuple[int, int]]) -> None:
        a, b = self.sizes[one][:, None], self.sizes[other][None, :]
        overlap = np.bitwise_count(self.bits[one][:, None, :] & self.bits[other][None, :, :]).sum(2).astype(np.int64)
        bound = np.minimum(overlap + np.minimum(self.shared[one][:, None], self.shared[other][None, :]), np.minimum(a, b))
        x, y = np.nonzero((bound >= self.needed(a, b)) & (label[one][:, None] != label[other][None, :]))
        x, y = x + one.start, y + other.start
        keep = x < y
        x, y = x[keep], y[keep]
        for p, q in zip(x.tolist(), y.tolist(), strict=True):
            if label[p] == label[q]:
                continue
            if self.sets is None or self._linked(self.sets[p], self.sets[q]):
                label[label == label[q]] = label[p]
                out.append((p, q))


    def _linked(self, one: np.ndarray, other: np.ndarray) -> bool:
        common = len(np.intersect1d(one, other, assume_unique=True))
        return common * self.den >= self.num * (len(one) + len(other) - common)


def _block_keys(members: DataFrame, sets: int, elements: int) -> DataFrame:
    """(node, key): every member (node, size, class, root) under the keys of all pairs of blocks that it is in.

    A component of one block has one key. In a larger one, blocks are the sets of a size class dealt by hash;
    a block is paired with those of its class and of the next, as linked sets are no further apart.
    """
    counts = members.groupBy("root", "class").agg(F.count(F.lit(1)).alias("sets"), F.sum("size").alias("elements"))
    whole = counts.groupBy("root").agg(F.sum("sets").alias("s"), F.sum("elements").alias("e"))
    blocks = F.greatest(F.ceil(F.col("sets") / sets), F.ceil(F.col("elements") / elements)).cast("int")
    order = Window.partitionBy("root").orderBy("class")
    near = lambda step: F.coalesce(F.when(F.lag("class", step).over(order) == F.col("class") - step, F.lag("blocks", step).over(order)), F.lit(0))
    large = counts.withColumn("blocks", blocks).join(whole, "root").withColumn("large", (F.col("s") > sets) | (F.col("e") > elements))
    large = large.select("root", "class", "blocks", "large", near(1).alias("below"), near(-1).alias("above"))
    dealt = members.join(large, ["root", "class"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    name = lambda c, i, j: F.struct(F.col("root").alias("root"), c.cast("int").alias("class"), i.cast("int").alias("low"), j.cast("int").alias("high"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    c, own, shift = F.col("class"), F.col("own"), F.lit(1 << 20)
    within = F.transform(upto(F.col("blocks")), lambda j: name(c, F.least(own, j), F.greatest(own, j)))
    above = F.transform(upto(F.col("above")), lambda j: name(c, own, shift + j))  # the higher class is told by the shift
    below = F.transform(upto(F.col("below")), lambda j: name(c - 1, j, shift + own))
    keys = F.when(F.col("large"), F.concat(within, above, below)).otherwise(F.array(name(F.lit(-1), F.lit(0), F.lit(0))))
    return dealt.select("node", F.explode(keys).alias("key")).select("node", F.xxhash64("key").alias("key"))


def _tree_links(keyed: DataFrame, tree) -> DataFrame:
    """(a, b): links that connect what is linked under each key; `tree` makes the tree of the rows (key, node, ...) of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def settle() -> pa.RecordBatch:
            found = tree([h[1:] for h in held]).links()
            pairs = [[held[i][0] for i, _ in found], [held[j][0] for _, j in found]]
            return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in pairs], names=["a", "b"])

        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                for key, *row in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if key != last:
                        if len(held) > 1:
                            yield settle()
                        held, last = [], key
                    held.append(tuple(row))
        if len(held) > 1:
            yield settle()
        release()

    # Little data and much work: as many tasks as there may be, not as many as the bytes call for.
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _sketch_links(rows: DataFrame, members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links of all that bitmaps alone cannot rule out, by pairs of blocks."""
    names = "size long, least long, bits binary"

    def sketch(sets: list[np.ndarray]) -> list[pa.Array]:
        least = np.array([s[0] for s in sets], np.uint64).view(np.int64)
        bits = [_bitmap(s, _width(len(s), SKETCH_BITS)).tobytes() for s in sets]
        return [pa.array([len(s) for s in sets], pa.int64()), pa.array(least, pa.int64()), pa.array(bits, pa.binary())]

    def tree(held: list[tuple]) -> SignatureTree:
        bitmaps = [np.frombuffer(h[2], np.uint64) for h in held]
        return SignatureTree(np.array([h[0] for h in held], np.int64), bitmaps, np.array([h[1] for h in held], np.int64), None, num, den, SKETCH_LEAF)

    sketches = _texts_of(rows, members, n, names, sketch).dropDuplicates(["node"])
    keyed = sketches.join(_block_keys(members, SKETCH_SETS, SKETCH_SETS * 4096), "node").select("key", "node", "size", "least", "bits")
    return _tree_links(keyed, tree)


def _set_links(rows: DataFrame, members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links that connect all linked sets of each candidate component."""
    sets = _texts_of(rows, members, n, "items binary", lambda own: [pa.array([s.tobytes() for s in own], pa.binary())]).dropDuplicates(["node"])
    keyed = sets.join(_block_keys(members, BLOCK_SETS, BLOCK_ELEMENTS), "node").select("key", "node", "items")
    return _tree_links(keyed, lambda held: SignatureTree.of([np.frombuffer(h[0], np.uint64) for h in held], num, den))


def _candidates(rows: DataFrame, known: DataFrame, n: int, levels: Levels) -> DataFrame:
    """(node, size, class, root): candidate components, those too large for one task made smaller by bitmaps."""
    tops = F.array(*[F.lit(t) for t in levels.tops])
    sizes = known.groupBy("node").agg(F.first("n_shingles").alias("size"))
    sizes = sizes.withColumn("class", F.size(F.filter(tops, lambda t: t < F.col("size"))))
    found = staged(components(candidate_links(rows, n, levels)).join(sizes, "node"), "candidates")
    whole = found.groupBy("root").agg(F.count(F.lit(1)).alias("s"), F.sum("size").alias("e"))
    large = whole.where((F.col("s") > BLOCK_SETS) | (F.col("e") > BLOCK_ELEMENTS)).select("root")
    if not large.limit(1).count():
        return found
    wide = staged(found.join(large, "root", "left_semi"), "large-candidates")
    finer = components(_sketch_links(rows, wide, n, levels.num, levels.den))
    finer = wide.drop("root").join(finer, "node").select("node", "size", "class", "root")
    return staged(found.join(large, "root", "left_anti").select("node", "size", "class", "root").union(finer), "candidates")


def _linked_nodes(docs: DataFrame, n: int, num: int, den: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows' nodes, see ``nodes``, and (node, root) of those that have a link."""
    rows, levels = _rows(docs, key, text), Levels(num, den)
    known = staged(nodes(rows, n), "set-nodes")
    return known, components(_set_links(rows, _candidates(rows, known, n, levels), n, num, den))


def jaccard_components(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): every row with its set size and the smallest doc_id it is connected to.

    Words are runs of other than ASCII white space, A-Z folded; a set is the distinct n-grams of words of the
    whole text, or the one sequence of a text with fewer words. Two texts link when den * common >= num * all.
    Equal sets are linked. Texts without a word (null, empty, blank) have an empty set and are alone.

    No pair is capped or sampled: any two linked texts share a part signature (see Levels) and so a candidate
    component, in which the tree leaves out only pairs that cannot link or are connected already. Sets are told
    apart by 64-bit hashes. A repeated row is one more member; null ids are no component's id, and a
    row with one gets the id of its component, or null; other columns of the input are left out.
    """
    known, rooted = _linked_nodes(docs, n, num, den, key, text)
    firsts = known.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    firsts = firsts.join(rooted, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = firsts.join(least, "root").select("node", "component_id")
    found = known.join(of_node, "node", "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay when one document of each component does, the one of smallest id; all columns as they came.

    A row without an id stays only where all of its component are without one; of several texts under the id that stays,
    the one of the smallest hash does. Of repeated rows of one id and text one stays, of texts without a word (null,
    empty, blank) each that is not repeated. An empty table gives an empty one.
    """
    known, linked = _linked_nodes(docs, n, num, den, key, text)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "print")
    worded = known.where("n_shingles > 0").groupBy("node").agg(F.min(order).alias("first")).join(linked, "node", "left")
    least = worded.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first")).select("first.doc_id", "first.print")
    stay = least.union(known.where("n_shingles = 0").select("doc_id", "print")).distinct()
    # Null-safe by columns that are never null, so that one exchange by them serves the join and the repeats.
    names = lambda key, mark: [F.coalesce(key, F.lit(0)).alias("named"), key.isNull().alias("unnamed"), mark.alias("print")]
    stay = stay.select(*names(F.col("doc_id"), F.col("print")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    held = docs.select(*names(F.col(key).cast("long"), F.xxhash64(text)), row)
    by = ["named", "unnamed", "print"]
    return held.join(stay, by, "left_semi").dropDuplicates(by).select("row.*")
