"""Byte-level BPE by recursive queries: in each task, DuckDB contracts token rows by a merge table.

A word is a match of the split pattern. Its rows are (word, position, token, next token). One step joins the
rows to the merge table on the pair, finds every word's leftmost pair of the least rank, and contracts it: the
row of the right half becomes the merged token, the row of the left half goes, later positions move up and the
row before learns its new neighbour. A word with no pair left is at its fixpoint. Only distinct words of a
task are encoded; decoding joins ids to the vocabulary and joins the pieces in order.

A long word is contracted in overlapping windows, which are words of the same query, and put together where the
tokens of two windows end at one place. That is exact: if the two tokens beside the place, contracted alone, are
left as they are, then no contraction of the whole word goes over it, as the first that did would also be one of the
two alone; and beside every other place in a window the tokens have been contracted together already.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import per_process, slices
from spinewise.llm.tokens import WordEncoder, gathered

#: Bytes from which a word is contracted in windows; bytes from one window's begin to the next, half of a window.
LONG_WORD, STRIDE = 1000, 64
#: Common places of two windows that are tried at once.
TRIED = 4
#: Words of one query.
WORDS = 12_000
#: A text may be cut before any blank, as no match spans that place, but for one inside a run of white space.
_ODD = re.compile(r"\s (?:\s|\Z)")
_CUT = re.compile(r"(?<=\S)(?= )|(?= \S)")

_LEAST = """
    select w, (best & 16777215)::int as p0, (best >> 24)::int as m
    from (select r.w, min((x.m << 24) | r.p) as best
          from {rows} r join merges x on x.pair = r.t::bigint * 65536 + r.n
          group by r.w)
"""
#: Every step makes a new generation k of the rows of words that still change.
_GENERATIONS = f"""
with recursive s(k, w, p, t, n) as (
    select 0, w, p, t, n from symbols
    union all
    select s.k + 1, s.w, s.p - (s.p > c.p0)::int,
           case when s.p = c.p0 + 1 then c.m else s.t end,
           case when s.p = c.p0 - 1 then c.m else s.n end
    from s join ({_LEAST.format(rows="s")}) c on c.w = s.w
    where s.p <> c.p0
)
select s.w, list(t order by p) as ids
from s join (select w, max(k) as k from s group by w) e on e.w = s.w and e.k = s.k
group by s.w order by s.w
"""
#: Every step overwrites three rows: the merged one, the one that goes (t = -1) and the one before. For long words.
_IN_PLACE = f"""
with recursive s(w, p, t, n, q) using key (w, p) as (
    select w, p, t, n, p + 1 from symbols
    union
    select * from (
        with c as ({_LEAST.format(rows="recurring.s")}),
        halves as (select r.w, r.p, c.m, y.n, y.q, y.p as gone
                 from c join recurring.s r on r.w = c.w and r.p = c.p0
                 join recurring.s y on y.w = r.w and y.p = r.q)
        select w, p, m, n, q from halves
        union all select w, gone, -1, -1, -1 from halves
        union all select r.w, r.p, r.t, c.m, r.q from c join recurring.s r on r.w = c.w and r.q = c.p0 and r.t >= 0)
)
select w, list(t order by p) as ids from s where t >= 0 group by w order by w
"""
_DECODE = "select d, string_agg(piece, '' order by p) as bytes from tokens join vocabulary using (t) group by d order by d"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f if line.strip())}


class BytePairs(WordEncoder):
    """The merge table and vocabulary of a rank file in an in-process database, one for each task."""

    blank = " "

    def __init__(self, rank_file: str, pattern: str, memory: str = "200MB", limit: int = 300_000):
        import duckdb
        import regex

        super().__init__(limit)
        self.ranks = load_ranks(rank_file)
        self.findall = regex.compile(pattern).findall
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces = {rank: piece for piece, rank in self.ranks.items()}
        self.sizes_of = np.zeros(max(self.pieces) + 1, np.int64)
        self.sizes_of[list(self.pieces)] = [len(p) for p in self.pieces.values()]
        pairs = [
            (left << 16 | right, rank)
            for piece, rank in self.ranks.items()
            for i in range(1, len(piece))
            if (left := self.ranks.get(piece[:i])) is not None and (right := self.ranks.get(piece[i:])) is not None
        ]
        merges = np.array(pairs, np.int64).reshape(-1, 2)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        self._table("merges", {"pair": merges[:, 0], "m": merges[:, 1]})
        self._table("vocabulary", {"t": np.array(list(self.ranks.values()), np.int32), "piece": [p.decode("latin-1") for p in self.ranks]})

    def _table(self, name: str, columns: dict) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"create table {name} as select * from given")
        self.con.unregister("given")

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, end to end, and how many each has; a word that is itself a token is that token."""
        raw = [w.encode() for w in words]
        whole = np.array([self.ranks.get(r, -1) for r in raw], np.int64)
        length = np.array([len(r) for r in raw], np.int64)
        short, long = np.flatnonzero((whole < 0) & (length < LONG_WORD)), np.flatnonzero((whole < 0) & (length >= LONG_WORD))
        ids, sizes, order = [whole[whole >= 0]], [np.ones((whole >= 0).sum(), np.int64)], [np.flatnonzero(whole >= 0)]
        for part in [short[at : at + WORDS] for at in range(0, len(short), WORDS)]:
            found, n = self._contracted([raw[i] for i in part], _GENERATIONS)
            ids.append(found)
            sizes.append(n)
            order.append(part)
        for i in long:
            ids.append(self._windowed(raw[i]))
            sizes.append(np.array([len(ids[-1])]))
            order.append(np.array([i]))
        back = np.empty(len(words), np.int64)
        back[np.concatenate(order)] = np.arange(len(words))
        sizes = np.concatenate(sizes).astype(np.int64)
        return gathered(np.concatenate(ids).astype(self.dtype), sizes, back)[0], sizes[back]

    def _contracted(self, raw: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids at the fixpoint of all words, end to end, and how many each has."""
        length = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(length)
        token = self.single[data]
        following = np.append(token[1:], -1).astype(np.int32)
        following[ends - 1] = -1
        word = np.repeat(np.arange(len(raw), dtype=np.int32), length)
        place = (np.arange(len(data)) - np.repeat(ends - length, length)).astype(np.int32)
        self.con.register("symbols", pa.table({"w": word, "p": place, "t": token, "n": following}))
        found = self.con.sql(query).to_arrow_table().column("ids").combine_chunks()
        return np.asarray(found.flatten()), np.diff(np.asarray(found.offsets))

    def _window_ids(self, windows: list[bytes], known: dict[bytes, np.ndarray]) -> None:
        """Contracts the windows that are not known yet."""
        new = [w for w in dict.fromkeys(windows) if w not in known]
        for at in range(0, len(new), WORDS):
            part = new[at : at + WORDS]
            ids, sizes = self._contracted(part, _GENERATIONS)
            known.update(zip(part, np.split(ids, np.cumsum(sizes)[:-1]), strict=True))

    def _windowed(self, raw: bytes) -> np.ndarray:
        """The ids of a long word, from those of windows; by the whole word at once if windows cannot be put together."""
        known: dict[bytes, np.ndarray] = {}
        window = lambda at: raw[at : at + 2 * STRIDE]
        starts = range(0, max(1, len(raw) - STRIDE), STRIDE)
        self._window_ids([window(at) for at in starts], known)

        def ends(at: int) -> np.ndarray:
            return at + np.cumsum(self.sizes_of[known[window(at)]])

        def joints(left: int, right: int) -> list[tuple[int, int, int]]:
            """(place, tokens of the left window before it, of the right one) where both have an end, those in the middle first."""
            one, other = ends(left), np.concatenate([[right], ends(right)[:-1]])
            place, i, j = np.intersect1d(one, other, return_indices=True)
            near = np.argsort(np.abs(place - (right + min(left + 2 * STRIDE, len(raw))) // 2), kind="stable")
            return [(int(place[x]), int(i[x]) + 1, int(j[x])) for x in near if place[x] < len(raw)]

        def beside(left: int, right: int, joint: tuple[int, int, int]) -> tuple[int, int]:
            return int(known[window(left)][joint[1] - 1]), int(known[window(right)][joint[2]])

        def pair(two: tuple[int, int]) -> bytes:
            return self.pieces[two[0]] + self.pieces[two[1]]

        def apart(two: tuple[int, int]) -> bool:
            return known[pair(two)].tolist() == list(two)

        # All neighbouring windows at once.
        tried = {at: joints(at, at + STRIDE)[:TRIED] for at in list(starts)[:-1]}
        self._window_ids([pair(beside(at, at + STRIDE, x)) for at, some in tried.items() for x in some], known)
        good = {at: next((x for x in some if apart(beside(at, at + STRIDE, x))), None) for at, some in tried.items()}

        out, at, first = [], 0, 0
        while at + 2 * STRIDE < len(raw):
            found, right = None, at + STRIDE
            if at in good and good[at] is not None and good[at][1] > first:
                found = good[at]
            if found is None:
                # On with a window that begins where a token of this one ends, or with the next of the others.
                some = [int(p) for p in ends(at)[first:-1] if p > at]
                for right in [(at // STRIDE + 1) * STRIDE, *some[len(some) // 2 :: -1], *some[len(some) // 2 + 1 :]]:
                    if right not in starts and right not in some or right >= len(raw) or right <= at:
                        continue
                    self._window_ids([window(right)], known)
                    options = [x for x in joints(at, right) if x[1] > first]
                    self._window_ids([pair(beside(at, right, x)) for x in options[:TRIED]], known)
                    found = next((x for x in options[:TRIED] if apart(beside(at, right, x))), None)
                    if found:
                        break
            if found is None:
                return self._contracted([raw], _IN_PLACE)[0]
            out.append(known[window(at)][first : found[1]])
            at, first = right, found[2]
        out.append(known[window(at)][first:])
        return np.concatenate(out)

    def split(self, chunk: str) -> list[str]:
        return self.findall(chunk)

    def ready(self, texts: pa.Array) -> tuple[pa.Array, dict[int, list[str]]]:
        odd = {i: _CUT.split(t) for i, t in enumerate(texts.to_pylist()) if _ODD.search(t)}
        if odd:
            texts = pc.if_else(pc.is_in(pa.array(range(len(texts))), pa.array(odd, pa.int64())), "", texts)
        return texts, odd

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that the ids of each text stand for."""
        out = []
        for at in range(0, len(ids), 512):
            part = ids[at : at + 512]
            length = np.array([len(b) // 2 for b in part], np.int64)
            token = np.frombuffer(b"".join(part), "<u2").astype(np.int32)
            text = np.repeat(np.arange(len(part), dtype=np.int32), length)
            self.con.register("tokens", pa.table({"d": text, "p": np.arange(len(token)), "t": token}))
            found = self.con.sql(_DECODE).to_arrow_table()
            texts = dict(zip(found.column("d").to_pylist(), found.column("bytes").to_pylist(), strict=True))
            out += [texts.get(d, "").encode("latin-1") for d in range(len(part))]
        return out


def _in_tasks(frame: DataFrame, rank_file: str, pattern: str, schema: str, work) -> DataFrame:
    """`work(pairs, column values)` over parts of the second column; the first is passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = per_process(("byte pairs", rank_file, pattern), lambda: BytePairs(rank_file, pattern))
        for batch in batches:
            for part in slices(batch, 1, 4096, 6 << 20):
                columns = work(pairs, part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), *columns.values()], names=["doc_id", *columns])

    return frame.mapInArrow(run, f"doc_id long, {schema}")


def bpe_encode(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text, two little-endian bytes each, as the tiktoken library gives them.

    One row for each row, repeated and null keys as well; null and empty texts have no ids; other columns of the
    input are left out. Nothing is shuffled. Memory holds the distinct chunks of a task up to a limit.
    The file must have at most 65,536 ranks and all single bytes.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _in_tasks(rows, rank_file, pattern, "ids binary", lambda pairs, texts: {"ids": pa.array(pairs.encode(texts), pa.binary())})


def bpe_decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, bytes): the bytes that the ids of each row of bpe_encode stand for."""
    return _in_tasks(encoded.select("doc_id", "ids"), rank_file, pattern, "bytes binary", lambda pairs, ids: {"bytes": pa.array(pairs.decode(ids.to_pylist()), pa.binary())})


_NUMERALS = [str(i) for i in range(1 << 16)]


def bpe_digest(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Number and hash of the ids of each text, and hash of what they decode to; both ways in one task."""

    def digest(pairs: BytePairs, texts: pa.Array) -> dict[str, pa.Array]:
        ids = pairs.encode(texts)
        decimal = [" ".join(map(_NUMERALS.__getitem__, np.frombuffer(b, "<u2").tolist())) for b in ids]
        return {
            "n_tokens": pa.array([len(b) // 2 for b in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decimal]),
            "decoded_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in pairs.decode(ids)]),
        }

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return _in_tasks(rows, rank_file, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest)
