"""Spelling variants: FM-index search schemes over a vocabulary, for words one edit apart.

One edit leaves a word's left or its right half as it was. A word therefore asks twice: one half is matched
exactly, and the search goes on across the other half, where one error may fall. What can answer has that half
too, so words meet by it: a group is the words with the same exact part, and each word is in the few groups
that it can answer in. A group that is too large is split by the same rule: the half with the error is halved again, and the
part without it is one more exact part. A window of one place leaves no more than some hundred words, so every group ends small.

Whole groups are put together to a delimited text with an FM-index, of the words or of the reversed words by the side the
search begins from. All questions to it are searched at once: a state is a suffix-rank interval, how far its
question is matched, and whether the error is used. Each pair is found exactly once, as the error must stand at the
first place where the two words differ, which one character beside it tells.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import release, slices, staged

#: Words of a group; larger ones are split.
GROUP = 4096
#: Characters of an index's text (a whole group at least), and questions that are searched at once.
INDEX_CHARS, QUESTIONS = 400_000, 8192
#: Rows of the index for each stored count of characters.
SAMPLE = 32
#: Distinct words that a task counts before it sends them on.
FLUSH = 1_000_000

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _counted(texts: list[tuple[str, bytes]], least: int, damage: int, held: Counter) -> None:
    run = re.compile("[a-zÀ-ÿ]{%d,}" % least)
    for name, raw in texts:
        start = zlib.crc32(f"{name}:".encode())
        for word, n in Counter(run.findall(raw.translate(_FOLD).decode("utf-8", "replace"))).items():
            h = zlib.crc32(word.encode(), start)
            if h % damage == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < least:
                    continue
            held[word] += n


def vocabulary(docs: DataFrame, least: int = 7, occurrences: int = 2, damage: int = 31, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs of letters of at least so many code points that occur often enough in all texts.

    A run loses one code point where `damage` divides the crc32 of its document's id and itself. A task counts its words first, so that a word
    with a third of all occurrences reaches the task that adds it up once from every task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in slices(batch, 1):
                names = ["" if i is None else str(i) for i in part.column(0).to_pylist()]
                _counted([(a, b) for a, b in zip(names, part.column(1).to_pylist(), strict=True) if b], least, damage, held)
                if len(held) > FLUSH:
                    yield sent()
                    held.clear()
        yield sent()
        release()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


# --- groups ------------------------------------------------------------------------------------------


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, asks, size, lo, hi) with the key of what stands left and right of the window.

    The window lo..hi is in places of a question of `size` code points; a word that may answer it has the same `lo`
    code points at its start and the same `size - hi` at its end.
    """
    right = F.col("size") - F.col("hi")
    left_part = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    right_part = F.when(right > 0, F.substring(F.col("word"), F.char_length("word") - right + 1, right)).otherwise("")
    return rows.withColumn("key", F.xxhash64("lo", left_part, right, right_part))


def _all_windows(words: DataFrame) -> DataFrame:
    """Every word in both windows of questions as long as itself (which it asks), one shorter and one longer.

    `first` leaves out those whose exact part is that of another window of the word: an exact half is as long for
    two sizes side by side, and which two hangs on whether the word's length is odd.
    """
    own = F.char_length("word")
    odd = own % 2 == 1
    parts = []
    for d, left_differs, right_differs in ((0, F.lit(True), F.lit(True)), (-1, ~odd, odd), (1, odd, ~odd)):
        size, asks = own + d, F.lit(d == 0)
        half = F.floor(size / 2).cast("int")
        for lo, hi, first in ((half, size, left_differs), (F.lit(0), half, right_differs)):
            parts.append(F.struct(size.alias("size"), lo.alias("lo"), hi.alias("hi"), asks.alias("asks"), first.alias("first")))
    return words.select("word", "n", F.explode(F.array(*parts)).alias("x")).select("word", "n", "x.*")


def grouped(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(key, word, n, asks, size, lo, hi): words in the groups that hold all that can answer, of `group` words at most."""
    columns = ["key", "word", "n", "asks", "size", "lo", "hi"]
    everything = _keyed(_all_windows(words))
    rows = everything.where("first")
    done: list[DataFrame] = []
    while True:
        full = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > group).select("key"), "full-groups")
        if not full.limit(1).count():
            done.append(rows.select(*columns))
            break
        done.append(rows.join(full, "key", "left_anti").select(*columns))
        wide = everything.join(full, "key", "left_semi")
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        # A window of one place cannot be split; its groups are bounded by the letters there are.
        last = wide.where("hi - lo <= 1").select(*columns)
        halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
        split = wide.where("hi - lo > 1").withColumn("x", F.explode(halves)).select("word", "n", "asks", "size", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"))
        done.append(last)
        rows = everything = staged(_keyed(split), "split-groups")
    out = done[0]
    for frame in done[1:]:
        out = out.union(frame)
    return out


# --- the index ---------------------------------------------------------------------------------------


class FMIndex:
    """Backward search over words with a delimiter before and after each, words being distinct.

    Characters are numbers from 1, the delimiter is 0. Suffixes end at their word's delimiter, and delimiters are
    ordered by place, so the suffix order needs as many rounds as the longest word has bits.
    """

    def __init__(self, chars: np.ndarray, lengths: np.ndarray, letters: int):
        """chars: of all words, one after the other."""
        words = len(lengths)
        self.letters = letters + 1
        begins = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(words), lengths)
        text = np.zeros(len(chars) + words + 1, np.int64)
        text[np.arange(len(chars)) + word + 1] = chars
        n = len(text)
        delimiter = text == 0
        rank = np.where(delimiter, np.cumsum(delimiter) - 1, text + words)
        step = 1
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[: n - step] = rank[step:]
            key = rank * (n + self.letters + 1) + ahead
            order = np.argsort(key, kind="stable")
            sorted_ = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
            if rank[order[-1]] == n - 1:
                break
            step *= 2
        self.size = n
        blocks = n // SAMPLE + 1
        self.bwt = np.zeros(blocks * SAMPLE, np.uint8)
        self.bwt[:n] = text[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.letters))])
        counts = np.bincount(np.arange(n) // SAMPLE * self.letters + self.bwt[:n], minlength=blocks * self.letters).reshape(blocks, self.letters)
        self.counts = np.concatenate([np.zeros((1, self.letters), np.int64), np.cumsum(counts, 0)]).astype(np.int32)
        # Rows before which a word begins, and that word; the first row is that of the first delimiter.
        self.starts = np.flatnonzero(self.bwt[1:n] == 0) + 1
        place = order[self.starts]
        self.word_at = np.searchsorted(begins + np.arange(words) + 1, place, side="right") - 1

    def rank(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often c stands in the first `at` rows of the transform."""
        block, rest = at // SAMPLE, at % SAMPLE
        near = self.bwt.reshape(-1, SAMPLE)[block]
        own = (near == c[:, None].astype(np.uint8)) & (np.arange(SAMPLE) < rest[:, None])
        return self.counts[block, c].astype(np.int64) + own.sum(1)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of c followed by what each interval stands for."""
        return self.first[c] + self.rank(c, lo), self.first[c] + self.rank(c, hi)

    def before(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, character) for every character but the delimiter that stands before some row of an interval."""
        size = hi - lo
        small = size <= 4 * self.letters
        which = np.repeat(np.flatnonzero(small), size[small])
        rows = np.arange(len(which)) - np.repeat(np.cumsum(size[small]) - size[small], size[small]) + lo[which]
        seen = np.unique(which * self.letters + self.bwt[rows])
        large = np.flatnonzero(~small)
        every = (large[:, None] * self.letters + np.arange(1, self.letters)).ravel()
        both = np.concatenate([seen, every])
        which, c = both // self.letters, both % self.letters
        return which[c > 0], c[c > 0]

    def words(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, word) for the words that begin where an interval stands: one each at most, as words are distinct."""
        at = np.searchsorted(self.starts, lo)
        found = np.flatnonzero((at < len(self.starts)) & (self.starts[np.minimum(at, len(self.starts) - 1)] < hi))
        return found, self.word_at[at[found]]


class Questions:
    """Words to ask for, in the order in which an index matches them (backward: the last character first)."""

    def __init__(self, chars: np.ndarray, lengths: np.ndarray, lo: np.ndarray, hi: np.ndarray, from_left: bool):
        """chars: of all words, one after the other; an error may stand in places lo..hi, from_left: matched from the first character."""
        self.length = lengths
        self.begin = np.cumsum(lengths) - lengths
        size = len(chars)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(size) - self.begin[owner]
        place = step if from_left else lengths[owner] - 1 - step
        at = self.begin[owner] + place
        self.char = chars[at]
        inside = (place >= lo[owner]) & (place < hi[owner])
        next_ = np.where(place + 1 < lengths[owner], chars[np.minimum(at + 1, size - 1)], 0)
        self.replace = inside
        self.delete = inside & (next_ != self.char)  # of equal characters side by side only the last
        # Gaps: one more than characters for each word; gap k is met when k characters are matched.
        self.gap_begin = self.begin + np.arange(len(lengths))
        owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        step = np.arange(len(owner)) - self.gap_begin[owner]
        gap = step if from_left else lengths[owner] - step
        self.insert = ((gap >= lo[owner]) & (gap < hi[owner])) | ((gap == lengths[owner]) & (hi[owner] == lengths[owner]))
        # An inserted character must differ from the one right of it, or it stands at a later gap.
        self.unlike = np.where(gap < lengths[owner], chars[np.minimum(self.begin[owner] + gap, size - 1)], 0)


def search(index: FMIndex, asked: Questions) -> tuple[np.ndarray, np.ndarray]:
    """(question, word of the index) for all words exactly one edit away, the error inside the question's window."""
    n = len(asked.length)
    question, matched, used = np.arange(n), np.zeros(n, np.int64), np.zeros(n, bool)
    # All words end before a delimiter; delimiters are the first rows.
    lo, hi = np.zeros(n, np.int64), np.full(n, index.first[1])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(question):
        ended = matched == asked.length[question]
        over = np.flatnonzero(ended & used)
        which, word = index.words(lo[over], hi[over])
        found.append((question[over[which]], word))
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # state, character, matched, used; before extension

        more = np.flatnonzero(~ended)
        at = asked.begin[question[more]] + matched[more]
        steps.append((more, asked.char[at], matched[more] + 1, used[more]))

        free = np.flatnonzero(~used)
        gap = asked.gap_begin[question[free]] + matched[free]
        at = np.minimum(asked.begin[question[free]] + matched[free], len(asked.char) - 1)
        open_ = ~ended[free]
        replace, insert = open_ & asked.replace[at], asked.insert[gap]
        some = np.flatnonzero(replace | insert)
        which, c = index.before(lo[free[some]], hi[free[some]])
        which = some[which]
        other = np.flatnonzero(replace[which] & (c != asked.char[at[which]]))
        steps.append((free[which[other]], c[other], matched[free[which[other]]] + 1, np.ones(len(other), bool)))
        other = np.flatnonzero(insert[which] & (c != asked.unlike[gap[which]]))
        steps.append((free[which[other]], c[other], matched[free[which[other]]], np.ones(len(other), bool)))

        drop = free[np.flatnonzero(open_ & asked.delete[at])]
        state, c, ahead, spent = (np.concatenate(x) for x in zip(*steps, strict=True))
        new_lo, new_hi = index.extend(c, lo[state], hi[state])
        alive = new_lo < new_hi
        question, matched, used, lo, hi = (
            np.concatenate([question[state][alive], question[drop]]),
            np.concatenate([ahead[alive], matched[drop] + 1]),
            np.concatenate([spent[alive], np.ones(len(drop), bool)]),
            np.concatenate([new_lo[alive], lo[drop]]),
            np.concatenate([new_hi[alive], hi[drop]]),
        )
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _numbered(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """The characters of all words as numbers from 1, in code-point order; the words' lengths; how many characters there are."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    letters, chars = np.unique(codes, return_inverse=True)
    return chars.astype(np.int64) + 1, np.array([len(w) for w in words], np.int64), len(letters)


def _part(chars: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters and lengths of some of the words, in that order."""
    size = lengths[rows]
    begins = np.cumsum(lengths) - lengths
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begins[rows], size)
    return chars[at], size


def answers(words: list[str], word: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray, from_left: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(question, word) for questions given by word and window, over an index of the distinct words."""
    chars, lengths, letters = _numbered(words)
    if from_left:  # the reversed words are matched from their last character
        begins = np.cumsum(lengths) - lengths
        back = np.repeat(2 * begins + lengths - 1, lengths) - np.arange(len(chars))
        index = FMIndex(chars[back], lengths, letters)
    else:
        index = FMIndex(chars, lengths, letters)
    for at in range(0, len(word), QUESTIONS):
        some = np.arange(at, min(at + QUESTIONS, len(word)))
        question, found = search(index, Questions(*_part(chars, lengths, word[some]), lo[some], hi[some], from_left))
        yield some[question], found


def near_words(rows: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near): for every question with an answer, how many, and the answer of largest n, smallest word."""
    schema = "word string, n_near long, near_n long, near string"
    names, kinds = [c.split()[0] for c in schema.split(", ")], [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def settle(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        # Groups of one word, and those in which nobody asks, have no answer.
        key = np.asarray(table.column(1), np.int64)
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        rows = np.diff(np.append(heads, len(key)))
        useful = (rows > 1) & np.logical_or.reduceat(np.asarray(table.column(4)), heads)
        table = table.filter(pa.array(np.repeat(useful, rows)))
        if not table.num_rows:
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in kinds], names=names)
        words = table.column(2).combine_chunks().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        order = sorted(range(len(distinct)), key=distinct.__getitem__)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        distinct = [distinct[i] for i in order]  # their place is their rank in code-point order
        word = place[np.asarray(words.indices, np.int64)]
        n = np.zeros(len(distinct), np.int64)
        n[word] = np.asarray(table.column(3), np.int64)
        asks = np.flatnonzero(np.asarray(table.column(4)))
        size, lo, hi = (np.asarray(table.column(c), np.int64)[asks] for c in (5, 6, 7))
        from_left = bool(np.asarray(table.column(0))[0])
        pairs = list(answers(distinct, word[asks], size, lo, hi, from_left))
        question, found = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in range(2))
        order = np.lexsort((found, -n[found], question))
        question, found = question[order], found[order]
        heads = np.flatnonzero(np.concatenate([[True], question[1:] != question[:-1]])) if len(question) else np.zeros(0, np.int64)
        count = np.diff(np.append(heads, len(question)))
        out = [[distinct[i] for i in word[asks][question[heads]]], count, n[found[heads]], [distinct[i] for i in found[heads]]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        chars, side, last = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            left, key = np.asarray(batch.column(0)), np.asarray(batch.column(1), np.int64)
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (left[1:] != left[:-1])) + 1
            length = np.asarray(pc.utf8_length(batch.column(2)), np.int64)
            sums = np.concatenate([[0], np.cumsum(length)])
            begin = 0
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                here = (bool(left[lo]), int(key[lo]))
                if here != last and (held or begin < lo) and (here[0] != side or chars > INDEX_CHARS):
                    if begin < lo:
                        held.append(batch.slice(begin, lo - begin))
                    yield settle(held)
                    held, chars, begin = [], 0, lo
                side, last = here[0], here
                chars += int(sums[hi] - sums[lo])
            held.append(batch.slice(begin))
        if held:
            yield settle(held)
        release()

    # What stands left of the window is matched first where it is the longer part, else what stands right of it.
    sided = rows.withColumn("from_left", F.col("lo") >= F.col("size") - F.col("hi"))
    sided = sided.select("from_left", "key", "word", "n", "asks", "size", "lo", "hi")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sided.repartition(tasks, "key").sortWithinPartitions("from_left", "key").mapInArrow(run, schema)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following the forms (word, form) ends; every form occurs ten times as often, so paths are short."""
    up = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not up.join(above, "root", "left_semi").limit(1).count():
            return up
        above = above.repartition(F.xxhash64("root"))  # a hot root is on the splittable side
        up = staged(up.join(above, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "forms")


def spelling_variants(
    docs: DataFrame,
    least: int = 7,
    occurrences: int = 2,
    factor: int = 10,
    damage: int = 31,
    group: int = GROUP,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word of the vocabulary with its usual spelling.

    Words are those of `vocabulary`. Two are near if they differ by one inserted, deleted or replaced code point.
    A word's form is its near word of largest n, ties to the smallest in code-point order, if that n is `factor` times its
    own or more, else null; its root is where following forms ends, itself if it has none. n_near counts all near words.

    Null texts have no words; a null id counts as an empty one; repeated rows count again. An empty table, or one without such
    words, gives an empty result; other columns are left out. No word, group or pair is capped. A run of letters of any length is a word.
    """
    words = staged(vocabulary(docs, least, occurrences, damage, key, text), "vocabulary")
    found = near_words(grouped(words, group))
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    largest = -F.col("best.less")
    common = largest >= factor * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(common, F.col("best.near")).alias("form"), F.when(common, largest).alias("form_n"))
    known = staged(known, "near-words")
    ends = roots(known.where("form is not null").select("word", "form"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
