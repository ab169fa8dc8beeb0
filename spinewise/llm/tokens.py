"""Encoding of many texts by their distinct words: cut, count, encode what is new, put together again."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Letters that are one letter in lower case too, and ASCII signs: a chunk of letters and then signs is two words.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SIMPLE = f"^[{_LETTERS}]+[!-/:-@\\[-`{{-~]*$"
_MARKED = f"^[{_LETTERS}]+[!-/:-@\\[-`{{-~]+$"


def gathered(values: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `values` (their sizes one after the other) at `places`, end to end, and the length of each."""
    begins, times = np.cumsum(sizes) - sizes, sizes[places]
    ends = np.cumsum(times)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begins[places] - (ends - times), times) + np.arange(total)], times


class WordEncoder:
    """Ids of texts from the ids of their words; words seen are kept, up to `limit` of them.

    A subclass says how texts are cut and what ids a word has. Texts are cut at single blanks into chunks, and
    chunks into words, so that the ids of a text are those of its words in turn.
    """

    blank = ""  # stands before every chunk but a text's first
    dtype = np.dtype("<u2")

    def __init__(self, limit: int = 300_000):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.ids, self.sizes = np.zeros(0, self.dtype), np.zeros(0, np.int64)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, end to end, and how many each has."""
        raise NotImplementedError

    def split(self, chunk: str) -> list[str]:
        """The words of any chunk."""
        return [chunk]

    def ready(self, texts: pa.Array) -> tuple[pa.Array, dict[int, list[str]]]:
        """Texts that may be cut at every blank, and the chunks of those that may not, by place."""
        return texts, {}

    def fold(self, words: pa.Array) -> pa.Array:
        return words

    def _numbers(self, words: list[str], distinct: bool = False) -> np.ndarray:
        """The place of each word among the words seen; new ones are encoded and added."""
        new = [w for w in (words if distinct else set(words)) if w not in self.seen]
        if new:
            self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new)), strict=True))
            ids, sizes = self.words(new)
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        return np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))

    def _split_all(self, pieces: pa.Array, others: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all chunks, end to end, and how many each has: of the pieces, then of the others.

        Latin letters, with signs after them at most, need no pattern: a word, and the signs as another one.
        """
        if len(self.seen) > self.limit:
            self.forget()
        spaced = pc.binary_join_element_wise("", pieces, self.blank) if self.blank else pieces
        simple = np.asarray(pc.match_substring_regex(pieces, _SIMPLE))
        marked = np.asarray(pc.match_substring_regex(pieces, _MARKED))
        odd = [self.split(c) for c in spaced.filter(pa.array(~simple)).to_pylist()] + others
        counts = np.ones(len(pieces) + len(others), np.int64)
        counts[: len(pieces)][marked] = 2
        rest = np.concatenate([~simple, np.ones(len(others), bool)])
        counts[rest] = [len(own) for own in odd]
        begins = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        heads = self.fold(pc.utf8_rtrim(spaced.filter(pa.array(simple)), _SIGNS)).dictionary_encode()
        marks = pc.replace_substring_regex(pieces.filter(pa.array(marked)), f"^[{_LETTERS}]+", "").dictionary_encode()
        out[begins[: len(pieces)][simple]] = self._numbers(heads.dictionary.to_pylist(), True)[np.asarray(heads.indices)]
        out[begins[: len(pieces)][marked] + 1] = self._numbers(marks.dictionary.to_pylist(), True)[np.asarray(marks.indices)]
        places = np.repeat(begins[rest] - np.cumsum(counts[rest]) + counts[rest], counts[rest]) + np.arange(counts[rest].sum())
        out[places] = self._numbers([w for own in odd for w in own])
        return out, counts

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian integers of `dtype`; null and empty texts have none."""
        raw, odd = self.ready(texts.fill_null(""))
        plain = pc.split_pattern(raw, " ")
        begins = np.asarray(plain.offsets).astype(np.int64)
        pieces = plain.values.dictionary_encode()
        # Codes count the distinct pieces; a text's first piece is a chunk of its own.
        codes = np.asarray(pieces.indices).astype(np.int64)
        codes[begins[:-1]] = len(pieces.dictionary) + np.arange(len(raw))
        firsts = plain.values.take(pa.array(begins[:-1])).to_pylist()
        whole = [[w for c in odd[i] for w in self.split(c)] if i in odd else self.split(f) for i, f in enumerate(firsts)]
        numbers, counts = self._split_all(pieces.dictionary, whole)
        unit = self.dtype.itemsize
        ids, size = self.ids, self.sizes
        for places, per in ((numbers, counts), (codes, np.diff(begins))):  # words to chunks, chunks to texts
            ids, length = gathered(ids, size, places)
            ends = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(per)])]
            size = np.diff(ends)
        flat, bounds = ids.tobytes(), (unit * ends).tolist()
        return [flat[b:e] for b, e in zip(bounds, bounds[1:], strict=False)]


class FileEncoder(WordEncoder):
    """Ids by a file of the tokenizers library, for those that drop white space and match nothing across it.

    That is true of word_bpe files, which also fold case and end each word with a token of its own kind.
    """

    def __init__(self, path: str, limit: int = 300_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        super().__init__(limit)

    def ready(self, texts: pa.Array) -> tuple[pa.Array, dict[int, list[str]]]:
        return pc.replace_substring_regex(texts, "[\t\n\r]", " "), {}

    def fold(self, words: pa.Array) -> pa.Array:
        return pc.utf8_lower(words)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of ASCII letters are encoded many at once, as one text, and told apart by the tokens that end words."""
        plain = np.asarray(pc.ascii_is_alpha(pa.array(words, pa.string())))
        some, others = [w for w, p in zip(words, plain, strict=True) if p], [w for w, p in zip(words, plain, strict=True) if not p]
        joined = [" ".join(some[at : at + 1000]) for at in range(0, len(some), 1000)]
        ids = [np.array(done.ids, self.dtype) for done in self.tokenizer.encode_batch_fast(joined + others, add_special_tokens=False)]
        ends = [np.flatnonzero(self.last[i]) + 1 for i in ids[: len(joined)]]
        sizes = [np.diff(e, prepend=0) for e in ends] + [np.array([len(i) for i in ids[len(joined) :]], np.int64)]
        back = np.empty(len(words), np.int64)
        back[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(words))
        sizes = np.concatenate(sizes)
        return gathered(np.concatenate([np.zeros(0, self.dtype), *ids]), sizes, back)[0], sizes[back]
