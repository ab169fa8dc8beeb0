"""BPE, token files and packing against the libraries and exact round trips."""

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from llm.cases import LONG, ODD, collected, no_documents, odd_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spinewise.llm import bpe
from spinewise.llm.bpe import BytePairs, bpe_decode, bpe_digest, bpe_encode, load_ranks
from spinewise.llm.packing import pack, piece_digest, sequences
from spinewise.llm.token_files import PerfectHash, ShardIndex, token_file_digest
from spinewise.llm.tokens import FileEncoder

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "a", "B", "'s", "'ll", "é", "É", "9", "!", "字", "😀", "́", "İ", "Σ", "\x00", ".", ",", "--", "_", "<|endoftext|>", "</w>"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def words():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def mixed_texts():
    rng = random.Random(4)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + [None, "", LONG]


def numbers(raw, kind="<u2"):
    return [np.frombuffer(b, kind).tolist() for b in raw]


def test_byte_pairs_equal_the_library_and_decode_to_the_text(reference):
    pairs, texts = BytePairs(RANKS, P.PATTERN), mixed_texts()
    ids = pairs.encode(pa.array(texts))
    assert numbers(ids) == [reference.encode_ordinary(t or "") for t in texts]
    assert pairs.decode(ids) == [(t or "").encode() for t in texts]


@pytest.mark.parametrize("word", ["a" * 3000, "ab" * 900 + "c", "".join(random.Random(1).choice("abcdefgh") for _ in range(1500))])
def test_long_words_are_contracted_in_place(reference, word):
    assert numbers(BytePairs(RANKS, P.PATTERN).encode(pa.array([word]))) == [reference.encode_ordinary(word)]


@pytest.mark.parametrize("kind", ["letters", "one letter", "two letters", "words", "digits and signs", "bytes", "runs"])
def test_very_long_words_take_seconds(reference, kind):
    rng = random.Random(2)
    n = 200_000
    word = {
        "letters": lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)),
        "one letter": lambda: "a" * n,
        "two letters": lambda: "ab" * (n // 2),
        "words": lambda: "".join(rng.choices(["the", "ing", "tion", "there", "on", "ed", "he", "int"], k=n // 3)),
        "digits and signs": lambda: "".join(rng.choices("-=*#", k=n)),
        "bytes": lambda: "".join(rng.choices("éÉß字语ñ", k=n // 3)),
        "runs": lambda: "".join(c * rng.randrange(1, 300) for c in rng.choices("aehx", k=n // 150)),
    }[kind]()
    pairs = BytePairs(RANKS, P.PATTERN)
    began = time.monotonic()
    got = pairs._windowed(word.encode())
    assert time.monotonic() - began < 60
    assert got.tolist() == reference._encode_single_piece(word.encode())


@pytest.mark.parametrize("seed", range(3))
def test_windows_are_put_together_as_the_whole_word_is_contracted(reference, seed, monkeypatch):
    monkeypatch.setattr(bpe, "STRIDE", 16)
    rng = random.Random(seed)
    pairs = BytePairs(RANKS, P.PATTERN)
    for letters in ("ab", "aeinost", "the ", "01-", "aaab"):
        word = "".join(rng.choices(letters, k=rng.randrange(1000, 3000))).encode()
        assert pairs._windowed(word).tolist() == reference._encode_single_piece(word)


def test_the_store_of_words_may_be_emptied(reference):
    pairs = BytePairs(RANKS, P.PATTERN, limit=3)
    for text in ("one two three four", "five six", "one two six"):
        assert numbers(pairs.encode(pa.array([text]))) == [reference.encode_ordinary(text)]


def test_bpe_over_odd_rows(spark, reference):
    df = odd_documents(spark)
    encoded = bpe_encode(df, RANKS, P.PATTERN)
    got = sorted(collected(encoded), key=str)
    assert got == sorted(((d, np.array(reference.encode_ordinary(t or ""), "<u2").tobytes()) for d, t in ODD), key=str)
    decoded = sorted(collected(bpe_decode(encoded, RANKS, P.PATTERN)), key=str)
    assert decoded == sorted(((d, (t or "").encode()) for d, t in ODD), key=str)
    want = [(d, reference.encode_ordinary(t or ""), t or "") for d, t in ODD]
    want = [(d, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, i, t in want]
    assert sorted(collected(bpe_digest(df, RANKS, P.PATTERN)), key=str) == sorted(want, key=str)
    assert bpe_digest(no_documents(spark), RANKS, P.PATTERN).count() == 0


def test_word_files_equal_the_library(words):
    texts = mixed_texts()
    assert numbers(FileEncoder(WORDS).encode(pa.array(texts))) == [words(t) for t in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_the_perfect_hash_gives_each_key_a_slot_of_its_own(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    keys = np.unique(keys)
    assert sorted(PerfectHash.of(keys).slots(keys)) == list(range(len(keys)))


def test_an_index_finds_all_records_of_a_key_and_none_of_others():
    keys = np.sort(np.array([5, 5, 9, 11, 11, 11, 40], np.uint64))
    counts = np.arange(1, 8)
    index = ShardIndex.from_bytes(ShardIndex.of(2, keys, np.cumsum(counts) - counts, counts).to_bytes())
    which, record = index.records(np.array([11, 5, 7, 1 << 40], np.uint64))
    assert list(zip(which.tolist(), record.tolist())) == [(0, 3), (0, 4), (0, 5), (1, 0), (1, 1)]


def test_token_files_give_every_document_in_key_order(spark, words):
    got = collected(token_file_digest(odd_documents(spark), WORDS))
    assert len(got) == len(ODD)
    ids = {d: [] for d, _ in ODD}
    for d, t in ODD:
        i = [*words(t), 2]
        ids[d].append((len(i), zlib.crc32(np.array(i, "<u4").tobytes())))
    assert sorted((d, n, c) for d, _, n, c in got if d) == sorted((d, *x) for d, own in ids.items() if d for x in own)
    ordered = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in ordered] == np.cumsum([0, *[r[2] for r in ordered]])[:-1].tolist()
    assert [r[0] for r in ordered] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7]
    assert token_file_digest(no_documents(spark), WORDS).count() == 0


@pytest.mark.parametrize("length", [7, 2048])
def test_pieces_fill_the_sequences(spark, words, length):
    pieces = pack(odd_documents(spark), WORDS, length)
    got = collected(pieces)
    size = sum(len(words(t)) + 1 for _, t in ODD)
    by_sequence = {}
    for d, start, n, total, s, offset, ids in got:
        assert len(ids) == 4 * n
        by_sequence.setdefault(s, []).append((offset, n, ids))
    assert sorted(by_sequence) == list(range(-(-size // length)))
    for s, own in by_sequence.items():
        own.sort()
        assert [o for o, _, _ in own] == np.cumsum([0, *[n for _, n, _ in own]])[:-1].tolist()
        assert sum(n for _, n, _ in own) == (length if s < len(by_sequence) - 1 else size - length * s)
    for d, text in {(d, t) for d, t in ODD if d not in (None, 1)}:
        whole = b"".join(r[6] for r in sorted((r for r in got if r[0] == d), key=lambda r: r[1]))
        assert numbers([whole], "<u4") == [[*words(text), 1]]
    joined = {r.sequence_id: (r.length, r.ids) for r in sequences(pieces).collect()}
    assert joined == {s: (sum(n for _, n, _ in own), b"".join(i for _, _, i in sorted(own))) for s, own in by_sequence.items()}
    assert piece_digest(pieces).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_a_key_with_a_third_of_all_rows_is_many_shards(spark, words, monkeypatch):
    from spinewise.llm import token_files

    monkeypatch.setattr(token_files, "SHARD_BYTES", 2000)
    rows = [(i, f"text number {i}") for i in range(200)] + [(50, "one text that is always the same")] * 120
    df = odd_documents(spark).select("doc_id", "text").limit(0).union(spark.createDataFrame(rows, "doc_id long, text string"))
    path = token_files.new_path(spark, "hot-files")
    manifest = token_files.write_token_files(df, path, WORDS)
    shards = {r["shard"]: r["n"] for r in manifest.where("doc_id = 50").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(shards.values()) == 121 and len(shards) > 2 and max(shards.values()) < 121
    got = sorted(collected(token_file_digest(df, WORDS)), key=lambda r: r[1])
    start = 0
    for doc_id, at, n, _ in got:
        assert at == start
        start += n
    assert [r[0] for r in got] == sorted(d for d, _ in rows)
    coded = {t: np.array([*words(t), 2], "<u4") for _, t in rows}
    assert sorted((d, n, c) for d, _, n, c in got) == sorted((d, len(coded[t]), zlib.crc32(coded[t].tobytes())) for d, t in rows)


def test_names_of_stores():
    from spinewise.llm.token_files import store_of

    assert store_of("file:///tmp/x")[1] == "/tmp/x" and store_of("file:/tmp/x")[1] == "/tmp/x" and store_of("dbfs:/x/y")[1] == "/dbfs/x/y"
    try:
        assert store_of("s3a://bucket/x")[1] == "bucket/x"
    except OSError:
        pass  # no network to ask for the bucket's region


def test_nothing_is_packed_of_nothing(spark):
    assert pack(no_documents(spark), WORDS).count() == 0
