"""SimHash, prefix trie and spelling variants against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm.cases import LONG, CLASHING, collected, documents, no_documents, odd_documents
from pyspark.sql import functions as F

from spinewise.llm import prefix_trie as trie
from spinewise.llm import simhash, spelling

# --- SimHash -----------------------------------------------------------------------------------------


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def simhash_of(text, n=3):
    words = words_of(text)
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped_by_brute_force(fingerprints, distance):
    """Least id reachable, for rows of (id, fingerprint)."""
    label = list(range(len(fingerprints)))
    for i, (_, a) in enumerate(fingerprints):
        for j, (_, b) in enumerate(fingerprints[:i]):
            if (a ^ b).bit_count() <= distance and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = {}
    for (key, _), x in zip(fingerprints, label):
        if key is not None:
            out[x] = min(out.get(x, key), key)
    return [out.get(x) for x in label]


def expected_simhash(rows, distance=2):
    prints = [(i, simhash_of(t)) for i, t in rows]
    return sorted(zip([i for i, _ in prints], [f"{f:016x}" for _, f in prints], grouped_by_brute_force(prints, distance)), key=str)


def test_simhash_of_odd_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents(spark).collect()]
    assert sorted(collected(simhash.simhash_components(odd_documents(spark))), key=str) == expected_simhash(rows)
    assert simhash.simhash_components(no_documents(spark)).count() == 0


def test_simhash_of_near_copies(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        base = rng.choice(words, 120)
        rows.append((1000 - 7 * i, " ".join(base)))
        for k in range(4):
            base[rng.integers(0, 120)] = "new"
            rows.append((2000 + 10 * i + k, " ".join(base).upper() if k % 2 else "  ".join(base)))
    got = sorted(collected(simhash.simhash_components(documents(spark, rows))), key=str)
    assert got == expected_simhash(rows)
    assert len({g[2] for g in got}) < len(rows)


def test_a_long_text_is_hashed_piece_by_piece(monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 50)
    monkeypatch.setattr(simhash, "HASHES", 7)
    for text in (LONG[:5000], "a b", "a", "", "  ", "x" * 400 + " y", " ".join("ab" for _ in range(100)), "q " * 30 + "z" * 300):
        assert simhash.fingerprint(text.encode(), 3, 42) == simhash_of(text)


def test_full_blocks_are_split_until_they_are_small(spark):
    """Fingerprints that agree in most blocks: all in one key of the first round, a third of them in one of the second."""
    rng = np.random.default_rng(5)
    prints = {int(x) for x in rng.integers(0, 1 << 12, 300)} | {int(x) << 40 for x in rng.integers(0, 1 << 12, 150)} | {int(x) for x in rng.integers(0, 1 << 62, 50)}
    nodes = spark.createDataFrame([(x,) for x in prints], "fp long")
    keyed = simhash.block_keys(nodes, 2, 4, bucket=20).cache()
    assert keyed.groupBy("mask", "part").count().agg(F.max("count")).first()[0] <= 20
    held = {}
    for mask, part, fp in collected(keyed):
        assert mask & fp == part
        held.setdefault((mask, part), set()).add(fp)
    close = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2}
    met = {(a, b) for group in held.values() for a in group for b in group if a < b}
    assert close and close <= met
    label = {x: x for x in prints}
    for a, b in collected(simhash.close_links(keyed, 2)):
        assert (a ^ b).bit_count() <= 128
        old, new = label[a], label[b]
        label = {k: new if v == old else v for k, v in label.items()}
    order = sorted(prints)
    want = grouped_by_brute_force([(x, x) for x in order], 2)
    least = {}
    for x in order:
        least.setdefault(label[x], x)
    assert [least[label[x]] for x in order] == want


# --- prefix trie -------------------------------------------------------------------------------------


def expected_trie(rows, group=20, heads=4, seed=1):
    """Rows (conv_id, turn, role, text) to the nodes, by the sequences themselves."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % heads
        built[c] = tuple(turns.get(c - c % group, [])[:h] + turns[c][h:])
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, own_members in members.items():
        worth = (len(own_members) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += worth
    out = []
    for path, own_members in members.items():
        ends = ",".join(str(c) for c in sorted(own_members) if len(built[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own_members), len(path), parent, len(own_members), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = [*CLASHING, "depth", "words", "at", "w", "h", "g", "d1", "d2", "own", "last", "turns", "size", "member", "parent"]
    return df.withColumns({c: F.lit("x") for c in dict.fromkeys(clash)})


def talk(rng, n, texts=6, longest=7):
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(1, longest))):
            rows.append((c, t, ["user", "assistant"][t % 2], " ".join(f"s{rng.integers(0, texts)}" for _ in range(int(rng.integers(0, 3))))))
    return rows


def test_trie_equals_brute_force(spark):
    rows = talk(np.random.default_rng(8), 300, texts=2)
    assert sorted(collected(trie.prefix_trie(conversations(spark, rows))), key=str) == expected_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [(None, 0, "user", "nobody"), (5, None, "user", "a b"), (5, 0, None, None), (5, 1, "", ""), (5, 1, "", ""), (20, 0, "u", "Ü x\ty"), (23, 0, "u", "Ü x\ty"), (23, 1, "u", LONG), (29, 3, "", "")]
    rows += [(c, 0, "u", "same") for c in range(100, 140)]
    assert sorted(collected(trie.prefix_trie(conversations(spark, rows))), key=str) == expected_trie(rows)
    assert trie.prefix_trie(conversations(spark, [])).count() == 0
    alone = [(c, 0, "u", "x") for c in (41, 43) if zlib.crc32(str(c).encode()) % 4]
    if alone:  # no head and nothing after it: the root alone
        assert sorted(collected(trie.prefix_trie(conversations(spark, alone))), key=str) == expected_trie(alone)


def test_a_conversation_over_many_tasks(spark):
    """One conversation with a third of all turns, and one prefix with most of the conversations."""
    rng = np.random.default_rng(9)
    rows = talk(rng, 200) + [(7, t, "user", f"s{t % 3} x") for t in range(100, 700)]
    rows += [(c, t, "u", "common text") for c in range(400, 800) for t in range(4)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert sorted(collected(trie.prefix_trie(conversations(spark, rows))), key=str) == expected_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_equal_products_of_different_turns_are_found(spark, monkeypatch):
    """With names of one bit the first tries fail the test of the names; the result comes from one that passes."""
    rows = talk(np.random.default_rng(10), 30)
    named, unique, asked = trie._named, trie.names_are_unique, []

    def poor(conversations, key, turn, role, text, seed):
        df = named(conversations, key, turn, role, text, seed)
        return df.withColumns({"d1": F.col("d1") % 2, "d2": F.lit(0).cast("long")}) if seed < 3 else df

    def checked(conversations, role, text, seed):
        asked.append(seed)
        return seed >= 3 and unique(conversations, role, text, seed)

    monkeypatch.setattr(trie, "_named", poor)
    monkeypatch.setattr(trie, "names_are_unique", checked)
    assert sorted(collected(trie.prefix_trie(conversations(spark, rows))), key=str) == expected_trie(rows)
    assert asked == [1, 2, 3]


def test_products_compose():
    rng = np.random.default_rng(11)
    a, b = (rng.integers(0, 1 << 61, 1000).astype(np.uint64) % trie.PRIME for _ in range(2))
    assert [int(x) for x in trie.times(a, b)] == [int(x) * int(y) % int(trie.PRIME) for x, y in zip(a, b)]
    assert [int(x) for x in trie.minus(a, b)] == [(int(x) - int(y)) % int(trie.PRIME) for x, y in zip(a, b)]
    assert [int(x) for x in trie.powers(12345, 40)] == [pow(12345, k, int(trie.PRIME)) for k in range(41)]
    heads = np.zeros(1000, bool)
    heads[[0, 10, 700]] = True
    sums, total = [], 0
    for x, head in zip(a, heads):
        total = (0 if head else total) + int(x)
        sums.append(total % int(trie.PRIME))
    assert [int(x) for x in trie.running(a, heads)] == sums


def test_ends_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 40)
    rows = [(1, 2, m) for m in range(500)] + [(k, 1, k) for k in range(2, 40)] + [(0, 0, 5), (0, 0, 3)]
    got = collected(trie.ends_digest(spark.createDataFrame(rows, "conv_id long, depth long, member long").repartition(5)))
    want = {}
    for c, d, m in sorted(rows):
        want.setdefault((c, d), []).append(str(m))
    assert sorted(got) == sorted((*k, hashlib.sha256(",".join(v).encode()).hexdigest()) for k, v in want.items())


# --- spelling ----------------------------------------------------------------------------------------


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected_words(rows, least=7, damage=31):
    counts = Counter()
    for i, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def expected_variants(rows, factor=10):
    counts = expected_words(rows)
    out, forms = {}, {}
    for w, n in counts.items():
        others = sorted((v for v in counts if near(w, v)), key=lambda v: (-counts[v], v))
        form = others[0] if others and counts[others[0]] >= factor * n else None
        forms[w] = form
        out[w] = [form, n, len(others), counts[form] if form else None]
    result = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        result.append((w, form, root, n, n_near, form_n))
    return sorted(result, key=str)


def spelled(seed=12, words=60, rows=80):
    rng = np.random.default_rng(seed)
    letters = list("abcdeéß÷")
    base = ["".join(rng.choice(letters, rng.integers(6, 12))) for _ in range(words)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "Abababa"]
    out = []
    for i in range(rows):
        line = []
        for _ in range(60):
            w = base[int(rng.integers(0, len(base)) * rng.random())]
            if rng.random() < 0.1:
                k, c = int(rng.integers(0, len(w) + 1)), str(rng.choice(letters))
                w = [w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]][int(rng.integers(0, 3))]
            line.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i if i % 9 else None, " ".join(line) + " MIXED-case×word x1"))
    return out


@pytest.mark.parametrize("group,chars", [(4096, 400_000), (6, 300), (2, 10)])
def test_variants_equal_brute_force_however_groups_are_split(spark, monkeypatch, group, chars):
    monkeypatch.setattr(spelling, "INDEX_CHARS", chars)
    monkeypatch.setattr(spelling, "QUESTIONS", 5 if group < 10 else 8192)
    rows = spelled()
    want = expected_variants(rows)
    assert any(w[1] for w in want) and len(want) > 100
    assert sorted(collected(spelling.spelling_variants(documents(spark, rows), group=group)), key=str) == want


def test_variants_of_odd_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents(spark).collect()]
    assert sorted(collected(spelling.spelling_variants(odd_documents(spark))), key=str) == expected_variants(rows)
    assert spelling.spelling_variants(no_documents(spark)).count() == 0
    long = "ab" * 3000
    rows = [(1, f"{long} {long} {long}c {long}c x{long[1:]} x{long[1:]}")]
    assert sorted(collected(spelling.spelling_variants(documents(spark, rows))), key=str) == expected_variants(rows)


def test_forms_are_followed_to_the_last(spark):
    rows = [(i, "wordwords " * 300 + "wordxords " * 30 + "woryxords " * 3) for i in range(1)]
    rows = [(1, " ".join(["wordwords"] * 300 + ["wordxords"] * 30 + ["woryxords"] * 3))]
    got = {r[0]: r for r in collected(spelling.spelling_variants(documents(spark, rows)))}
    assert sorted(got.values(), key=str) == expected_variants(rows)


def test_the_index_finds_words_and_their_neighbours():
    rng = np.random.default_rng(13)
    words = sorted({"".join(rng.choice(list("abc"), rng.integers(1, 7))) for _ in range(300)})
    chars, lengths, letters = spelling._numbered(words)
    for from_left in (True, False):
        at = np.arange(len(words))
        found = {(int(a), int(b)) for q, f in spelling.answers(words, at, lengths, np.zeros(len(words), np.int64), lengths, from_left) for a, b in zip(q, f)}
        pairs = [(a, b) for q, f in spelling.answers(words, at, lengths, np.zeros(len(words), np.int64), lengths, from_left) for a, b in zip(q, f)]
        assert len(pairs) == len(found)  # each pair once
        assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b)}
