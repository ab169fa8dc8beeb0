"""The n-gram join against brute force, and the guarantees that it rests on."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm.cases import ODD, collected, documents, no_documents, odd_documents

from spinewise.llm import ngram_join
from spinewise.llm.components import components, forest
from spinewise.llm.ngram_join import Levels, SignatureTree, jaccard_components, one_of_each, shingle_sets


def brute(rows, n=4, num=85, den=100):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((d, len(sets[i]), (min(ids) if ids else None) if sets[i] else d))
    return sorted(out, key=str)


def copies(seed, groups=12, size=9, words=60):
    """Texts with copies of a few changed words, near and beyond the threshold, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    rows = []
    for _ in range(groups):
        length = rng.choice([5, 8, 12, 30, words, 3 * words])
        base = [rng.choice(vocabulary) for _ in range(length)]
        if rng.random() < 0.5:
            base = base[: length // 2] + passage + base[length // 2 :]
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                own = own[: -rng.randint(1, 3)]
            rows.append((len(rows) * 3, " ".join(own)))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_components_equal_brute_force(spark, seed):
    rows = copies(seed)
    assert sorted(collected(jaccard_components(documents(spark, rows))), key=str) == brute(rows)


@pytest.mark.parametrize("n,num,den", [(5, 80, 100), (1, 50, 100)])
def test_other_lengths_and_thresholds(spark, n, num, den):
    rows = copies(9)
    assert sorted(collected(jaccard_components(documents(spark, rows), n, num, den)), key=str) == brute(rows, n, num, den)


@pytest.mark.parametrize("sketch_sets", [3, 4096])
def test_large_candidate_components_are_done_by_pairs_of_blocks(spark, monkeypatch, sketch_sets):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 5)
    monkeypatch.setattr(ngram_join, "SKETCH_SETS", sketch_sets)
    rows = copies(2, groups=4, size=40)
    assert sorted(collected(jaccard_components(documents(spark, rows))), key=str) == brute(rows)


def test_small_flushes_and_leaves_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FLUSH", 20)
    monkeypatch.setattr(ngram_join, "LEAF", 2)
    rows = copies(3)
    assert sorted(collected(jaccard_components(documents(spark, rows).repartition(5))), key=str) == brute(rows)


def test_odd_rows(spark):
    got = sorted(collected(jaccard_components(odd_documents(spark))), key=str)
    assert got == brute(ODD)
    assert jaccard_components(no_documents(spark)).count() == 0


def test_one_of_each_group_stays_with_all_columns(spark):
    rows = copies(5)
    df = documents(spark, [*rows, rows[0], (None, "nobody's text")])
    kept = one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*{c for _, _, c in brute(rows)}, None], key=str)
    assert one_of_each(no_documents(spark)).count() == 0


def test_one_of_each_group_stays_where_ids_are_missing_or_repeated(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (None, a), (None, b + " b"), (None, c), (None, c), (9, None), (9, None), (8, ""), (None, None), (3, b)]
    df = documents(spark, rows).withColumns({x: F.lit("x") for x in ("_hash", "id", "print", "row", "_id", "_print", "root", "first")})
    kept = one_of_each(df)
    assert kept.columns == df.columns
    want = [(1, a), (2, b), (None, c), (9, None), (8, ""), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("num,den", [(85, 100), (80, 100), (1, 2)])
def test_linked_sets_share_a_signature(num, den):
    rng, levels = np.random.default_rng(7), Levels(num, den)
    for _ in range(1500):
        a = int(rng.integers(1, 300))
        b = int(rng.integers(a, a * den // num + 1))
        least = -(-num * (a + b) // (num + den))
        if least > a:
            continue
        common = int(rng.integers(least, a + 1)) if rng.random() < 0.3 else least
        items = rng.integers(0, 1 << 64, a + b - common, dtype=np.uint64)
        one, other = np.sort(items[:a]), np.sort(np.concatenate([items[:common], items[a:]]))
        if len(one) == len(other) == common:
            continue  # equal sets are one node
        assert np.intersect1d(levels.signatures(one), levels.signatures(other)).size, (a, b, common)


@pytest.mark.parametrize("seed", range(3))
def test_a_signature_tree_connects_all_linked_sets(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 1 << 64, int(rng.integers(4, 120)), dtype=np.uint64)
        for _ in range(int(rng.integers(1, 9))):
            drop = rng.random(len(base)) > 0.05
            sets.append(np.unique(base[drop] if drop.any() else base))
    links = SignatureTree.of(sets, 85, 100).links()
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                label = [label[j] if x == label[i] else x for x in label]
    own = list(range(len(sets)))
    for i, j in links:
        own = [own[j] if x == own[i] else x for x in own]
    same = lambda x: [[p == q for q in x] for p in x]
    assert same(own) == same(label) and len(links) == len(sets) - len(set(label))


@pytest.mark.parametrize("bits", [1, 2, 4])
def test_bitmaps_alone_rule_out_no_link(bits):
    rng = np.random.default_rng(bits)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 1 << 64, int(rng.integers(6, 900)), dtype=np.uint64)
        sets += [np.unique(base[rng.random(len(base)) > 0.07]) for _ in range(4)]
    sets = [s for s in sets if len(s)]
    bitmaps = [ngram_join._bitmap(s, ngram_join._width(len(s), bits)) for s in sets]
    tree = SignatureTree(np.array([len(s) for s in sets]), bitmaps, np.array([s[0] for s in sets]), None, 85, 100, 8)
    label = list(range(len(sets)))
    for i, j in tree.links():
        label = [label[j] if x == label[i] else x for x in label]
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                assert label[i] == label[j]


def test_a_tree_leaves_out_what_cannot_link():
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.integers(0, 1 << 64, 200, dtype=np.uint64)) for _ in range(400)]
    tree = SignatureTree.of(sets, 85, 100)
    seen = []
    tree._compare = lambda *a: seen.append(a)
    assert tree.links() == [] and len(seen) <= 3 * len(sets) / ngram_join.LEAF


def test_words_are_of_whole_texts_and_fold_ascii_only():
    one, other, third = shingle_sets(["A b c d\x0be É", "a B c D e É", "a b c d e é"], 4)
    assert one.tolist() == other.tolist() and one.tolist() != third.tolist()


@pytest.mark.parametrize("seed", range(3))
def test_components_of_links(spark, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-50, 50, 45), rng.integers(-50, 50, 45)
    chain = np.arange(100, 160)
    a, b = np.concatenate([a, chain]), np.concatenate([b, chain + 1])
    label = {n: n for n in [*a.tolist(), *b.tolist()]}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        low, high = sorted((label[x], label[y]))
        label = {n: low if v == high else v for n, v in label.items()}
    linked = {n for x, y in zip(a.tolist(), b.tolist(), strict=True) if x != y for n in (x, y)}
    node, root = forest(a, b)
    assert {**{n: n for n in label}, **dict(zip(node.tolist(), root.tolist(), strict=True))} == label
    links = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), strict=True)), "a long, b long")
    assert dict(collected(components(links))) == {n: label[n] for n in linked}
    assert components(links.limit(0)).count() == 0


def test_signatures_are_sent_in_small_batches():
    levels = ngram_join.Levels(80, 100)
    hashes = np.unique(ngram_join.mix(np.arange(1, 2 * ngram_join.SENT, dtype=np.uint64)))
    sets = [hashes[i : i + 4000] for i in range(0, len(hashes) - 4000, 3999)] * 4
    found = [(levels.signatures(s), ngram_join.node_of(s)) for s in sets]
    whole, parts = ([*ngram_join.signature_rows(iter(found), most)] for most in (1 << 40, ngram_join.SENT))
    assert len(whole) == 1 and sum(len(f[0]) for f in found) > ngram_join.SENT
    assert max(b.num_rows for b in parts) <= ngram_join.SENT + 2 * max(len(f[0]) for f in found)
    pairs = lambda batches: {(s, a) for b in batches for s, a, x in zip(*b.to_pydict().values(), strict=True) if x == 0}
    assert pairs(parts) == pairs(whole)
