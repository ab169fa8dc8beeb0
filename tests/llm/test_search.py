"""Exact and approximate search against brute force."""

import numpy as np
import pytest
from llm.cases import collected, vectors

from spinewise.llm.curves import hilbert_keys, nearest, scored_pairs
from spinewise.llm.topk import BallTree, exact_top_k

NAN, INF = float("nan"), float("inf")


def rows_of(x):
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def exact(rows, k, step, scale=None):
    """Brute force; with a scale, of integer products."""
    ok = [(i, v) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in ok]
    if scale:
        ok = [(i, np.floor(v * scale)) for i, v in ok]
    out = {}
    for q, v in ok:
        if q % step == 0:
            scores = sorted((-float(v @ w), i) for i, w in ok if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def by_query(df):
    out = {}
    for q, rank, i, score in sorted(collected(df)):
        out.setdefault(q, []).append((i, score))
        assert rank == len(out[q])
    return out


@pytest.mark.parametrize("shard_rows,query_block", [(4096, 4096), (40, 4096), (40, 5)])
def test_top_k_is_exact_over_shards_and_blocks(spark, shard_rows, query_block):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(150, 8)), np.tile(rng.normal(size=8), (60, 1)), rng.normal(size=(90, 8)).round(1)])
    rows = rows_of(x)
    got = by_query(exact_top_k(vectors(spark, rows), 7, 10, shard_rows=shard_rows, query_block=query_block))
    assert got == exact(rows, 7, 10, 64)


ODD = [(0, [1.0, 0.5]), (20, [0.25, -2.0]), (1, [0.1, 0.1]), (2, [0.1, 0.1]), (3, None), (4, [NAN, 1.0]), (5, [INF, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (7, [-1.0, -1.0]), (60, []), (80, None)]


def test_odd_vectors_take_no_part(spark):
    got = by_query(exact_top_k(vectors(spark, ODD), 20, 20))
    assert got == {q: v for q, v in exact(ODD, 20, 20, 64).items() if v}
    near = by_query(nearest(vectors(spark, [*ODD, (100, [0.0, 0.0])])))
    assert {q: [i for i, _ in v] for q, v in near.items()} == {q: [i for i, _ in v] for q, v in exact(ODD, 20, 20).items() if v}


def test_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0])]
    assert by_query(exact_top_k(vectors(spark, rows), 3, 20))[0] == [(1, 4096), (1, 4096), (2, 2048)]
    assert by_query(nearest(vectors(spark, rows)))[0] == [(1, 1.0), (2, 0.5)]
    assert exact_top_k(vectors(spark, [])).count() == 0
    assert nearest(vectors(spark, [])).count() == 0


@pytest.mark.parametrize("shard_rows", [4096, 300])
def test_ties_of_negative_scores_go_to_the_smaller_ids(spark, shard_rows):
    """Equal vectors over many leaves, all scoring -2,000,000; a bound rounded towards zero would lose the first ids."""
    rows = [(0, [1000.0 / 64, 0.0])] + [(i, [-2000.0 / 64, float(i % 3 == 0)]) for i in [*range(101, 1601), *range(3001, 4501)] if i % 20]
    got = by_query(exact_top_k(vectors(spark, rows), 20, 20, shard_rows=shard_rows))
    assert got == exact(rows, 20, 20, 64)
    assert got[0][0] == (101, -2_000_000)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_are_never_below_a_score(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(2000, 6)) * 10 ** rng.integers(0, 7) - 10 ** rng.integers(0, 7))
    q = np.floor(rng.normal(size=(5, 6)) * 10 ** rng.integers(0, 5))
    tree = BallTree(x, np.arange(len(x)))
    query, row, score = tree.search(q, np.full(5, -1), np.full(5, -np.inf), 30)
    for i in range(5):
        want = sorted(range(len(x)), key=lambda j: (-(q[i] @ x[j]), j))[:30]
        assert sorted(tree.ids[row[query == i]], key=lambda j: (-(q[i] @ x[j]), j)) == want


@pytest.mark.parametrize("parts", [1, 7])
def test_a_query_id_with_several_vectors_asks_with_all_of_them(spark, parts):
    rng = np.random.default_rng(9)
    rows = rows_of(rng.normal(size=(80, 4)).round(1)) + [(20, [2.0, 0.0, 0.0, 0.0]), (20, [0.0, 3.0, 0.0, 0.0]), (20, [0.0, 3.0, 0.0, 0.0]), (7, [1.0, 1.0, 1.0, 1.0])]
    got = by_query(exact_top_k(vectors(spark, rows).repartition(parts), 9, 20, shard_rows=25))
    x = [(i, np.floor(np.array(v, np.float32).astype(float) * 64)) for i, v in rows]
    for q in {i for i, _ in rows if i % 20 == 0}:
        best = sorted((-max(float(v @ w) for i, v in x if i == q), j) for j, w in x if j != q)
        assert got[q] == [(j, -s) for s, j in best[:9]]


def test_an_id_with_a_third_of_all_rows_is_spread_over_the_shards(spark):
    rng = np.random.default_rng(10)
    rows = rows_of(rng.normal(size=(300, 4)).round(1)) + [(7, [0.5, 0.5, 0.5, 0.5])] * 150
    assert by_query(exact_top_k(vectors(spark, rows), 5, 20, shard_rows=30)) == exact(rows, 5, 20, 64)


def test_a_ball_tree_leaves_nodes_out():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(500, 4)) * 0.1 + 5, rng.normal(size=(3000, 4)) * 0.1 - 5])
    tree = BallTree(x, np.arange(len(x)))
    seen = []
    merge = tree._merge
    tree._merge = lambda best, rows, q, scores, lo, hi: (seen.append((lo, hi)), merge(best, rows, q, scores, lo, hi))
    query, row, score = tree.search(x[:3], np.arange(3), np.full(3, -np.inf), 5)
    want = [sorted(range(len(x)), key=lambda i: (i == q, -(x[q] @ x[i]), i))[:5] for q in range(3)]
    got = [sorted(tree.ids[row[query == q]], key=lambda i: -(x[q] @ x[i])) for q in range(3)]
    assert [list(g) for g in got] == want
    assert sum(hi - lo for lo, hi in set(seen)) < len(x) / 2


@pytest.mark.parametrize("columns,bits", [(2, 4), (3, 3)])
def test_a_hilbert_curve_visits_each_cell_once_and_steps_to_neighbours(columns, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * columns, indexing="ij"), -1).reshape(-1, columns)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_recall_and_scores_of_the_curves(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 64)) * rng.uniform(0.5, 2, (1500, 1))
    rows = rows_of(x)
    got, want = by_query(nearest(vectors(spark, rows), query_step=50)), exact(rows, 20, 50)
    assert set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    y = x.astype(np.float32).astype(float)
    assert all(abs(score - y[q] @ y[i]) < 1e-9 for q in got for i, score in got[q])


def test_narrow_windows_find_more_than_random_ones_and_score_less_than_half(spark):
    """Neighbours as near as those of large tables: windows of one percent of the rows on many curves."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 32))
    x = centres[rng.integers(0, 60, 6000)] + 1.2 * rng.normal(size=(6000, 32))
    x /= np.sqrt((x**2).sum(1))[:, None]
    rows = rows_of(x)
    got, want = by_query(nearest(vectors(spark, rows), query_step=100, curves=24, share=0.005, least=10)), exact(rows, 20, 100)
    hits = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    scored, random = 24 * 2 * 0.005, 1 - (1 - 2 * 0.005) ** 24
    assert scored < 0.25 and hits > 0.6 > 2 * random


@pytest.mark.parametrize("r,n", [(5, 300), (40, 300), (1000, 300)])
def test_what_is_scored_is_little_more_than_the_windows(r, n):
    at = np.arange(n)
    pos = np.arange(0, n, 7)
    seen = np.zeros((len(pos), n), bool)
    for some, window in scored_pairs(pos, at, r):
        assert not seen[some, window].any()
        seen[some, window] = True
    inside = np.abs(pos[:, None] - at) <= r
    assert seen[inside].all() and seen.sum() <= inside.sum() * 1.15 + len(pos)


def test_wide_windows_over_many_blocks(spark, monkeypatch):
    from spinewise.llm import curves

    monkeypatch.setattr(curves, "BLOCK", 64)
    monkeypatch.setattr(curves, "GROUP", 200)
    rng = np.random.default_rng(12)
    rows = rows_of(rng.normal(size=(900, 8)))
    for share in (0.01, 1.0):
        got = by_query(nearest(vectors(spark, rows), query_step=50, curves=3, columns=4, share=share, least=5))
        if share == 1.0:
            assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in exact(rows, 20, 50).items()}
        else:
            assert set(got) == set(exact(rows, 20, 50))


def exact_by_id(rows, k, step):
    """Brute force, an id counted once by its best row."""
    x = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, v in x:
        if q % step == 0:
            best = out.setdefault(q, {})
            for i, w in x:
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float(v @ w))
    return {q: sorted(best, key=lambda i: (-best[i], i))[:k] for q, best in out.items()}


@pytest.mark.parametrize("noise", [0.0, 0.001])
def test_repeats_of_a_good_row_take_one_place(spark, noise):
    """25 rows of one id, alike or nearly so, that are the best for every query."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 8)) + 2
    best = np.full(8, 9.0)
    rows = rows_of(x) + [(1001, [float(c) for c in best + noise * rng.normal(size=8)]) for _ in range(25)]
    got, want = by_query(nearest(vectors(spark, rows), query_step=50, share=1.0)), exact_by_id(rows, 20, 50)
    assert {q: [i for i, _ in v] for q, v in got.items()} == want
    assert all(len(v) == 20 and v[0][0] == 1001 for v in got.values())
    lookup = {}
    for i, v in rows:
        lookup.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    assert all(abs(score - max(lookup[q][0] @ w for w in lookup[i])) < 1e-9 for q in got for i, score in got[q])


def test_an_id_with_a_third_of_all_rows_uses_up_no_window(spark):
    rng = np.random.default_rng(7)
    rows = rows_of(rng.normal(size=(1000, 16)))
    plain = by_query(nearest(vectors(spark, rows), query_step=50))
    assert by_query(nearest(vectors(spark, rows + [rows[1]] * 500), query_step=50)) == plain
