"""Shards, importance resampling and the pipeline."""

import zlib

import numpy as np
import pytest
from llm.cases import LONG, ODD, collected, documents, no_documents, odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from spinewise.llm.common import running_offsets
from spinewise.llm.quality import LOSS, best_cut, fit, gumbel, keep_chosen, kth_largest, mean_ratio, ngrams, resample, smooth
from spinewise.llm.sharding import external_shuffle, permutation, shard_digest

MASK = (1 << 64) - 1


def spark_hash(spark, *values):
    return spark.range(1).select(F.xxhash64(*[F.lit(v) for v in values])).first()[0]


def test_a_permutation_is_fisher_yates(spark):
    got = spark.createDataFrame([(n, b) for n in (1, 2, 3, 9, 40) for b in (0, 5)], "n int, b long").select("n", "b", permutation(F.col("n"), F.col("b"), 3).alias("p")).collect()
    for r in got:
        want = list(range(1, r.n + 1))
        for i in range(r.n, 1, -1):
            j = spark.range(1).select(F.pmod(F.xxhash64(F.lit(3), F.lit(r.b).cast("long"), F.lit(i)), F.lit(i).cast("long"))).first()[0] + 1
            want[i - 1], want[j - 1] = want[j - 1], want[i - 1]
        assert r.p == want


@pytest.mark.parametrize("n", [1, 7, 500])
def test_shards_differ_by_one_row_and_have_no_gaps(spark, n):
    df = documents(spark, [(i, f"text {i}" if i % 3 else "the same text") for i in range(n)])
    got = collected(shard_digest(df, 7))
    assert sorted(r[0] for r in got) == list(range(n))
    by = {}
    for r in got:
        by.setdefault(r[4], []).append(r[5])
    sizes = [len(by.get(s, [])) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_the_order_is_seeded_and_does_not_hang_on_partitions(spark):
    df = documents(spark, [(i, f"text {i}") for i in range(300)])
    one = sorted((r.doc_id, r.shard, r.slot) for r in external_shuffle(df, 5, bucket_rows=32).collect())
    other = sorted((r.doc_id, r.shard, r.slot) for r in external_shuffle(df.repartition(9), 5, bucket_rows=32).collect())
    third = sorted((r.doc_id, r.shard, r.slot) for r in external_shuffle(df, 5, seed=1, bucket_rows=32).collect())
    assert one == other != third
    places = [s * 60 + t for _, s, t in one]
    assert abs(np.corrcoef(places, range(300))[0, 1]) < 0.2


def test_shards_of_odd_rows(spark):
    got = sorted(((r[0], r[1], r[2], r[6]) for r in collected(shard_digest(odd_documents(spark), 3))), key=str)
    raw = [(d, (t or "").encode()) for d, t in ODD]
    assert got == sorted(((d, len(b) + 16, zlib.crc32(b), None) for d, b in raw), key=str)
    assert shard_digest(no_documents(spark)).count() == 0
    whole = external_shuffle(odd_documents(spark), 3)
    assert set(whole.columns) == set(odd_documents(spark).columns)


def test_rows_of_which_a_third_are_equal_are_spread_over_the_buckets(spark):
    from spinewise.llm import sharding

    rows = [(i, f"text {i}") for i in range(600)] + [(7, "the same text")] * 300 + [(None, None)] * 40
    df = documents(spark, rows)
    named = df.select(F.xxhash64("doc_id", "text").alias("h"), F.struct("doc_id", "text", "lang").alias("item"))
    spread = sharding._spread_repeats(named, 3, 20)
    assert spread.count() == len(rows) and spread.groupBy(F.pmod("h", F.lit(30)).alias("b")).count().agg(F.max("count")).first()[0] < 60
    one = sorted(((r.doc_id, r.text, r.shard, r.slot) for r in external_shuffle(df, 5, bucket_rows=16).collect()), key=str)
    other = sorted(((r.doc_id, r.text, r.shard, r.slot) for r in external_shuffle(df.repartition(7), 5, bucket_rows=16).collect()), key=str)
    assert one == other and sorted((d, t) for d, t, _, _ in one if d is not None) == sorted(r for r in rows if r[0] is not None)
    by = {s: sorted(x[3] for x in one if x[2] == s) for s in range(5)}
    assert all(v == list(range(188)) for v in by.values())
    hot = [s for d, t, s, _ in one if d == 7 and t == "the same text"]
    assert all(hot.count(s) > 30 for s in range(5))


def test_running_offsets_in_two_levels(spark):
    df = spark.createDataFrame([(i, (i * 7) % 5) for i in range(100) if i % 3], "k long, v long")
    got = dict(collected(running_offsets(df, "k", "v", "o", block=8)))
    want, total = {}, 0
    for i in range(100):
        if i % 3:
            want[i], total = total, total + (i * 7) % 5
    assert got == want


@pytest.mark.parametrize("k", [1, 17, 5000, 29_999, 30_000])
def test_the_kth_largest_is_exact(spark, k, monkeypatch):
    from spinewise.llm import quality

    monkeypatch.setattr(quality, "DIRECT", 50)
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(0.25)).otherwise(F.sin(F.col("id") * 1.7) * F.pow(F.lit(10.0), F.col("id") % 7)).alias("x"))
    values = sorted((r.x for r in df.collect()), reverse=True)
    assert kth_largest(df, "x", k) == values[k - 1]
    assert kth_largest(df, "x", 30_001) == float("-inf") and kth_largest(df, "x", 0) == float("inf")


def test_the_cut_weighs_lost_documents():
    scores, good = np.array([0.0, 1.0, 2.0, 3.0]), np.array([False, False, True, True])
    assert best_cut(scores, good) == 1.5
    mixed = np.array([False, True, False, True])
    losses = {c: (np.array(mixed)[scores < c].sum() * LOSS / 2) - ((~mixed)[scores < c].sum() / 2) for c in (-1, 0.5, 1.5, 2.5)}
    assert best_cut(scores, mixed) == min(losses, key=losses.get) == 0.5
    assert best_cut(scores, np.ones(4, bool)) == float("-inf")


def test_ngrams_are_of_one_text_each_and_of_whole_texts():
    text, bucket = ngrams(["One two", None, "", "two three two", LONG], 1 << 30)
    assert [int((text == i).sum()) for i in range(5)] == [3, 0, 0, 5, 2 * 24_000 - 1]
    alone = ngrams(["ONE  two"], 1 << 30)[1]
    assert sorted(alone) == sorted(bucket[text == 0])


def corpus(n=400):
    rng = np.random.default_rng(4)
    words = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(n):
        own = [words[j] for j in rng.integers(0, 60, rng.integers(5, 80))]
        bad = i % 4 == 0
        rows.append((i, " ".join(w + "***" for w in own) if bad else " ".join(own)))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_resampling_tells_held_out_documents_apart(spark):
    rows, labels = corpus()
    df, known = documents(spark, rows), spark.createDataFrame(labels[:200], "doc_id long, quality int, toxic int")
    got = {r.doc_id for r in resample(df, known).collect()}
    held = range(200, 400)
    assert {i for i in held if i % 4} <= got and not {i for i in held if i % 4 == 0} & got
    kept = keep_chosen(df, known)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(got)


def test_resampling_equals_a_plain_version(spark):
    rows, labels = corpus(120)
    df, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    texts = [t for _, t in rows]
    text, bucket = ngrams(texts)
    counts = lambda b: np.log((np.bincount(b, minlength=10_000) + 0.5) / (len(b) + 5000))
    good = np.array([q for _, q, _ in labels]) == 1
    ratio = counts(bucket[good[text]]) - counts(bucket)
    mean = mean_ratio(texts, ratio)[1]
    k = int((mean >= best_cut(mean, good)).sum())
    import pyarrow as pa

    keys = mean / 0.01 + gumbel(pa.array([d for d, _ in rows]), 7)
    want = sorted(np.argsort(-keys)[:k].tolist())
    assert sorted(r.doc_id for r in resample(df, known).collect()) == want


def test_the_cut_is_made_on_documents_left_out_of_the_model(spark):
    """Few labels and many words: the good ones score as unlabelled ones do, and those are kept."""
    rng = np.random.default_rng(5)
    text = lambda kind: " ".join(f"{kind}{j}" for j in rng.integers(0, 3000, 60))
    rows = [(i, text("bad" if i % 4 == 0 else "good")) for i in range(1200)]
    labels = [(i, int(i % 4 > 0), 0) for i in range(60)]
    df, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model, scored = fit(df, known)
    clean = [r.score for r in scored.where("doc_id >= 60 and doc_id % 4 > 0").collect()]
    # Plain version: the model fitted anew without each good document.
    texts = [t for _, t in rows]
    raw = smooth(np.bincount(ngrams(texts)[1], minlength=10_000))
    good = [i for i in range(60) if i % 4]
    target = lambda ids: np.bincount(ngrams([texts[i] for i in ids])[1], minlength=10_000)
    want = [mean_ratio([texts[i]], smooth(target([j for j in good if j != i])) - raw)[1][0] for i in good]
    bad = mean_ratio([texts[i] for i in range(0, 60, 4)], smooth(target(good)) - raw)[1]
    cut = best_cut(np.array([*want, *bad]), np.array([True] * len(want) + [False] * len(bad)))
    assert model.cut == pytest.approx(cut) and model.held == np.mean(np.array(want) >= model.cut)
    assert np.mean(np.array(clean) >= model.cut) >= 0.95


def test_gumbel_draws_have_the_right_mean_and_spread():
    import pyarrow as pa

    draws = gumbel(pa.array(range(100_000)), 7)
    assert abs(draws.mean() - 0.5772) < 0.02 and abs(draws.std() - np.pi / np.sqrt(6)) < 0.02


def test_resampling_of_odd_rows(spark):
    known = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 1, None), (3, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    got = resample(odd_documents(spark), known)
    assert 0 < got.count() <= len(ODD)
    assert resample(odd_documents(spark), known.limit(0)).count() == len(ODD)
    assert resample(no_documents(spark), known).count() == 0 and keep_chosen(no_documents(spark), known).count() == 0


def test_a_labelled_id_with_very_many_rows_is_one_row_on_the_driver(spark):
    from spinewise.llm import quality

    rows = [(1, f"good words number {i}") for i in range(300)] + [(i, f"bad stuff {i}") for i in range(2, 40)] + [(1, "good words")] * 100
    sample = documents(spark, rows, extra=False).withColumn("good", (F.col("doc_id") == 1).cast("int"))
    counts = quality.bucket_counts(sample, "text", 500)
    target = quality.bucket_counts(sample.where("good = 1"), "text", 500)
    known = quality.held_out_scores(sample, target, counts).collect()
    assert len(known) == 39 and [r["good"] for r in known].count(True) == 1
    labels = spark.createDataFrame([(i, int(i == 1), 0) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    kept = keep_chosen(documents(spark, rows), labels)
    assert kept.where("doc_id = 1").count() == 400


def test_the_pipeline_stage_by_stage(spark, tmp_path):
    """Every stage works on all that the one before kept, and its decisions take effect."""
    from llm.test_jaccard import brute

    rows, labels = corpus()
    rows += [(1000, rows[1][1]), (1001, rows[5][1] + " token=abcdefgh12345678"), (1002, None), (1003, "")]
    sf = str(tmp_path)
    documents(spark, rows, extra=False).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "n-gram Jaccard join", "secret scans", "packing"]
    chosen = stages["quality classifier"](spark, docs, sf)
    assert chosen.columns == columns
    kept = {r.doc_id: r.text for r in chosen.collect()}
    assert {i for i in range(400) if i % 4} | {1000, 1001} <= set(kept) and not any(i % 4 == 0 for i in kept if i < 400)
    unique = stages["n-gram Jaccard join"](spark, chosen, sf)
    assert unique.columns == columns
    assert sorted(r.doc_id for r in unique.collect()) == sorted({c for _, _, c in brute(list(kept.items()), 5, 80, 100)})
    clean = stages["secret scans"](spark, unique, sf)
    assert clean.columns == columns and clean.count() == unique.count()
    assert not clean.where("text like '%abcdefgh12345678%' or n_chars <> length(text)").count()
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}
    sizes = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).orderBy("sequence_id").collect()
    assert all(r.n == 2048 for r in sizes[:-1]) and sizes[-1].n <= 2048


def test_the_pipeline_takes_odd_rows(spark, tmp_path):
    sf = str(tmp_path)
    documents(spark, ODD, extra=False).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() > 0
    empty = f"{sf}/empty"
    documents(spark, [], extra=False).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_every_operator_has_one_query():
    from __spark_entry__ import queries

    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries()
