"""Quality by importance resampling: hashed n-gram models of good and of all text, their ratio, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import joined_bytes, mix, release, run_hashes, runs, slices, staged

#: Buckets that words and pairs of words are hashed to.
BUCKETS = 10_000
#: Labelled documents that the target model and the cut are fitted on, at most; taken by a hash of their id.
LABELLED = 5_000
#: How much worse it is to lose a good document than to let a bad one pass, when the cut is chosen.
LOSS = 8.0
#: Rows of one bin from which the k-th key is read directly.
DIRECT = 10_000

# Byte classes: 0 parts tokens, 1 is in words, 2 is other signs; a token is a run of one class.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[:33] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = 1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Model(NamedTuple):
    ratio: np.ndarray  # log of target share over raw share, for each bucket
    cut: float  # mean log ratio from which a document counts as target-like
    k: int  # how many documents are
    kth: float  # the smallest key among the chosen
    temperature: float
    seed: int
    held: float  # share of the good labelled documents at or above the cut, each scored without its own counts


def ngrams(texts: list[str | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and every pair of adjacent words; ASCII case is folded, a word twice is one kind of pair."""
    data, begins = joined_bytes(texts)
    classes = _CLASS[data]
    starts, ends = runs(classes, begins)
    words = run_hashes(_FOLD[data], starts, ends)
    text = np.searchsorted(begins, starts, side="right") - 1
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    pairs[words[:-1] == words[1:]] = 0
    adjacent = text[:-1] == text[1:]
    bucket = np.concatenate([words, pairs[adjacent]]) % np.uint64(buckets)
    return np.concatenate([text, text[:-1][adjacent]]), bucket.astype(np.int64)


def mean_ratio(texts: list[str | None], ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of n-grams of each text and their mean log ratio; 0 for a text without any."""
    text, bucket = ngrams(texts, len(ratio))
    n = np.bincount(text, minlength=len(texts))
    total = np.bincount(text, weights=ratio[bucket], minlength=len(texts))
    return n, total / np.maximum(n, 1)


def gumbel(doc_ids: pa.Array, seed: int) -> np.ndarray:
    """A Gumbel draw of each id, the same on every machine; null ids share one."""
    ids = np.asarray(doc_ids.fill_null(-1).cast(pa.int64()), np.int64).astype(np.uint64)
    draw = mix(mix(ids + np.uint64(seed)) + np.uint64(0x9E3779B97F4A7C15))
    return -np.log(-np.log((draw.astype(np.float64) + 0.5) / 2.0**64 * (1 - 2**-50) + 2**-52))


def bucket_counts(docs: DataFrame, text: str, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts: one vector from each task, added up by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                total += np.bincount(ngrams(part.column(0).to_pylist(), buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])
        release()

    summed = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():  # at most `buckets` rows
        out[row["bucket"]] = row["n"]
    return out


def _keyed(docs: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """(doc_id, n_ngrams, score, key) of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                n, mean = mean_ratio(part.column(1).to_pylist(), model.ratio)
                keys = mean / model.temperature + gumbel(part.column(0), model.seed)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (n, mean, keys))], names=["doc_id", "n_ngrams", "score", "key"])
        release()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, "doc_id long, n_ngrams long, score double, key double")


def smooth(counts: np.ndarray) -> np.ndarray:
    return np.log((counts + 0.5) / (counts.sum() + 0.5 * len(counts)))


def held_out_scores(sample: DataFrame, target: np.ndarray, raw: np.ndarray) -> DataFrame:
    """(score, good) of each labelled id, those that are good without their own counts in the target model; the mean over the rows of an id."""
    logs = smooth(raw)
    model = smooth(target) - logs if target.sum() else np.zeros(len(raw))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                texts, good = part.column(0).to_pylist(), np.asarray(part.column(2), bool)
                n, mean = mean_ratio(texts, model)
                for i in np.flatnonzero(good & (n > 0)):
                    own = ngrams([texts[i]], len(raw))[1]
                    bucket, times = np.unique(own, return_counts=True)
                    left = target.sum() - len(own) + 0.5 * len(target)
                    mean[i] = (times * (np.log((target[bucket] - times + 0.5) / left) - logs[bucket])).sum() / len(own)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(mean), pa.array(good)], names=["doc_id", "score", "good"])
        release()

    scored = sample.select("text", "doc_id", (F.col("good") == 1).alias("good")).mapInArrow(score, "doc_id long, score double, good boolean")
    return scored.groupBy("doc_id", "good").agg(F.avg("score").alias("score")).select("score", "good")


def kth_largest(frame: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column, by histograms of ever narrower ranges; -inf for k beyond the rows.

    Only counts of bins come to the driver, and the values of one bin once it has few.
    """
    if k <= 0:
        return float("inf")
    low, high, n = frame.agg(F.min(column), F.max(column), F.count(column)).first()
    if k > n:
        return float("-inf")
    here, left = frame, k
    while n > DIRECT and low < high:
        width = (high - low) / 4096
        place = F.least(F.lit(4095), F.floor((F.col(column) - F.lit(low)) / F.lit(width)))
        bins = {r["b"]: r for r in here.groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()}
        for b in sorted(bins, reverse=True):
            if left <= bins[b]["n"]:
                low, high, n = bins[b]["lo"], bins[b]["hi"], bins[b]["n"]
                break
            left -= bins[b]["n"]
        here = frame.where((F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)))
    if low == high:
        return low
    return sorted((r[0] for r in here.select(column).collect()), reverse=True)[left - 1]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    good: str = "quality",
    buckets: int = BUCKETS,
    labelled: int = LABELLED,
    temperature: float = 0.01,
    seed: int = 7,
) -> tuple[Model, DataFrame]:
    """The model, and the scored documents (written to the shared folder).

    The raw model counts the n-grams of all documents; the target model those of at most `labelled` labelled
    documents that are good. The cut is the mean log ratio that best tells the good from the bad among those
    labelled, each good one scored by the model without its own counts, as an unlabelled one would be; k is the
    number of all documents at or above it. Without labels of both kinds the cut is below all.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chosen = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(good).alias("good")).where("doc_id is not null and good is not null")
    chosen = chosen.groupBy("doc_id").agg(F.max("good").alias("good")).orderBy(F.xxhash64("doc_id", F.lit(seed))).limit(labelled)
    sample = staged(rows.join(F.broadcast(chosen), "doc_id"), "labelled")
    raw = bucket_counts(rows, "text", buckets)
    target = bucket_counts(sample.where("good = 1"), "text", buckets)
    ratio = smooth(target) - smooth(raw) if target.sum() else np.zeros(buckets)
    known = held_out_scores(sample, target, raw).collect()  # a row for each of the labelled ids
    scores, is_good = np.array([r["score"] for r in known]), np.array([r["good"] for r in known], bool)
    cut = best_cut(scores, is_good)
    held = float((scores[is_good] >= cut).mean()) if is_good.any() else 0.0
    model = Model(ratio, cut, 0, float("-inf"), temperature, seed, held)
    scored = staged(_keyed(rows, model, "doc_id", "text"), "scored")
    k = scored.where(F.col("score") >= F.lit(model.cut)).count()
    return model._replace(k=k, kth=kth_largest(scored, "key", k)), scored


def best_cut(scores: np.ndarray, good: np.ndarray, loss: float = LOSS) -> float:
    """Where the share of the bad that falls below, less `loss` times the share of the good that does, is largest."""
    if good.all() or not good.any():
        return float("-inf")
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    lost = np.concatenate([[0], np.cumsum(g)]) / g.sum()
    caught = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    split = np.concatenate([[True], s[1:] != s[:-1], [True]])
    at = int(np.where(split, caught - loss * lost, -np.inf).argmax())
    if at == 0:
        return float("-inf")
    return float("inf") if at == len(s) else float((s[at - 1] + s[at]) / 2)


def resample(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, n_ngrams, score, key) of the documents chosen: the k largest of score / temperature + Gumbel.

    Each document's score is its mean log ratio of target and raw n-gram shares; adding Gumbel noise and taking
    the k largest draws k documents without replacement, in proportion to exp(score / temperature). The draw
    hangs on the id alone, so it is the same on every machine. Rows with the k-th key itself all stay.

    Null and empty texts score 0 and are drawn like others; repeated rows get the same key and go or stay
    together; null ids share one draw. An empty table gives an empty result; other columns are left out.
    """
    model, scored = fit(docs, labels, **options)
    return scored.where(F.col("key") >= F.lit(model.kth))


def keep_chosen(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of the documents chosen, all columns as they came: scores are made again where the rows are, not joined.

    Null and empty texts score 0, repeated rows go or stay together, null ids share one draw; an empty table stays empty.
    """
    model, _ = fit(docs, labels, key, text, **options)
    at, body = docs.columns.index(key), docs.columns.index(text)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, body):
                _, mean = mean_ratio(part.column(body).to_pylist(), model.ratio)
                yield part.filter(pa.array(mean / model.temperature + gumbel(part.column(at), model.seed) >= model.kth))
        release()

    return docs.mapInArrow(chosen, docs.schema)
