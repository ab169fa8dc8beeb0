"""The corpus pipeline: quality, near duplicates, secrets, packing. Each stage reads what the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spinewise.llm.common import read, staged
from spinewise.llm.ngram_join import one_of_each
from spinewise.llm.packing import pack
from spinewise.llm.quality import keep_chosen
from spinewise.llm.queries import vocabulary
from spinewise.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling chooses; the rest go."""
    return keep_chosen(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id. Five-word shingles, a Jaccard of 0.8."""
    return one_of_each(docs, n=5, num=80, den=100)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and their lengths counted anew."""
    return redact_secrets(docs, length="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids, with the ids."""
    return pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


#: The classifier, the join and the tokens are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
CHECKS: dict[str, str] = {}
