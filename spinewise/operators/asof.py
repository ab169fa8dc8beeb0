"""The record valid at a date, with or without gaps filled from older records.

A spine of no more rows than a fixed bound is broadcast and met by the records where they are read, so
records of other people and later ones go before anything is shuffled. With a larger spine the history is
collapsed to one candidate per person and day before the join, so that a person with a very long history
sends no more rows than there are days. The candidate of a day is exact because the anchor is a date: a
record counts for the first midnight at or after it.

A spine holds a person once; a second row of one fails the job, as it does in linking. People with several anchors (waves,
index dates) name them as columns of their one row, and one read of the history serves all (``asof_waves``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spinewise.functions.dates import ceil_day
from spinewise.functions.missing import col
from spinewise.operators.link import checked_unique
from spinewise.operators.windowed import fits


def _newest_first(df: DataFrame, start: str) -> Column:
    """A number that falls as the start rises, so that a minimum finds the newest record."""
    if dict(df.dtypes)[start] == "date":
        return -F.unix_date(start)
    return -F.unix_micros(F.col(start).cast("timestamp"))


def _ready(history: DataFrame, key: str, start: str) -> DataFrame:
    return history.where(F.col(key).isNotNull() & F.col(start).isNotNull()).withColumn(
        "_day", ceil_day(start)
    )


def _until_last(history: DataFrame, spine: DataFrame, start: str, anchors: Mapping[str, str]) -> DataFrame:
    """Leave out records later than every anchor; the bound is a scalar subquery and reaches the scan."""
    dtype = dict(history.dtypes)[start]
    last = spine.agg(F.max(_last_anchor(anchors))).scalar()
    return history.where(F.col(start) <= (last.cast(dtype) if dtype.startswith("timestamp") else last))


def _anchors(spine: DataFrame, spine_key: str, anchors: Mapping[str, str]) -> DataFrame:
    """_person, _wave, _anchor: a row for each anchor that a person has; a second spine row of a person fails the job."""
    dated = [F.struct(F.lit(name).alias("_wave"), F.col(c).cast("date").alias("_anchor")) for name, c in anchors.items()]
    people = checked_unique(spine.select(spine_key, *dict.fromkeys(c for c in anchors.values() if c != spine_key)), spine_key, "spine")
    return people.select(F.col(spine_key).alias("_person"), F.inline(F.array(*dated))).where(F.col("_anchor").isNotNull())


def _at_anchor(daily: DataFrame, spine: DataFrame, key: str, spine_key: str, anchors: Mapping[str, str], small: bool = False) -> DataFrame:
    found = _anchors(spine, spine_key, anchors)
    return daily.join(
        F.broadcast(found) if small else found,
        (F.col(key) == F.col("_person")) & (F.col("_day") <= F.col("_anchor")),
        "inner",
    )


def _last_anchor(anchors: Mapping[str, str]) -> Column:
    dates = [F.col(c).cast("date") for c in anchors.values()]
    return F.greatest(*dates) if len(dates) > 1 else dates[0]


def asof_record(
    history: DataFrame,
    spine: DataFrame | None,
    key: str,
    start: str,
    anchor: str,
    columns: Sequence[str],
    tiebreak: Sequence[str] = (),
    spine_key: str | None = None,
) -> DataFrame:
    """Per person, the columns of the latest record starting on or before the anchor date.

    With ``spine`` None the anchor is a column of the history itself.
    Among records with the same start the lowest ``tiebreak`` wins, then the lowest values of the
    columns themselves, so that the result never depends on the order of the file.
    """
    return asof_filled(history, spine, key, start, anchor, columns, tiebreak, columns, spine_key)


def asof_filled(
    history: DataFrame,
    spine: DataFrame | None,
    key: str,
    start: str,
    anchor: str,
    columns: Sequence[str],
    tiebreak: Sequence[str] = (),
    exempt: Sequence[str] = (),
    spine_key: str | None = None,
) -> DataFrame:
    """As ``asof_record``, a gap in the latest record filled from the next older one that is known.

    Columns named in ``exempt`` are taken from the latest record as they are.
    """
    ready = _ready(history, key, start)
    if spine is None:
        best, kept = _best(history, start, columns, tiebreak, exempt)
        found = ready.where(F.col("_day") <= F.col(anchor).cast("date")).groupBy(key).agg(*best)
        return found.select(key, *_picked(columns, exempt))
    found = _newest_at(history, ready, spine, key, start, {"": anchor}, columns, tiebreak, exempt, spine_key or key)
    return found.select(key, *_picked(columns, exempt))


def _best(history: DataFrame, start: str, columns: Sequence[str], tiebreak: Sequence[str], exempt: Sequence[str]) -> tuple[list[Column], list[str]]:
    """The newest known value of each column, and the exempt ones of the newest record; their names."""
    rank = [_newest_first(history, start).alias("_age")]
    for t in tiebreak:  # a minimum takes null first, and a missing tiebreak is to lose
        rank += [F.col(t).isNull().alias(f"_no_{t}"), F.col(t).alias(f"_tie_{t}")]
    filled = [c for c in columns if c not in exempt]
    best = [F.min(F.when(F.col(c).isNotNull(), F.struct(*rank, F.col(c)))).alias(f"_fill_{c}") for c in filled]
    if exempt:
        best.append(F.min(F.struct(*rank, *[F.col(c) for c in exempt])).alias("_latest"))
    return best, [f"_fill_{c}" for c in filled] + (["_latest"] if exempt else [])


def _picked(columns: Sequence[str], exempt: Sequence[str]) -> list[Column]:
    return [F.col(f"_latest.{c}") if c in exempt else F.col(f"_fill_{c}.{c}") for c in columns]


def _newest_at(history, ready, spine, key, start, anchors, columns, tiebreak, exempt, spine_key) -> DataFrame:
    """The newest values of each person at each anchor: key, _wave, and a candidate for each column."""
    best, kept = _best(history, start, columns, tiebreak, exempt)
    bounded = _until_last(ready, spine, start, anchors)
    if fits(spine, spine_key):
        return _at_anchor(bounded, spine, key, spine_key, anchors, small=True).groupBy(key, "_wave").agg(*best)
    near = _at_anchor(bounded.groupBy(key, "_day").agg(*best), spine, key, spine_key, anchors)
    return near.groupBy(key, "_wave").agg(*[F.min(c).alias(c) for c in kept])


def asof_waves(
    history: DataFrame,
    spine: DataFrame,
    key: str,
    start: str,
    anchors: Mapping[str, str],
    columns: Sequence[str],
    tiebreak: Sequence[str] = (),
    exempt: Sequence[str] | None = None,
    spine_key: str | None = None,
) -> DataFrame:
    """Per person, the columns of the latest record at each of several anchors, side by side, from one read of the history.

    ``anchors`` maps a suffix to the spine column with the anchor date: column ``c`` at the anchor with suffix
    ``_w2`` is ``c_w2``. A person appears with a record at any anchor; the columns of the others are null. ``exempt``
    columns are those of the latest record as it is, all of them by default; gaps in the others are filled from older ones.
    """
    exempt = columns if exempt is None else exempt
    ready = _ready(history, key, start)
    found = _newest_at(history, ready, spine, key, start, anchors, columns, tiebreak, exempt, spine_key or key)
    long = found.select(key, "_wave", F.struct(*[p.alias(c) for p, c in zip(_picked(columns, exempt), columns)]).alias("_record"))
    # A person has one row for each anchor at most.
    wide = long.groupBy(key).agg(*[F.any_value(F.when(F.col("_wave") == w, F.col("_record")), True).alias(f"_at{i}") for i, w in enumerate(anchors)])
    return wide.select(key, *[F.col(f"_at{i}.{c}").alias(c + w) for i, w in enumerate(anchors) for c in columns])


def asof_ties(
    history: DataFrame,
    spine: DataFrame | None,
    key: str,
    start: str,
    anchor: str | Mapping[str, str],
    columns: Sequence[str],
    spine_key: str | None = None,
    wave: str = "wave",
) -> DataFrame:
    """Per person, every record sharing the latest start on or before the anchor date.

    With ``spine`` None the anchor is a column of the history itself. Several anchors, given as names and columns of the
    spine, are met in one read, and a column ``wave`` tells which one a record was found at.
    """
    ready = _ready(history, key, start)
    several = not isinstance(anchor, str)
    if spine is None:
        if several:
            raise ValueError("several anchors are columns of a spine")
        valid = ready.where(F.col("_day") <= F.col(anchor).cast("date")).withColumn("_wave", F.lit(""))
    else:
        anchors = dict(anchor) if several else {"": anchor}
        bounded = _until_last(ready, spine, start, anchors)
        valid = _at_anchor(bounded, spine, key, spine_key or key, anchors, fits(spine, spine_key or key))
    # Spark keeps the first rank of every task's rows before it shuffles them.
    newest = Window.partitionBy(key, "_wave").orderBy(F.desc(start))
    ranked = valid.withColumn("_rank", F.rank().over(newest)).where("_rank = 1")
    return ranked.select(key, *([F.col("_wave").alias(wave)] if several else []), *columns)


def latest_filled(
    df: DataFrame,
    key: str,
    order: str,
    columns: Sequence[str],
    tiebreak: Sequence[Column | str] = (),
) -> DataFrame:
    """Per entity, the newest known value of each column; a missing ``order`` counts as newest."""
    rank = [F.col(order).isNull().alias("_undated"), F.col(order).alias("_order")]
    rank += [col(t).alias(f"_tie{i}") for i, t in enumerate(tiebreak)]
    best = [F.max(F.when(F.col(c).isNotNull(), F.struct(*rank, F.col(c)))).alias(f"_fill_{c}") for c in columns]
    return df.groupBy(key).agg(*best).select(key, *[F.col(f"_fill_{c}.{c}") for c in columns])
