"""Event measures per person in date windows around the person's own anchor dates.

All windows and measures come out of one read of the events. How the work is laid out:

* a spine of no more rows than a fixed bound is counted, broadcast, and met by the events where they are
  read: people outside it and days in no window go before anything is shuffled, and one aggregate by
  person, combined on the map side, fills all windows;
* with a larger spine the events are first collapsed to one row per person and day. Every measure except
  distinct counts is a sum over days, so the collapse is exact, it combines on the map side, and it bounds
  what one person can send to the join by the number of days in the data, however many events they hold.
  Its first and last key reach the scan, and as that makes the spine selective in Spark's eyes, Spark may send
  a Bloom filter of its keys to the scan as well, so that most other people go before the collapse;
* a distinct count adds its value to the rows: the groups are person and value, which spreads a person
  with very many values, and the sums of the other measures ride along. There is no second pass;
* where an estimate will do, a sketch takes the place of the values and is summed like the rest.

The collapsed rows can be kept (``day_partials``): further events are added to them, and any windows are answered
from them without the events.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.functions.missing import col
from spinewise.operators.link import checked_unique

#: Rows up to which a spine is broadcast; a row is a key and a few dates.
SMALL_SPINE = 500_000
#: Size of a sketch, as a power of two; the relative standard error falls with its root.
SKETCH_SIZE = 14


@dataclass(frozen=True)
class Span:
    """A window ``start <= day <= end``; columns are those of the spine.

    ``suffix`` ends the name of every measure of the window. ``where`` is an extra test on the spine,
    e.g. that the person has both anchors. ``anchored`` is false when both ends are the same for all.
    """

    suffix: str
    start: Column
    end: Column
    where: Column | None = None
    anchored: bool = True


def look_back(anchor: str, days: int = 365, suffix: str = "", where: Column | None = None) -> Span:
    return Span(suffix, F.date_sub(F.col(anchor), days), F.col(anchor), where)


def between_anchors(first: str, last: str, suffix: str = "_wave", where: Column | None = None) -> Span:
    return Span(suffix, F.col(first), F.col(last), where)


def anchor_to_date(anchor: str, end: str, suffix: str = "", where: Column | None = None) -> Span:
    return Span(suffix, F.col(anchor), F.lit(end).cast("date"), where)


def fixed_period(start: str, end: str, suffix: str = "_5m", where: Column | None = None) -> Span:
    return Span(suffix, F.lit(start).cast("date"), F.lit(end).cast("date"), where, anchored=False)


@dataclass(frozen=True)
class Measure:
    """One output column per window; ``spans`` names the suffixes it is wanted for (None: all)."""

    name: str
    kind: str
    value: Column | None = None
    strict: bool = False
    spans: tuple[str, ...] | None = None

    def wanted(self, span: Span) -> bool:
        return self.spans is None or span.suffix in self.spans


def row_count(name: str, spans=None) -> Measure:
    return Measure(name, "count", spans=spans)


def count_where(name: str, test: Column, strict: bool = False, spans=None) -> Measure:
    """Rows where the test holds; ``strict`` makes it null if the test is unknown for one row."""
    return Measure(name, "count", test, strict, spans)


def total(name: str, value: Column | str, strict: bool = False, spans=None) -> Measure:
    return Measure(name, "sum", col(value), strict, spans)


def any_where(name: str, test: Column, strict: bool = True, spans=None) -> Measure:
    """1 if the test holds for a row of the window, else 0."""
    return Measure(name, "any", test, strict, spans)


def distinct_values(name: str, value: Column | str, spans=None) -> Measure:
    """Distinct values, a missing value counting as one."""
    return Measure(name, "distinct", col(value), spans=spans)


def about_distinct(name: str, value: Column | str, spans=None) -> Measure:
    """As ``distinct_values``, estimated: a sketch of fixed size stands for the values, however many there are.

    Its relative standard error is below one percent (2 to the power of ``SKETCH_SIZE`` registers), far less for few values.
    """
    return Measure(name, "sketch", col(value), spans=spans)


def _least(cols: Sequence[Column]) -> Column:
    return F.least(*cols) if len(cols) > 1 else cols[0]


def _greatest(cols: Sequence[Column]) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def _typed(bound: Column, dtype: str) -> Column:
    """The bound in the type of the event column, so that the column itself is not cast."""
    return bound.cast(dtype) if dtype.startswith("timestamp") else bound


def _within_bounds(events: DataFrame, spine: DataFrame, date: str, spans: Sequence[Span]) -> DataFrame:
    """Keep the events no later than the last and no earlier than the first day of any window.

    Both bounds are scalar subqueries over the spine, so they reach the scan of the events.
    """
    dtype = dict(events.dtypes)[date]
    fixed = [s for s in spans if not s.anchored]
    moving = [s for s in spans if s.anchored]
    first, last = [s.start for s in fixed], [s.end for s in fixed]
    if moving:
        first.append(spine.agg(F.min(_least([s.start for s in moving]))).scalar())
        last.append(spine.agg(F.max(_greatest([s.end for s in moving]))).scalar())
    low, high = _least(first), _greatest(last)
    return events.where(
        (F.col(date) >= _typed(low, dtype)) & (F.col(date) < _typed(F.date_add(high, 1), dtype))
    )


def fits(spine: DataFrame, key: str, rows: int = SMALL_SPINE) -> bool:
    """Whether the spine has no more than so many rows; reads the key alone, and no more rows than that."""
    return spine.select(key).limit(rows + 1).count() <= rows


def _ends(spine: DataFrame, key: str, unique: bool) -> tuple:
    """The first and last key; an error if one is held twice, unless that was tested."""
    keys = spine.select(F.col(key).alias("k")).where("k is not null")
    if unique:
        return tuple(keys.agg(F.min("k"), F.max("k")).first())
    low, high, most, which = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).agg(F.min("k"), F.max("k"), F.max("n"), F.max_by("k", "n")).first()
    if most is not None and most > 1:
        raise ValueError(f"spine: more than one row for {key} {which}")
    return low, high


def _between_keys(df: DataFrame, key: str, bounds: tuple) -> DataFrame:
    low, high = bounds
    return df.where(F.col(key).between(F.lit(low), F.lit(high)))


def _event_rows(events: DataFrame, key: str, date: str, measures: Sequence[Measure]) -> tuple[DataFrame, list[str]]:
    """Person, day, what the event adds to each additive measure, and the value of a distinct one; names of the parts.

    With several distinct measures an event has one row for each, and its parts stand in the first.
    """
    additive = [m for m in measures if m.kind != "distinct"]
    distinct = [m for m in measures if m.kind == "distinct"]
    made = {"_rows": F.lit(1).cast("long")}
    for i, m in enumerate(additive):
        if m.kind == "sketch":
            made[f"_sketch{i}"] = m.value.cast("string")
        elif m.value is not None:
            made[f"_hit{i}"] = F.coalesce(m.value, F.lit(0)) if m.kind == "sum" else F.when(m.value, 1).otherwise(0).cast("long")
        if m.kind == "sketch" or m.strict and m.value is not None:
            made[f"_known{i}"] = m.value.isNotNull().cast("long")
    names, parts = list(made), [c.alias(n) for n, c in made.items()]
    values = [m.value.alias(f"_d{j}") for j, m in enumerate(distinct)]
    rows = events.select(key, F.col(date).cast("date").alias("_day"), *parts, *values)
    if len(distinct) == 1:
        return rows.withColumnRenamed("_d0", "_value").withColumn("_which", F.lit(0)), names
    if distinct:
        of = lambda j: [F.col(n) if j == 0 else F.lit(None).cast(dict(rows.dtypes)[n]).alias(n) for n in names]
        each = [F.struct(*of(j), F.lit(j).alias("_which"), F.col(f"_d{j}").cast("string").alias("_value")) for j in range(len(distinct))]
        return rows.select(key, "_day", F.inline(F.array(*each))), names
    return rows, names


def _in_span(span: Span) -> Column:
    inside = F.col("_day").between(span.start, span.end)
    return inside if span.where is None else inside & span.where


def _in_windows(rows: DataFrame, spine: DataFrame, key: str, spine_key: str, spans: Sequence[Span], small: bool, outsiders: bool) -> DataFrame:
    """The rows in some window of their person, with ``_in<i>`` for each window.

    People outside the spine leave with the join. With ``outsiders`` a fixed window, which needs no anchor, keeps them.
    """
    on_spine = [s.anchored or s.where is not None for s in spans]
    if any(on_spine) or not outsiders:
        anchors = spine.withColumnRenamed(spine_key, "_person")
        anchors = F.broadcast(anchors) if small else anchors
        rows = rows.join(anchors, F.col(key) == F.col("_person"), "inner" if all(on_spine) or not outsiders else "left")
    flags = [F.coalesce(_in_span(s), F.lit(False)).alias(f"_in{i}") for i, s in enumerate(spans)]
    kept = [c for c in rows.columns if c in (key, "_which", "_value") or c.startswith(("_rows", "_hit", "_known", "_sketch"))]
    return rows.select(*kept, *flags).where(" or ".join(f"_in{i}" for i in range(len(spans))))


def window_features(
    events: DataFrame,
    spine: DataFrame,
    key: str,
    date: str,
    spans: Sequence[Span],
    measures: Sequence[Measure],
    keep: str = "any",
    spine_key: str | None = None,
    prune: bool = True,
    collapse: bool | None = None,
    unique_spine: bool = False,
    outsiders: bool = False,
) -> DataFrame:
    """Per person of the spine, every measure in every window it is wanted for.

    A person appears if an event of theirs falls in a window (``keep='any'``) or in the window with
    the suffix given as ``keep``. The measures of a window in which a person has no event are null,
    not 0. ``date`` is a date or timestamp column. ``prune`` derives the first and last useful day
    from the spine and filters the events by them. Events without a person are left out.

    A second row of a person in the spine fails the job, or the call where the spine is large; ``unique_spine=True`` says that it was tested.
    ``collapse`` picks the plan, None by the size of the spine: False broadcasts the spine and shuffles
    sums only; True makes one row per person and day before the join. ``outsiders=True`` counts events of
    people whom the spine lacks too, in the windows that hang on no anchor.
    """
    spine_key = spine_key or key
    small = fits(spine, spine_key) if collapse is None else not collapse
    events = events.where(F.col(key).isNotNull())
    if not small and not outsiders:
        low, high = _ends(spine, spine_key, unique_spine)
        unique_spine = True
        if low is not None:
            events, spine = _between_keys(events, key, (low, high)), _between_keys(spine, spine_key, (low, high))
    if prune:
        events = _within_bounds(events, spine, date, spans)
    if not unique_spine:
        spine = checked_unique(spine, spine_key, "spine")

    rows, parts = _event_rows(events, key, date, measures)
    if not small:
        rows = _summed(rows, key, parts)
    return _features(rows, parts, spine, key, spine_key, spans, measures, keep, small, outsiders)


def day_partials(events: DataFrame, key: str, date: str, measures: Sequence[Measure]) -> DataFrame:
    """What every window is made of: a row for each person and day (and value of a distinct measure), without any window.

    Sums, counts of known values and sketches stand in columns named by the place of the measure, so the same list of
    measures must be given to ``features_from_partials``. Partials of further events are added with ``add_partials``.
    """
    rows, parts = _event_rows(events.where(F.col(key).isNotNull()), key, date, measures)
    return _summed(rows, key, parts)


def add_partials(key: str, *partials: DataFrame) -> DataFrame:
    """Partials of several sets of events as those of all of them; an event must be in one set only."""
    whole = reduce(DataFrame.unionByName, partials)
    return _summed(whole, key, [c for c in whole.columns if c not in (key, "_day", "_which", "_value")], again=True)


def features_from_partials(
    partials: DataFrame,
    spine: DataFrame,
    key: str,
    spans: Sequence[Span],
    measures: Sequence[Measure],
    keep: str = "any",
    spine_key: str | None = None,
    unique_spine: bool = False,
    outsiders: bool = False,
) -> DataFrame:
    """What ``window_features`` gives for the events that the partials were made of, from the partials alone."""
    spine_key = spine_key or key
    small = fits(spine, spine_key)
    if not unique_spine:
        spine = checked_unique(spine, spine_key, "spine")
    parts = [c for c in partials.columns if c not in (key, "_day", "_which", "_value")]
    return _features(partials, parts, spine, key, spine_key, spans, measures, keep, small, outsiders)


def _summed(rows: DataFrame, key: str, parts: Sequence[str], again: bool = False) -> DataFrame:
    """One row for each person, day and value, which combines on the map side."""
    values = [c for c in ("_which", "_value") if c in rows.columns]
    return rows.groupBy(key, "_day", *values).agg(*[_joined(p, F.col(p), again).alias(p) for p in parts])


def _joined(part: str, value: Column, again: bool) -> Column:
    """A part over several rows: a sum, or a sketch of values (of sketches, ``again``)."""
    if not part.startswith("_sketch"):
        return F.sum(value)
    return F.hll_union_agg(value) if again else F.hll_sketch_agg(value, F.lit(SKETCH_SIZE))


def _features(
    rows: DataFrame, parts: Sequence[str], spine: DataFrame, key: str, spine_key: str, spans: Sequence[Span], measures: Sequence[Measure], keep: str, small: bool, outsiders: bool
) -> DataFrame:
    additive = [m for m in measures if m.kind != "distinct"]
    distinct = [m for m in measures if m.kind == "distinct"]
    values = ["_which", "_value"] if distinct else []
    kinds = dict(rows.dtypes)
    found = _in_windows(rows, spine, key, spine_key, spans, small, outsiders)

    wanted = {
        s: ["_rows", *[p for i, m in enumerate(additive) if m.wanted(span) for p in (f"_hit{i}", f"_known{i}", f"_sketch{i}") if p in parts]]
        for s, span in enumerate(spans)
    }

    def over(name: str, s: int, value: Column, again: bool) -> Column:
        return _joined(name, value, again).alias(f"{name}_{s}")

    sums = [over(p, s, F.expr(f"if(_in{s}, {p}, null)"), kinds[p] == "binary") for s, names in wanted.items() for p in names]
    if not distinct:
        totals = found.groupBy(key).agg(*sums)
    else:
        if not small:
            # An exchange right after the join, so that Spark may split a hot person there.
            found = found.repartition(key, *values)
        seen = [F.expr(f"max(_in{s}) as _in{s}") for s in wanted]
        per_value = found.groupBy(key, *values).agg(*sums, *seen)
        # The union of no sketches is an empty one of another size; where no row is in the window it stays out.
        kept = {p: f"if(_rows_{{0}} is null, null, {p}_{{0}})" if p.startswith("_sketch") else f"{p}_{{0}}" for p in parts}
        again = [over(p, s, F.expr(kept[p].format(s)), True) for s, names in wanted.items() for p in names]
        counts = [F.expr(f"nullif(count_if(_in{s} and _which = {j}), 0) as _distinct{j}_{s}") for s in wanted for j in range(len(distinct))]
        totals = per_value.groupBy(key).agg(*again, *counts)

    base = [s for s, span in enumerate(spans) if keep in ("any", span.suffix)]
    totals = totals.where(" or ".join(f"_rows_{s} is not null" for s in base))
    place = {id(m): i for group in (additive, distinct) for i, m in enumerate(group)}
    out = [F.col(key)]
    for s, span in enumerate(spans):
        out += [_final(m, place[id(m)], s, m.name + span.suffix) for m in measures if m.wanted(span)]
    return totals.select(*out)


def _final(m: Measure, i: int, s: int, name: str) -> Column:
    """The measure from its sums over the rows of window ``s``."""
    if m.kind == "distinct":
        return F.col(f"_distinct{i}_{s}").alias(name)
    if m.kind == "sketch":  # rows whose value is missing count as one value more
        return F.expr(f"if(_rows_{s} is null, null, hll_sketch_estimate(_sketch{i}_{s}) + if(_known{i}_{s} < _rows_{s}, 1, 0))").alias(name)
    hits = f"_rows_{s}" if m.value is None else f"_hit{i}_{s}"
    if m.kind == "any":
        hits = f"cast({hits} > 0 as int)"
    if m.strict:
        hits = f"if(_known{i}_{s} = _rows_{s}, {hits}, null)"
    return F.expr(hits).alias(name)
