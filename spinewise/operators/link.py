"""Bringing person-level and entity-level tables together."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.functions.missing import equal_keys
from spinewise.functions.names import lead_with, present, with_prefix


def checked_unique(df: DataFrame, key: str, name: str = "table", null_safe: bool = False) -> DataFrame:
    """The same rows; the job fails if a key is held by more than one of them.

    The check is part of the plan: a grouping by key, which combines on the map side and leaves the
    rows where the join that follows needs them. Rows without a key are left out unless a missing
    key is to match a missing key.
    """
    if not null_safe:
        df = df.where(F.col(key).isNotNull())
    columns = df.columns
    values = [F.expr(f"any_value(`{c}`) as `{c}`") for c in columns if c != key]
    per_key = df.groupBy(key).agg(*values, F.expr("count(1) as _n"))
    return per_key.where(_single(key, name)).select(*columns)


def _single(key: str, name: str) -> Column:
    shown = F.coalesce(F.col(key).cast("string"), F.lit("(missing)"))
    message = F.concat(F.lit(f"{name}: more than one row for {key} "), shown)
    return F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True)


def link_to_spine(
    spine: DataFrame,
    sources: Mapping[str, tuple[DataFrame, str]],
    key: str,
    null_safe: bool = False,
    check: Sequence[str] | None = None,
    unique_spine: bool = False,
) -> DataFrame:
    """Left-join every named source to the spine on the person key, keeping the spine's rows.

    ``sources`` maps a name to the table and its key column. A column already present gets the name
    of its source as suffix. A source with two rows for one person fails the job; ``check`` limits
    that test to the sources named, the others having one row per person by the way they were made.
    So does a second spine row of one key, or without a key; ``unique_spine=True`` says that it was tested.
    """
    linked = spine if unique_spine else checked_unique(spine, key, "spine", null_safe=True)
    taken = list(spine.columns)
    for name, (df, source_key) in sources.items():
        if check is None or name in check:
            df = checked_unique(df, source_key, name, null_safe)
        new = {c: f"{c}_{name}" if c in taken else c for c in df.columns if c != source_key}
        df = df.select(F.col(source_key).alias(f"_key_{name}"), *[F.col(f"`{c}`").alias(n) for c, n in new.items()])
        linked = linked.join(df, equal_keys(F.col(key), F.col(f"_key_{name}"), null_safe), "left")
        taken += new.values()
    return linked.select(*[F.col(f"`{c}`") for c in taken])


def assemble(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Full outer join of person-level tables: one row for each person found in any of them.

    The tables are stacked by column name and grouped once by the key, so the work is one exchange
    whatever the number of tables. A second row for a person in one table is seen there and fails
    the job. Rows without a key are nobody's and left out. Tables must not share column names other
    than the key.
    """
    columns = [c for df in frames.values() for c in df.columns if c != key]
    if len(set(columns)) < len(columns):
        raise ValueError(f"columns found in two tables: {sorted({c for c in columns if columns.count(c) > 1})}")
    marked = [df.where(F.col(key).isNotNull()).withColumn(f"_from_{n}", F.lit(1)) for n, df in frames.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    values = [F.expr(f"any_value(`{c}`, true) as `{c}`") for c in columns]
    most = F.expr(f"greatest(1, {', '.join(f'count(_from_{n})' for n in frames)}) as _n")
    # A person's rows stand in different tables, so combining before the exchange would only sort wide rows for nothing.
    per_person = stacked.repartition(key).groupBy(key).agg(*values, most)
    return per_person.where(_single(key, "assemble")).select(key, *columns)


def zero_fill(df: DataFrame, columns: Sequence[str] = (), prefix: str | None = None) -> DataFrame:
    """Null becomes 0 in the named columns the frame has, and in all columns with the prefix; absent ones are warned of."""
    wanted = present(df, columns)
    if absent := [c for c in columns if c not in wanted]:
        warnings.warn(f"zero_fill: no such columns: {', '.join(absent)}", stacklevel=2)
    if prefix is not None:
        wanted += [c for c in with_prefix(df, prefix, ignore_case=False) if c not in wanted]
    return df.fillna(0, subset=wanted) if wanted else df


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, values: Mapping[str, str]) -> DataFrame:
    """Add columns of a lookup table, ``values`` mapping its names to the new ones."""
    picked = table.select(F.col(table_key).alias("_key"), *[F.col(v).alias(n) for v, n in values.items()])
    return df.join(picked, F.col(key) == F.col("_key"), "left").drop("_key")


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on every column name the two tables share."""
    return left.join(right, [c for c in left.columns if c in right.columns], "left")


@dataclass(frozen=True)
class Provider:
    """How the records of one provider meet its people.

    ``people`` and ``records`` are tests choosing the rows; ``record_id`` replaces the record key,
    e.g. to bring ids to one letter case. ``drop`` leaves columns out of the records, by wave, and
    ``drop_people`` out of the people.
    """

    people: Column
    records: Column
    person_key: str
    record_key: str
    record_id: Column | None = None
    drop: Mapping[int, Sequence[str]] = field(default_factory=dict)
    drop_people: Sequence[str] = ()


def waves_wide(
    people: DataFrame,
    records: DataFrame,
    providers: Sequence[Provider],
    wave: str,
    waves: Sequence[tuple[int, str]] = ((1, ""), (2, "_w2")),
    lead: Sequence[str] = (),
    unique: bool = True,
) -> DataFrame:
    """Records of several waves side by side, one row per person, the providers' rows stacked.

    ``waves`` gives the number of each wave and the suffix of its columns. People and records are read
    once: one grouping by provider and id lays the waves side by side, and one join brings them to the people.
    """
    kept = {
        (i, number): [c for c in records.columns if c not in (wave, p.record_key, *p.drop.get(number, ()))]
        for i, p in enumerate(providers)
        for number, _ in waves
    }
    ids = [F.col(p.record_key) if p.record_id is None else p.record_id for p in providers]
    owners = [F.when(p.records, F.struct(F.lit(i).alias("_p"), k.cast("string").alias("_key"))) for i, (p, k) in enumerate(zip(providers, ids, strict=True))]
    owned = records.select("*", F.inline(F.array_compact(F.array(*owners)))).where(F.col("_key").isNotNull())
    values, counts = [], []
    for number, suffix in waves:
        here = F.col(wave) == number
        columns = dict.fromkeys(c for i in range(len(providers)) for c in kept[i, number])
        values += [F.any_value(F.when(here, F.col(c)), F.lit(True)).alias(c + suffix) for c in columns]
        counts.append(F.count_if(here).alias(f"_n{number}"))
    wide = owned.groupBy("_p", "_key").agg(*values, *counts)
    if unique:
        for number, _ in waves:
            wide = wide.withColumn("_n", F.col(f"_n{number}")).where(_single("_key", f"wave {number}")).drop("_n")
    wide = wide.drop(*[f"_n{number}" for number, _ in waves]).withColumnsRenamed({"_p": "_wp", "_key": "_wkey"})

    asked = [F.when(p.people, F.struct(F.lit(i).alias("_p"), F.col(p.person_key).cast("string").alias("_key"))) for i, p in enumerate(providers)]
    everyone = people.select("*", F.inline(F.array_compact(F.array(*asked))))
    # People without an id match nothing; they stay out of the join, where they would pile up.
    met = everyone.where(F.col("_key").isNotNull()).join(wide, (F.col("_p") == F.col("_wp")) & (F.col("_key") == F.col("_wkey")), "left")
    whole = met.unionByName(everyone.where(F.col("_key").isNull()), allowMissingColumns=True)
    has = {
        i: [c for c in people.columns if c not in p.drop_people] + [c + suffix for number, suffix in waves for c in kept[i, number]]
        for i, p in enumerate(providers)
    }
    out = []
    for c in dict.fromkeys(c for i in has for c in has[i]):
        within = [i for i in has if c in has[i]]
        out.append(F.col(c) if len(within) == len(providers) else F.when(F.col("_p").isin(within), F.col(c)).alias(c))
    stacked = whole.select(*out)
    return lead_with(stacked, *lead) if lead else stacked


def entity_link(
    people: DataFrame,
    entities: DataFrame,
    sources: Mapping[str, tuple[DataFrame, str]],
    key: str,
) -> tuple[DataFrame, DataFrame]:
    """The entity table with every source attached, and the people with their entity's columns.

    An entity may hold a large share of the people. Spark splits such an entity if both sides of the
    join come straight from a shuffle. The entity table is spread by another value of the key first,
    since it would otherwise arrive already grouped by key from the joins that made it.
    """
    entity_level = link_to_spine(checked_unique(entities, key, "entities"), sources, key)
    return entity_level, people.join(entity_level.repartition(F.xxhash64(key)), key, "left")
