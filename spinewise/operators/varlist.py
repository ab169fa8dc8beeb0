"""Variable lists: which columns a report holds, by what names, in what groups.

A list is read from a file and checked against a table before any plan is built from it, so that a report either
holds every variable that was asked for or says which it cannot hold.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType

#: Rows of a list, at most.
MOST_VARIABLES = 10_000


@dataclass(frozen=True)
class Variable:
    """A column, its label, and the groups it is in: the filled filter cells of its row."""

    name: str
    label: str | None = None
    filters: Mapping[str, str] = field(default_factory=dict)


class VariableList(Sequence[Variable]):
    def __init__(self, variables: Sequence[Variable]):
        self._variables = list(variables)

    def __len__(self) -> int:
        return len(self._variables)

    def __getitem__(self, i):
        return VariableList(self._variables[i]) if isinstance(i, slice) else self._variables[i]

    def __iter__(self) -> Iterator[Variable]:
        return iter(self._variables)

    def filled(self, filter: str, value: str | None = None) -> VariableList:
        """Those whose filter cell is filled, or holds the value given."""
        return VariableList([v for v in self if filter in v.filters and value in (None, v.filters[filter])])

    def outcomes(self) -> dict[str, str]:
        """Label by name, the name itself standing in for a missing label."""
        return {v.name: v.label or v.name for v in self}

    def faults(self, frame: DataFrame, numeric: bool = False) -> list[str]:
        """What keeps the list from being reported on the table, in words; columns are told apart by letter case."""
        kinds, found, seen = {f.name: f.dataType for f in frame.schema}, [], set()
        for place, v in enumerate(self, 1):
            if not v.name:
                found.append(f"row {place}: no variable")
            elif v.name in seen:
                found.append(f"row {place}: {v.name} is listed twice")
            elif v.name not in kinds:
                found.append(f"row {place}: no such variable: {v.name}")
            elif numeric and not isinstance(kinds[v.name], NumericType):
                found.append(f"row {place}: {v.name} is {kinds[v.name].simpleString()}, not a number")
            seen.add(v.name)
        return found

    def checked(self, frame: DataFrame, numeric: bool = False) -> VariableList:
        """The same list; an error that names every fault if there is any."""
        if faults := self.faults(frame, numeric):
            raise ValueError("; ".join(faults))
        return self
