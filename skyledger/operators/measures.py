"""Gold measures as mergeable partial states.

Each measure says which input columns it needs, which states to aggregate from silver rows, how to
merge the states of several partial groups, and how to read the result off a state. Every state is
algebraic, so Spark combines it before the shuffle and a hot location costs one row per task.

All parts are dictionaries from column name to expression: measures over the same column share
their inputs and states.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from skyledger.functions.rounding import high_bits, left_nanos, low_bits, mean_2, round_2, whole_units


GROUP_ROWS = "group__rows"


@dataclass(frozen=True)
class Mean:
    column: str

    def _names(self) -> tuple[str, ...]:
        parts = ("high", "low", "nanos", "unit_rows", "total", "rows")
        return tuple(f"{self.column}__{part}" for part in parts)

    def inputs(self) -> dict[str, Column]:
        value = F.col(self.column)
        return {self.column: value, f"{self.column}__units": whole_units(value)}

    def states(self) -> dict[str, Column]:
        high, low, nanos, unit_rows, total, rows = self._names()
        units = F.col(f"{self.column}__units")
        return {
            high: F.sum(high_bits(units)),
            low: F.sum(low_bits(units)),
            nanos: F.sum(left_nanos(F.col(self.column), units)),
            unit_rows: F.count(units),
            total: F.sum(self.column),
            rows: F.count(self.column),
        }

    def merge(self) -> dict[str, Column]:
        return {name: F.sum(name) for name in self._names()}

    def result(self) -> Column:
        return mean_2(*self._names())


@dataclass(frozen=True)
class Maximum:
    column: str

    def inputs(self) -> dict[str, Column]:
        return {self.column: F.col(self.column)}

    def states(self) -> dict[str, Column]:
        return {f"{self.column}__max": F.max(self.column)}

    def merge(self) -> dict[str, Column]:
        return {f"{self.column}__max": F.max(f"{self.column}__max")}

    def result(self) -> Column:
        return round_2(F.col(f"{self.column}__max"))


@dataclass(frozen=True)
class Minimum:
    column: str

    def inputs(self) -> dict[str, Column]:
        return {self.column: F.col(self.column)}

    def states(self) -> dict[str, Column]:
        return {f"{self.column}__min": F.min(self.column)}

    def merge(self) -> dict[str, Column]:
        return {f"{self.column}__min": F.min(f"{self.column}__min")}

    def result(self) -> Column:
        return round_2(F.col(f"{self.column}__min"))


@dataclass(frozen=True)
class CountPositive:
    column: str

    def inputs(self) -> dict[str, Column]:
        return {self.column: F.col(self.column)}

    def states(self) -> dict[str, Column]:
        return {f"{self.column}__positive": F.count_if(F.col(self.column) > 0)}

    def merge(self) -> dict[str, Column]:
        return {f"{self.column}__positive": F.sum(f"{self.column}__positive")}

    def result(self) -> Column:
        return F.col(f"{self.column}__positive")


@dataclass(frozen=True)
class CountRows:
    def inputs(self) -> dict[str, Column]:
        return {}

    def states(self) -> dict[str, Column]:
        return {GROUP_ROWS: F.count(F.lit(1))}

    def merge(self) -> dict[str, Column]:
        return {GROUP_ROWS: F.sum(GROUP_ROWS)}

    def result(self) -> Column:
        return F.col(GROUP_ROWS)


Measure = Mean | Maximum | Minimum | CountPositive | CountRows


def named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]
