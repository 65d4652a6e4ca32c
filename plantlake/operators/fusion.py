"""Several rollups of one table in one scan and one shuffle.

Rollups that read the same table with the same filter, time, grain and device keys have the same groups, so one
aggregate can hold the measures of all of them.  ``FusedRollup`` builds that wide aggregate; ``part`` takes one
rollup's table out of it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.functions.jsoncols import unpack
from plantlake.functions.timegrid import grain_minutes, with_grain_key
from plantlake.operators.rollup import Rollup


def fusion_key(spec: Rollup) -> tuple:
    return spec.where, spec.time, grain_minutes(spec.grain), spec.by, spec.key


def fits_together(specs: Iterable[Rollup]) -> bool:
    """Same groups, and no column that one unpacks from JSON is read from the table, or unpacked, by another."""
    specs = list(specs)
    if len({fusion_key(s) for s in specs}) != 1:
        return False
    made = [set(s.json.out_names()) if s.json else set() for s in specs]
    for i, s in enumerate(specs):
        others = set().union(*(m for j, m in enumerate(made) if j != i))
        read = {*s.input_columns(), *([s.json.column] if s.json else [])}
        if others & (read | made[i]) or (s.json and s.json.column in made[i]):
            return False
    return True


@dataclass(frozen=True)
class FusedRollup:
    """Rollups with the same groups, by name."""

    members: tuple[tuple[str, Rollup], ...]

    def __post_init__(self) -> None:
        if not fits_together(spec for _, spec in self.members):
            raise ValueError(f"rollups {[n for n, _ in self.members]} do not fit together")

    def _column(self, name: str, measure: str) -> str:
        return f"{name}__{measure}"

    def build(self, df: DataFrame) -> DataFrame:
        """One row a group, with every member's measures as ``<member>__<measure>``."""
        first = self.members[0][1]
        if first.where is not None:
            df = df.where(F.expr(first.where))
        specs = [spec for _, spec in self.members]
        made = {n for s in specs if s.json for n in s.json.out_names()}
        needed = list(dict.fromkeys(c for s in specs for c in s.input_columns() if c not in made))
        needed += [s.json.column for s in specs if s.json and s.json.column not in needed]
        df = df.select(*needed)
        for s in specs:
            if s.json is not None:
                df = unpack(df, s.json, df.columns)
        keyed = with_grain_key(df, first.key, first.time, first.grain)
        measures = [replace(m, name=self._column(n, m.name)).column() for n, s in self.members for m in s.measures]
        return keyed.groupBy(first.key, *first.by).agg(*measures)

    def part(self, wide: DataFrame, name: str, ordered: bool = False) -> DataFrame:
        """The table of one member."""
        spec = dict(self.members)[name]
        out = wide.select(spec.key, *spec.by, *[F.col(self._column(name, m.name)).alias(m.name) for m in spec.measures])
        return out.orderBy(spec.key, *spec.by) if ordered else out


def fuse(steps: Iterable) -> list[list]:
    """Steps (``table``, ``source``, ``spec``) in groups that can share a scan; order is kept, chains stay alone."""
    groups: list[list] = []
    for step in steps:
        for group in groups:
            together = [*(s.spec for s in group), step.spec]
            if group[0].source == step.source and all(isinstance(s, Rollup) for s in together) and fits_together(together):
                group.append(step)
                break
        else:
            groups.append([step])
    return groups
