"""The rollup operator: one declarative spec per time-series table.

A ``Rollup`` replaces one hand-written ``SELECT bucket, keys, measures ... GROUP BY
... ORDER BY`` string.  ``build`` returns a lazy DataFrame:

    filter (pushed to the scan) -> optional JSON unpack -> key columns -> groupBy.agg

Keys are materialised with ``withColumn`` before ``groupBy``, so a key can never be
captured by an input column of the same name (the SQL ``GROUP BY alias`` pitfall).
The global ``ORDER BY`` of the original tables is optional (``ordered=True``): it is
a range shuffle, worth paying only when the result is written and later read by time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.jsoncols import JsonUnpack, unpack
from plantlake.functions.measures import Measure
from plantlake.functions.timegrid import day_of, grain_minutes, with_grain_key


def sql_literal(value: object) -> str:
    """A literal of Spark SQL, where a backslash escapes."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "''") + "'"
    if isinstance(value, bool) or value is None:
        raise TypeError(f"unsupported literal {value!r}")
    return repr(value)


def sql_in(column: str, values: Sequence[object]) -> str:
    """``column IN (v1, v2, ...)`` as SQL text; parquet and JDBC scans accept it as a pushed filter."""
    if not values:
        raise ValueError("empty IN list")
    return f"{column} IN ({', '.join(sql_literal(v) for v in values)})"


@dataclass(frozen=True)
class Rollup:
    """Tumbling-bucket (or daily) aggregation of one input.

    ``time``      timestamp (or bucket) column of the input
    ``grain``     "15 minutes", "1 hour", "1 day" or a width in minutes dividing the hour
    ``by``        device keys grouped beside the time key
    ``measures``  output columns, in order
    ``where``     SQL predicate applied before anything else
    ``json``      JSON column to unpack before aggregating
    ``key``       name of the time key column in the output
    """

    name: str
    measures: tuple[Measure, ...]
    time: str = "fecha"
    grain: str | int = "15 minutes"
    by: tuple[str, ...] = ()
    where: str | None = None
    json: JsonUnpack | None = None
    key: str = "time_interval"

    def __post_init__(self) -> None:
        grain_minutes(self.grain)
        if not self.measures:
            raise ValueError(f"rollup {self.name} has no measures")

    def input_columns(self) -> list[str]:
        """Columns read from the input (after the JSON unpack step)."""
        cols = [self.time, *self.by]
        for m in self.measures:
            if m.source not in cols:
                cols.append(m.source)
        return cols

    def prepared(self, df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
        """The input after the filter and the JSON step, with the key column; ``also`` names columns to keep."""
        if self.where is not None:
            df = df.where(F.expr(self.where))
        if self.json is not None:
            produced = self.json.out_names()
            keep = [c for c in dict.fromkeys([*self.input_columns(), *also]) if c not in produced]
            used = [(k, n) for k, n in zip(self.json.keys, produced) if n in self.input_columns()]
            spec = JsonUnpack(self.json.column, tuple(k for k, _ in used), tuple(n for _, n in used), self.json.cast)
            df = unpack(df, spec, keep)
        return with_grain_key(df, self.key, self.time, self.grain)

    def build(self, df: DataFrame, ordered: bool = False) -> DataFrame:
        out = self.prepared(df).groupBy(self.key, *self.by).agg(*[m.column() for m in self.measures])
        if ordered:
            out = out.orderBy(self.key, *self.by)
        return out


@dataclass(frozen=True)
class Chain:
    """Rollups applied one after another (a rollup of a rollup, e.g. hour means summed per day).

    The input is a table of the layer before, a row per bucket and device.  If the last grain is the day, its rows are
    dealt by the day once, and every step groups by the day as well, which changes no group (a bucket lies in one day):
    rows of a day lie together for all steps, so the steps need no exchange of their own.  Otherwise each step has one.
    """

    name: str
    steps: tuple[Rollup, ...]

    def __post_init__(self) -> None:
        if not self.steps:
            raise ValueError(f"chain {self.name} has no steps")

    def one_day(self) -> bool:
        """Whether all steps can share an exchange on the day."""
        *inner, last = self.steps
        fed = all(b.time == a.key and b.where is None and b.json is None for a, b in zip(self.steps, self.steps[1:]))
        named = {c for s in inner for c in (s.key, *s.by, *(m.name for m in s.measures))}
        return bool(inner) and fed and grain_minutes(last.grain) == 1440 and not last.by and last.key not in named

    def build(self, df: DataFrame, ordered: bool = False) -> DataFrame:
        *inner, last = self.steps
        if not self.one_day():
            for step in inner:
                df = step.build(df)
            return last.build(df, ordered=ordered)
        day = last.key
        for i, step in enumerate(inner):
            df = step.prepared(df, also=() if i == 0 else (day,))
            if i == 0:
                df = df.withColumn(day, day_of(step.key)).repartition(day)
            df = df.groupBy(day, step.key, *step.by).agg(*[m.column() for m in step.measures])
        out = df.groupBy(day).agg(*[m.column() for m in last.measures])
        return out.orderBy(day) if ordered else out


def select_renamed(df: DataFrame, columns: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Projection with optional renames: ``"a"`` keeps a column, ``("a", "b")`` is ``a AS b``."""
    cols: list[Column] = []
    for c in columns:
        if isinstance(c, tuple):
            cols.append(F.col(c[0]).alias(c[1]))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
