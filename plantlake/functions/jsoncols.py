"""Flat JSON columns unpacked into typed columns.

``json_tuple`` parses each document once for all keys.  Key match is case-sensitive;
malformed JSON, a non-object document, an absent key and a JSON null all give NULL;
a nested value comes back as its JSON text.  Values are converted with ``try_cast``
so a non-numeric value (``"n/a"``) becomes NULL instead of failing the job under
ANSI mode.  Keys that no later step reads are pruned by the optimizer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JsonUnpack:
    """Unpack ``keys`` of the JSON text in ``column`` into columns ``names``."""

    column: str
    keys: tuple[str, ...]
    names: tuple[str, ...] | None = None
    cast: str | None = "double"

    def out_names(self) -> tuple[str, ...]:
        names = self.names or self.keys
        if len(names) != len(self.keys):
            raise ValueError("JsonUnpack needs one output name per key")
        return names


def unpack(df: DataFrame, spec: JsonUnpack, keep: list[str] | tuple[str, ...]) -> DataFrame:
    """``df.select(*keep, json_tuple(column, *keys)).toDF(*keep, *names)``, then typed."""
    names = spec.out_names()
    keep = [c for c in keep if c not in names]
    parsed = df.select(*keep, F.json_tuple(F.col(spec.column), *spec.keys).alias(*names))
    if spec.cast is None:
        return parsed
    return parsed.select(*keep, *[F.col(n).try_cast(spec.cast).alias(n) for n in names])
