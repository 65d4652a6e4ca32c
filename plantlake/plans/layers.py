"""Lazy builders for each layer, fused or table by table.

``silver_frames`` / ``gold_frames`` / ``joined_frame`` take the previous layer as a
dict of DataFrames and return the next one, still lazy: chained together they form
one plan (fused), and fed from catalog tables they reproduce the layer-by-layer jobs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from plantlake.operators.daily_join import day_join
from plantlake.plans.plant import Plant, Step, joined_output


def build_step(step: Step, inputs: Mapping[str, DataFrame], ordered: bool = False) -> DataFrame:
    return step.spec.build(inputs[step.source], ordered=ordered)


def _frames(
    steps: Iterable[Step], inputs: Mapping[str, DataFrame], only: Iterable[str] | None, ordered: bool
) -> dict[str, DataFrame]:
    wanted = None if only is None else set(only)
    return {
        s.table: build_step(s, inputs, ordered)
        for s in steps
        if (wanted is None or s.table in wanted) and s.source in inputs
    }


def silver_frames(
    plant: Plant, bronze: Mapping[str, DataFrame], only: Iterable[str] | None = None, ordered: bool = False
) -> dict[str, DataFrame]:
    return _frames(plant.silver, bronze, only, ordered)


def gold_frames(
    plant: Plant, silver: Mapping[str, DataFrame], only: Iterable[str] | None = None, ordered: bool = False
) -> dict[str, DataFrame]:
    return _frames(plant.gold, silver, only, ordered)


def joined_frame(plant: Plant, gold: Mapping[str, DataFrame]) -> DataFrame:
    return day_join(gold, plant.joined_sides, joined_output())


def joined_inputs(plant: Plant) -> list[str]:
    return [s.table for s in plant.joined_sides]


def fused_daily_balance(plant: Plant, bronze: Mapping[str, DataFrame]) -> DataFrame:
    """bronze -> silver -> gold -> joined table in one plan; only the five needed streams are built."""
    needed = joined_inputs(plant)
    silver_needed = [plant.gold_step(t).source for t in needed]
    silver = silver_frames(plant, bronze, only=silver_needed)
    gold = gold_frames(plant, silver, only=needed)
    return joined_frame(plant, gold)
