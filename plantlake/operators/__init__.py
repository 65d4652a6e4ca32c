"""DataFrame operators: declarative rollups and the daily join."""

from plantlake.operators.daily_join import DaySide, day_join, energy_balance, join_on_day, stack_on_day
from plantlake.operators.rollup import Chain, Rollup

__all__ = ["Chain", "DaySide", "Rollup", "day_join", "energy_balance", "join_on_day", "stack_on_day"]
