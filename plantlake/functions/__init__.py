"""Column-level building blocks: time grid, stable rounding, measures, JSON unpacking."""

from plantlake.functions.exactsum import exact_avg, exact_sum
from plantlake.functions.jsoncols import JsonUnpack, unpack
from plantlake.functions.measures import Measure, avg, delta, high, low, mean, total
from plantlake.functions.rounding import stable_round
from plantlake.functions.timegrid import bucket_start, day_of, hour_start

__all__ = [
    "JsonUnpack",
    "Measure",
    "avg",
    "bucket_start",
    "day_of",
    "delta",
    "exact_avg",
    "exact_sum",
    "high",
    "hour_start",
    "low",
    "mean",
    "stable_round",
    "total",
    "unpack",
]
