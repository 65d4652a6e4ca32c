"""plantlake: plant-telemetry lakehouse rollups as lazy Spark DataFrame plans."""

__version__ = "0.1.0"
