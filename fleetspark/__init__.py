"""Spark-native analytics for fleets of sensor-equipped machines."""

from fleetspark.params import ComponentCost, FleetParams, Limit, Scenario

__all__ = ["ComponentCost", "FleetParams", "Limit", "Scenario"]
__version__ = "0.1.0"
