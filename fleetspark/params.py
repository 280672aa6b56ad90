"""Every parameter that changes a result, in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime

SECOND_US = 1_000_000
HOUR_US = 3600 * SECOND_US
DAY_US = 24 * HOUR_US

# Quality flags, error codes, components and machine models.
QUALITY_LEVELS = ("ok", "filled", "missing")
ERROR_TYPES = ("error1", "error2", "error3", "error4", "error5")
COMPONENTS = ("comp1", "comp2", "comp3", "comp4")
MODELS = ("model1", "model2", "model3", "model4")

# Additive KPI columns; every ratio is recomputed from their sums.
ADDITIVE = (
    "period_hours",
    "failures",
    "components_failed",
    "planned_maintenances",
    "unplanned_downtime_h",
    "planned_downtime_h",
    "downtime_h",
    "failure_cost",
    "maintenance_cost",
    "total_cost",
)


@dataclass(frozen=True)
class Limit:
    """Inclusive range of believable readings of one sensor."""

    min: float
    max: float

    def __post_init__(self) -> None:
        if not self.min < self.max:
            raise ValueError(f"sensor limit needs min < max, got {self.min} and {self.max}")


@dataclass(frozen=True)
class ComponentCost:
    repair_cost: float
    unplanned_downtime_hours: float
    planned_downtime_hours: float


@dataclass(frozen=True)
class Scenario:
    catch_rate: float
    false_alarms_per_catch: float


def _default_sensors() -> dict[str, Limit]:
    return {
        "volt": Limit(0.0, 300.0),
        "rotate": Limit(0.0, 1000.0),
        "pressure": Limit(0.0, 250.0),
        "vibration": Limit(0.0, 100.0),
    }


def _default_components() -> dict[str, ComponentCost]:
    return {
        "comp1": ComponentCost(40_000, 8, 2),
        "comp2": ComponentCost(60_000, 10, 3),
        "comp3": ComponentCost(35_000, 6, 2),
        "comp4": ComponentCost(75_000, 12, 3),
    }


def _default_scenarios() -> dict[str, Scenario]:
    return {"conservative": Scenario(0.5, 1.0), "expected": Scenario(0.7, 0.5)}


@dataclass(frozen=True)
class FleetParams:
    """Column names, time step, cleaning rules, windows, costs and model dates.

    All time rules count *steps*: with the default step of one hour they are hours, and a
    table with another rhythm only needs another ``step_us``. ``chunk_steps`` is the length
    of the time chunks that window operators are partitioned by (next to the entity), so
    that one very long or very busy entity still spreads over many tasks.
    """

    entity: str = "machine_id"
    time: str = "timestamp"
    step_us: int = HOUR_US
    unit: str = "h"
    chunk_steps: int = 240

    sensors: dict[str, Limit] = field(default_factory=_default_sensors)
    stuck_min_run: int = 3
    max_fill: int = 3
    fill_window: int = 24

    windows: tuple[int, ...] = (3, 24)
    feature_step: int = 3
    horizon: int = 24

    components: dict[str, ComponentCost] = field(default_factory=_default_components)
    error_types: tuple[str, ...] = ERROR_TYPES
    downtime_cost_per_hour: float = 50_000.0
    emergency_premium: float = 1.5
    currency: str = "INR"

    train_end: datetime = datetime(2015, 10, 1)
    validation_start: datetime = datetime(2015, 8, 1)
    seed: int = 42
    boosting_rounds: int = 300  # of every boosted model
    boosting_rows: int | None = None  # that one boosted model learns from, about, at most; None: all
    thresholds: int = 200  # most candidate thresholds, besides "never alert"
    false_alarm_cost: float = 20_000.0
    exclude_features: tuple[str, ...] = ("plant_id", "line_id")

    scenarios: dict[str, Scenario] = field(default_factory=_default_scenarios)
    program_cost: float = 5_000_000.0
    inspection_hours: float = 2.0

    def __post_init__(self) -> None:
        if self.stuck_min_run < 2:
            raise ValueError("stuck_min_run must be at least 2")
        if self.max_fill < 1 or self.fill_window < 2:
            raise ValueError("max_fill must be at least 1 and fill_window at least 2")
        if self.feature_step < 1 or self.horizon < 1 or not self.windows or min(self.windows) < 2:
            raise ValueError("feature_step and horizon must be positive, windows at least 2")
        if self.chunk_steps < 1 or self.step_us < 1:
            raise ValueError("chunk_steps and step_us must be positive")
        if not self.validation_start < self.train_end:
            raise ValueError("validation_start must come before train_end")

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.time]

    @property
    def chunk_us(self) -> int:
        return self.chunk_steps * self.step_us

    def for_events(self) -> FleetParams:
        """The same parameters with one-step chunks, for joins whose rows are raw events.

        Raw events are not bounded per step, so a busy entity needs many more, shorter chunks;
        as-of joins carry one summary row per chunk and copy nothing, so short chunks are cheap.
        """
        return replace(self, chunk_steps=1)

    @property
    def longest(self) -> int:
        return max(self.windows)

    @property
    def shortest(self) -> int:
        return min(self.windows)

    @property
    def horizon_us(self) -> int:
        return self.horizon * self.step_us

    @property
    def target(self) -> str:
        return f"fails_within_{self.horizon}{self.unit}"

    def component_target(self, component: str) -> str:
        return f"{component}_fails_within_{self.horizon}{self.unit}"

    @property
    def label_columns(self) -> list[str]:
        return [
            self.target,
            *[self.component_target(c) for c in self.components],
            "failed_component",
            "hours_to_failure",
        ]
