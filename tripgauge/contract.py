"""The data contract: columns, limits, tolerances and scales, owned in one place.

Everything an operator may need to decide about a row comes from a ``Contract``
instance; no operator keeps a threshold of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any, Mapping

# --- fixed values: the 19 source columns and the type each one is read as -------------
TRIP_COLUMNS: dict[str, str] = {
    "vendorid": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "ratecodeid": "bigint",
    "store_and_fwd_flag": "string",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "airport_fee": "double",
    "congestion_surcharge": "double",
    "total_amount": "double",
    "pulocationid": "bigint",
    "dolocationid": "bigint",
}

# fixed values: an older money column that some pages still carry
LEGACY_COLUMNS: dict[str, str] = {"imp_surcharge": "double"}

# fixed values: there is no trip id, so these columns stand in for one in the audits
COMPOSITE_KEY: tuple[str, ...] = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pulocationid",
    "dolocationid",
    "trip_distance",
    "fare_amount",
    "total_amount",
)

# fixed values: (warn, fail) share of failing rows per rule
DEFAULT_TOLERANCES: dict[str, tuple[float, float]] = {
    "R00": (0.001, 0.01),
    "R01": (0.01, 0.05),
    "R02": (0.001, 0.01),
    "R03": (0.001, 0.01),
    "R04": (0.01, 0.05),
    "R05": (0.01, 0.05),
    "R06": (0.02, 0.05),
    "R07": (0.05, 0.10),
    "R08": (0.02, 0.05),
    "R09": (0.02, 0.10),
    "R10": (0.05, 0.10),
    "R11": (0.05, 0.10),
    "R12": (0.001, 0.01),
    "R13": (0.05, 0.10),
    "R14": (0.02, 0.05),
    "R15": (0.02, 0.05),
}

# fixed values: (upper edge, label); the last label has no edge
DEFAULT_DISTANCE_BANDS: tuple[tuple[float | None, str], ...] = (
    (1.0, "a_0-1mi"),
    (2.0, "b_1-2mi"),
    (5.0, "c_2-5mi"),
    (10.0, "d_5-10mi"),
    (20.0, "e_10-20mi"),
    (None, "f_20mi_plus"),
)

# fixed values: (last hour of the bucket, label); the last label has no edge
DEFAULT_TIME_BUCKETS: tuple[tuple[int | None, str], ...] = (
    (5, "overnight_00-06"),
    (9, "am_peak_06-10"),
    (15, "midday_10-16"),
    (19, "pm_peak_16-20"),
    (None, "evening_20-24"),
)

# fixed values: (largest absolute gap, label) of the money residual report
DEFAULT_RESIDUAL_BANDS: tuple[tuple[float | None, str], ...] = (
    (0.01, "exact"),
    (2.5, "$0.01-2.50"),
    (5.0, "$2.50-5"),
    (None, "> $5"),
)


class ContractAbort(RuntimeError):
    """The input or the job breaks the contract; nothing may be published."""


@dataclass(frozen=True)
class Contract:
    # zones
    max_zone_id: int = 265
    unresolved_zone_ids: tuple[int, ...] = (264, 265)
    airport_zone_ids: tuple[int, ...] = (1, 132)
    known_vendor_ids: tuple[int, ...] = (1, 2, 6)
    # limits
    duration_max_seconds: int = 86_400
    distance_max_miles: float = 200.0
    money_tolerance_usd: float = 5.0
    # which rules take a row out of the KPI population, and when the report is held
    quarantine: tuple[str, ...] = ("R00", "R01", "R02", "R03", "R04", "R05", "R06")
    tolerances: Mapping[str, tuple[float, float]] = field(
        default_factory=lambda: dict(DEFAULT_TOLERANCES)
    )
    min_valid_coverage: float = 0.90
    publish_label: str = "PUBLISH"
    hold_label: str = "HOLD"
    # retrieval integrity: duplicates allowed per row, and at least this many
    duplicate_rate_max: float = 0.0001
    duplicate_floor: int = 1
    # KPI
    slow_speed_mph: float = 6.0
    ruler_percentile: float = 0.80
    min_zone_trips: int = 1000
    disclose_rate: float = 0.01
    # how far the baseline period may score from the ruler's own percentile
    fairness_tolerance: float = 0.01
    distance_bands: tuple[tuple[float | None, str], ...] = DEFAULT_DISTANCE_BANDS
    time_buckets: tuple[tuple[int | None, str], ...] = DEFAULT_TIME_BUCKETS
    residual_bands: tuple[tuple[float | None, str], ...] = DEFAULT_RESIDUAL_BANDS
    # the calendar unit a landed partition claims: 'month' (label 2023-01) or
    # 'week' (label is the Monday, 2024-01-01)
    period_unit: str = "month"

    @property
    def last_real_zone_id(self) -> int:
        return self.unresolved_zone_ids[0] - 1

    @property
    def ruler_cells(self) -> int:
        """Most rows a ruler can have: what makes broadcasting it safe at any scale."""
        return len(self.distance_bands) * len(self.time_buckets)

    def with_(self, **changes: Any) -> "Contract":
        return replace(self, **changes)

    @classmethod
    def from_mapping(cls, cfg: Mapping[str, Any]) -> "Contract":
        """Build from a nested config (zones / limits / quarantine / gate / tolerances)."""
        flat: dict[str, Any] = {}
        for block in ("zones", "limits", "kpi"):
            flat.update(cfg.get(block, {}))
        gate = cfg.get("gate", {})
        flat.update(gate)
        if "quarantine" in cfg:
            flat["quarantine"] = cfg["quarantine"]
        if "tolerances" in cfg:
            flat["tolerances"] = {
                rule: (float(t["warn"]), float(t["fail"]))
                for rule, t in cfg["tolerances"].items()
            }
        unknown = sorted(set(flat) - set(cls.__dataclass_fields__)) + sorted(
            set(cfg) - {"zones", "limits", "kpi", "gate", "quarantine", "tolerances"})
        if unknown:
            raise ContractAbort(f"settings that no contract has: {unknown}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in flat.items()})


def require_publish(gate_status: str, contract: Contract) -> None:
    """Stop a publishing job when the gate says hold."""
    if gate_status != contract.publish_label:
        raise ContractAbort(f"gate is {gate_status}, publishing was required")
