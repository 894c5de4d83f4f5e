"""Contract scales as SQL expressions: bands, buckets and segments."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from tripgauge.contract import Contract


def number(value: float) -> str:
    """A number as a DOUBLE literal; a bare 1.5 would be a DECIMAL in Spark SQL."""
    return f"{float(value)!r}D"


def text(value: str) -> str:
    """A string literal, whatever quotes the label holds."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def id_list(ids: Iterable[int]) -> str:
    return ", ".join(str(int(i)) for i in ids)


def banded(value: str, edges: Sequence[tuple[float | None, str]]) -> str:
    """Label of the first band whose upper edge is not exceeded; the open band otherwise."""
    *closed, (_, last) = edges
    cases = " ".join(f"WHEN {value} <= {number(edge)} THEN {text(label)}" for edge, label in closed)
    return f"CASE {cases} ELSE {text(last)} END"


def distance_band(distance: str, contract: Contract) -> str:
    return banded(distance, contract.distance_bands)


def time_bucket(hour: str, contract: Contract) -> str:
    return banded(hour, contract.time_buckets)


def segment(zone: str, contract: Contract) -> str:
    return (
        f"CASE WHEN {zone} IN ({id_list(contract.airport_zone_ids)}) THEN 'airport_zone' "
        f"WHEN {zone} BETWEEN 1 AND {contract.last_real_zone_id} THEN 'city_zone' "
        "ELSE 'zone_unknown' END"
    )
