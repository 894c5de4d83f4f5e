"""The row rules. A rule is a function ``Contract -> condition`` that is TRUE when a row passes.

The condition is a Spark SQL expression or a ``Column`` over the parsed columns that
:func:`parse_trip` adds (``t_*``), so a cell is cast once however many rules look at it. A
condition over a missing value is NULL, and NULL never counts as a pass (:func:`passes`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.contract import Contract
from tripgauge.functions.casts import period_start, read_as, seconds_between
from tripgauge.functions.scales import id_list, number

QUARANTINE = "QUARANTINE"
FLAG = "FLAG"
REPORT = "REPORT"

Predicate = Callable[[Contract], "str | Column"]


@dataclass(frozen=True)
class Rule:
    id: str
    name: str
    category: str
    severity: str
    owner: str
    action: str
    predicate: Predicate | None = None
    fixed_status: str | None = None
    evidence: str | None = None
    description: str = ""

    def __post_init__(self):
        # both become column names and SQL text
        for part in (self.id, self.name):
            if not part.isidentifier():
                raise ValueError(f"rule ids and names are plain identifiers, not {part!r}")

    @property
    def ok_column(self) -> str:
        return f"{self.id.lower()}_ok"


# parsed column -> (source column, type it is read as)
PARSED: dict[str, tuple[str, str]] = {
    "t_pickup": ("tpep_pickup_datetime", "timestamp_ntz"),
    "t_dropoff": ("tpep_dropoff_datetime", "timestamp_ntz"),
    "t_distance": ("trip_distance", "double"),
    "t_passengers": ("passenger_count", "bigint"),
    "t_ratecode": ("ratecodeid", "bigint"),
    "t_payment": ("payment_type", "bigint"),
    "t_vendor": ("vendorid", "bigint"),
    "t_flag": ("store_and_fwd_flag", "string"),
    "t_fare": ("fare_amount", "double"),
    "t_extra": ("extra", "double"),
    "t_tax": ("mta_tax", "double"),
    "t_tip": ("tip_amount", "double"),
    "t_tolls": ("tolls_amount", "double"),
    "t_improvement": ("improvement_surcharge", "double"),
    "t_airport_fee": ("airport_fee", "double"),
    "t_congestion": ("congestion_surcharge", "double"),
    "t_total": ("total_amount", "double"),
    "t_pickup_zone": ("pulocationid", "bigint"),
    "t_dropoff_zone": ("dolocationid", "bigint"),
}
T_COLUMNS = (*PARSED, "t_seconds")

MONEY_PARTS = (
    "t_fare", "t_extra", "t_tax", "t_tip", "t_tolls", "t_improvement",
    "t_airport_fee", "t_congestion",
)
# surcharges introduced late: a missing one is read as 0 in the money check
LATE_SURCHARGES = frozenset({"t_airport_fee", "t_congestion"})


def parse_trip(df: DataFrame) -> DataFrame:
    """Add the ``t_*`` columns: every source cell read as its contract type, NULL if unreadable."""
    typed = [f"{read_as(df, source, kind)} AS {name}" for name, (source, kind) in PARSED.items()
             if name != "t_flag"]
    flag = f"upper({read_as(df, *PARSED['t_flag'])}) AS t_flag"
    seconds = seconds_between("t_pickup", "t_dropoff")
    return df.selectExpr("*", *typed, flag).selectExpr("*", f"{seconds} AS t_seconds")


def money_parts(optional: frozenset[str] | set[str] = LATE_SURCHARGES) -> str:
    """Sum of the money components; a missing part listed in ``optional`` counts as 0."""
    return "(" + " + ".join(
        f"coalesce({name}, 0D)" if name in optional else name for name in MONEY_PARTS) + ")"


def _rule(id_: str, name: str, category: str, severity: str, owner: str, action: str,
          predicate: Predicate) -> Rule:
    """``action`` is what is done and, after a colon, what the rule is about."""
    done, _, about = action.partition(": ")
    return Rule(id_, name, category, severity, owner, done, predicate,
                evidence=f"failures of {id_} per period", description=about)


# fixed values: rule ids, names, categories and severities
RULES: tuple[Rule, ...] = (
    _rule("R00", "timestamps_parseable", "technical", QUARANTINE, "data engineering",
          "set aside: without both times there is no duration",
          lambda c: "t_pickup IS NOT NULL AND t_dropoff IS NOT NULL"),
    _rule("R01", "dropoff_after_pickup", "technical", QUARANTINE, "data engineering",
          "set aside: duration must be positive",
          lambda c: "t_dropoff > t_pickup"),
    _rule("R02", "duration_within_24h", "technical", QUARANTINE, "client",
          "set aside: longer than the owned limit is treated as a meter error",
          lambda c: "t_dropoff <= t_pickup + "
          f"make_dt_interval(0, 0, 0, {int(c.duration_max_seconds)})"),
    _rule("R03", "pickup_in_file_month", "technical", QUARANTINE, "data engineering",
          "set aside: the row belongs to another period than the partition claims",
          lambda c: f"trunc(CAST(t_pickup AS DATE), '{c.period_unit}') = "
          f"{period_start('month', c.period_unit)}"),
    _rule("R04", "pickup_zone_known", "technical", QUARANTINE, "data engineering",
          "set aside: no usable pickup location",
          lambda c: f"t_pickup_zone BETWEEN 1 AND {c.max_zone_id}"),
    _rule("R05", "dropoff_zone_known", "technical", QUARANTINE, "data engineering",
          "set aside: no usable dropoff location",
          lambda c: f"t_dropoff_zone BETWEEN 1 AND {c.max_zone_id}"),
    _rule("R06", "distance_in_range", "technical", QUARANTINE, "data engineering",
          "set aside: no distance band can be assigned",
          lambda c: f"t_distance > 0 AND t_distance <= {number(c.distance_max_miles)}"),
    _rule("R07", "passenger_count_plausible", "semantic", FLAG, "client",
          "keep and report: outside 1..6 needs an owner's meaning",
          lambda c: "t_passengers BETWEEN 1 AND 6"),
    _rule("R08", "money_non_negative", "technical", FLAG, "finance",
          "keep and report: corrections and chargebacks",
          lambda c: "t_fare >= 0 AND t_total >= 0"),
    _rule("R09", "total_matches_components", "technical", FLAG, "finance",
          "keep and report: total and parts differ by more than the tolerance",
          lambda c: f"abs(t_total - {money_parts()}) <= {number(c.money_tolerance_usd)}"),
    _rule("R10", "ratecode_known", "semantic", FLAG, "client",
          "keep and report: rate code outside 1..6",
          lambda c: "t_ratecode IN (1, 2, 3, 4, 5, 6)"),
    _rule("R11", "store_and_fwd_known", "semantic", FLAG, "client",
          "keep and report: flag is neither Y nor N",
          lambda c: "t_flag IN ('Y', 'N')"),
    _rule("R12", "vendor_known", "technical", FLAG, "data engineering",
          "keep and report: vendor id not seen before",
          lambda c: f"t_vendor IN ({id_list(c.known_vendor_ids)})"),
    _rule("R13", "payment_type_known", "semantic", FLAG, "client",
          "keep and report: payment type outside 1..6",
          lambda c: "t_payment BETWEEN 1 AND 6"),
    _rule("R14", "pickup_zone_resolved", "semantic", FLAG, "data engineering",
          "keep and disclose: pickup zone is a placeholder",
          lambda c: f"t_pickup_zone NOT IN ({id_list(c.unresolved_zone_ids)})"),
    _rule("R15", "dropoff_zone_resolved", "semantic", FLAG, "data engineering",
          "keep and disclose: dropoff zone is a placeholder",
          lambda c: f"t_dropoff_zone NOT IN ({id_list(c.unresolved_zone_ids)})"),
)

# open questions and limits: no predicate can decide them, their status is fixed
# fixed values: ids, names and categories
FIXED_ENTRIES: tuple[Rule, ...] = (
    Rule("U1", "ratecode_99_undefined", "semantic", REPORT, "client",
         "ask the owner for a definition", None, "UNKNOWN", "seen as failures of R10",
         "a rate code that the code list does not explain"),
    Rule("U2", "passenger_zero_or_high", "semantic", REPORT, "client",
         "kept, flagged by R07", None, "UNKNOWN", "seen as failures of R07",
         "no passenger, or more than a cab holds"),
    Rule("U3", "zero_distance_positive_fare", "semantic", REPORT, "client",
         "set aside by R06, cause open", None, "UNKNOWN", "subset of the failures of R06",
         "money without a distance"),
    Rule("U4", "vendor_id_6_undocumented", "semantic", REPORT, "client",
         "accepted by R12 for now", None, "UNKNOWN", "vendor 6 is in the known set",
         "a vendor that the code list lacks"),
    Rule("U5", "missing_trip_metadata_cohort", "semantic", REPORT, "client",
         "kept, flagged by R10, R11 and R13", None, "UNKNOWN",
         "see the missing-metadata cohort profile", "rows without any trip metadata"),
    Rule("L1", "meter_accuracy_disclaimer", "organizational", REPORT, "source owner",
         "recorded: validation cannot repair it", None, "UNKNOWN", "published by the source",
         "the source does not vouch for its meters"),
)


def all_rules() -> tuple[Rule, ...]:
    return RULES + FIXED_ENTRIES


def quarantine_rules(contract: Contract, rules: Sequence[Rule] = RULES) -> tuple[Rule, ...]:
    """The contract's list decides, not the severity written on the rule."""
    return tuple(r for r in rules if r.predicate is not None and r.id in contract.quarantine)


def flag_rules(contract: Contract, rules: Sequence[Rule] = RULES) -> tuple[Rule, ...]:
    return tuple(r for r in rules if r.predicate is not None and r.id not in contract.quarantine)


def passes(condition: str) -> str:
    """A rule that cannot be evaluated has not been passed."""
    return f"coalesce({condition}, false)"


def apply_rules(df: DataFrame, contract: Contract, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add one nullable ``rNN_ok`` column per rule. Needs the ``t_*`` columns."""
    outcomes = []
    for r in rules:
        if r.predicate is None:
            continue
        ok = r.predicate(contract)
        outcomes.append((F.expr(ok) if isinstance(ok, str) else ok).alias(r.ok_column))
    return df.select("*", *outcomes)


def reason_codes(contract: Contract, rules: Sequence[Rule] = RULES) -> str:
    """Rule-ordered ';' list of the failed quarantine rules, NULL when there is none."""
    failed = ", ".join(
        f"CASE WHEN NOT {passes(r.ok_column)} THEN '{r.id}' END"
        for r in quarantine_rules(contract, rules))
    return f"nullif(concat_ws(';', {failed}), '')"


def stage(df: DataFrame, contract: Contract, rules: Sequence[Rule] = RULES) -> DataFrame:
    """All rows, one outcome per rule and the reason codes, in a single projection."""
    return apply_rules(parse_trip(df), contract, rules).selectExpr(
        "*", f"{reason_codes(contract, rules)} AS fail_reasons").drop(*T_COLUMNS)


def passing(df: DataFrame, contract: Contract, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The valid rows straight from the source, for jobs that need no staged table.

    The quarantine rules form a plain conjunction (a NULL outcome keeps no row), so each of
    them can be pushed towards the scan on its own.
    """
    out = apply_rules(parse_trip(df), contract, rules)
    return out.where(" AND ".join(r.ok_column for r in quarantine_rules(contract, rules)))


def quarantined(staged: DataFrame) -> DataFrame:
    return staged.where("fail_reasons IS NOT NULL")


def valid(staged: DataFrame) -> DataFrame:
    return staged.where("fail_reasons IS NULL")


def rule_outcomes(df: DataFrame, contract: Contract, rule: Rule) -> DataFrame:
    """Pass / fail / cannot-tell counts of one rule; only the columns it reads are scanned."""
    return apply_rules(parse_trip(df), contract, [rule]).selectExpr(
        f"'{rule.id}' AS rule_id",
        f"count_if({rule.ok_column}) AS passed",
        f"count_if(NOT {rule.ok_column}) AS failed",
        f"count_if({rule.ok_column} IS NULL) AS unknown",
    )
