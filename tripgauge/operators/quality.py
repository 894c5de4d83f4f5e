"""From staged rows to the publishing decision: counts, rates, conservation, gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tripgauge.contract import TRIP_COLUMNS, Contract, ContractAbort
from tripgauge.functions.casts import exprs, ratio, rounded_decimal
from tripgauge.functions.scales import number, text
from tripgauge.operators.rules import FIXED_ENTRIES, RULES, Rule, passes


# --- schema conformance ----------------------------------------------------------------
def schema_report(columns: Sequence[str], wanted: Sequence[str] = tuple(TRIP_COLUMNS)) -> dict:
    """Case-insensitive: a missing column fails, an extra one is only recorded."""
    have, want = {c.lower() for c in columns}, {c.lower() for c in wanted}
    missing = sorted(want - have)
    return {
        "status": "FAIL" if missing else "PASS",
        "missing_columns": missing,
        "unexpected_columns": sorted(have - want),
    }


def require_schema(df: DataFrame, wanted: Sequence[str] = tuple(TRIP_COLUMNS)) -> dict:
    report = schema_report([c for c in df.columns if c != "month"], wanted)
    if report["status"] == "FAIL":
        raise ContractAbort(f"columns missing from the input: {report['missing_columns']}")
    return report


def schema_table(df: DataFrame) -> DataFrame:
    """The schema report as one row."""
    report = schema_report([c for c in df.columns if c != "month"])
    return df.sparkSession.createDataFrame(
        [(report["status"], report["missing_columns"], report["unexpected_columns"])],
        "status string, missing_columns array<string>, unexpected_columns array<string>")


# --- counts ------------------------------------------------------------------------------
def _executable(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.predicate is not None]


def fails_column(rule: Rule) -> str:
    return f"{rule.id.lower()}_fails"


def period_counts(staged: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows, valid rows, quarantined rows and failures per rule, per period, in one pass.

    What was written of them is counted by ``conservation_of_outputs``.
    """
    return staged.groupBy("month").agg(*exprs(
        "count(1) AS total_rows",
        "count_if(fail_reasons IS NULL) AS valid_rows",
        "count_if(fail_reasons IS NOT NULL) AS quarantined_rows",
        *[f"count_if(NOT {passes(r.ok_column)}) AS {fails_column(r)}" for r in _executable(rules)],
    ))


def _coverage(valid: str, total: str) -> str:
    return f"coalesce({rounded_decimal(ratio(valid, total), 6)}, 0D)"


def period_coverage(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        "month", "total_rows", "valid_rows", "quarantined_rows",
        f"{_coverage('valid_rows', 'total_rows')} AS coverage")


def contract_totals(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        "count(1) AS periods", "sum(total_rows) AS raw_rows", "sum(valid_rows) AS valid_rows",
        "sum(quarantined_rows) AS quarantined_rows",
        "bool_and(valid_rows + quarantined_rows = total_rows) AS all_rows_accounted",
        f"{_coverage('sum(valid_rows)', 'sum(total_rows)')} AS coverage")


# --- rule results ------------------------------------------------------------------------
def status_of(rate: str, warn: float, fail: float) -> str:
    """Equality with a tolerance does not exceed it."""
    return (f"CASE WHEN {rate} > {number(fail)} THEN 'FAIL' "
            f"WHEN {rate} > {number(warn)} THEN 'WARN' ELSE 'PASS' END")


def _rule_sums(counts: DataFrame, rules: Sequence[Rule], *more: str) -> DataFrame:
    """One row: failures per rule and rows over all periods."""
    sums = [f"coalesce(sum({fails_column(r)}), 0) AS {fails_column(r)}" for r in rules]
    return counts.selectExpr(
        "coalesce(sum(total_rows), 0) AS raw_rows", "coalesce(sum(valid_rows), 0) AS valid_rows",
        *sums, *more)


def _rate(rule: Rule) -> str:
    return f"coalesce({ratio(fails_column(rule), 'raw_rows')}, 0D)"


def _result_row(rule: Rule, failures: str, rate: str, warn: str, fail: str, status: str) -> str:
    return (
        f"named_struct('id', '{rule.id}', 'name', '{rule.name}', 'category', {text(rule.category)}, "
        f"'severity', {text(rule.severity)}, 'failures', {failures}, 'fail_rate', {rate}, "
        f"'warn', {warn}, 'fail', {fail}, 'status', {status}, 'description', {text(rule.description)}, "
        f"'owner', {text(rule.owner)}, 'action', {text(rule.action)}, 'evidence', {text(rule.evidence or '')})")


def rule_results(counts: DataFrame, contract: Contract, rules: Sequence[Rule] = RULES,
                 fixed: Sequence[Rule] = FIXED_ENTRIES) -> DataFrame:
    """One row per rule with failures, rate and status, and what a reader needs beside them:
    meaning, owner, action, evidence. Fixed entries follow with NULL counts.

    The sums form one row, which is unfolded into a row per rule: the data is read once.
    """
    rows = []
    for r in _executable(rules):
        warn, fail = contract.tolerances[r.id]
        rows.append(_result_row(
            r, f"CAST({fails_column(r)} AS BIGINT)", rounded_decimal(_rate(r), 6), number(warn),
            number(fail), status_of(_rate(r), warn, fail)))
    no_count, no_rate = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
    for r in fixed:
        rows.append(_result_row(r, no_count, no_rate, no_rate, no_rate, f"'{r.fixed_status}'"))
    return _rule_sums(counts, _executable(rules)).selectExpr(f"inline(array({', '.join(rows)}))")


def status_tally(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(*exprs("count(1) AS rules"))


def disclosures(results: DataFrame, contract: Contract) -> DataFrame:
    """What must be said beside the KPI: warnings, and passes with a rate worth naming."""
    return results.where(
        f"status = 'WARN' OR (status = 'PASS' AND fail_rate > {number(contract.disclose_rate)})"
    ).select("id", "name", "status", "fail_rate")


# --- conservation and integrity ----------------------------------------------------------
_CONSERVED = passes("manifest_rows = total_rows AND valid_rows + quarantined_rows = total_rows")
_RECONCILED = passes("api_count = total_rows")


def _retrieved(contract: Contract) -> str:
    allowed = (f"greatest({int(contract.duplicate_floor)}, "
               f"floor({number(contract.duplicate_rate_max)} * total_rows))")
    return f"({_RECONCILED} AND coalesce(composite_key_duplicates, 0) <= {allowed})"


def _with_manifest(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    return counts.join(manifest.selectExpr("month", "row_count AS manifest_rows"), "month", "full")


def _with_provenance(counts: DataFrame, provenance: DataFrame) -> DataFrame:
    wanted = provenance.select("month", "api_count", "composite_key_duplicates")
    return counts.join(wanted, "month", "left")


def row_conservation(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows the manifest promises against rows staged, and against both outputs together."""
    return _with_manifest(counts, manifest).selectExpr(
        "month", "manifest_rows", "total_rows AS staged_rows", "valid_rows", "quarantined_rows",
        f"{_CONSERVED} AS ok")


def conservation_of_outputs(staged: DataFrame, quarantine: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows of the written tables, each counted on its own, per period: staged = facts + quarantine.

    Partial counts are combined before the shuffle; periods that any of the tables has are there.
    """
    return conservation_of_counts(*(df.groupBy("month").agg(*exprs("count(1) AS rows")) for df in (staged, quarantine, facts)))


def conservation_of_counts(staged: DataFrame, quarantine: DataFrame, facts: DataFrame) -> DataFrame:
    """The same from counts (month, rows) of the three tables; a period without rows anywhere is left out."""
    parts = [df.where("rows > 0").selectExpr(
        "month", *[f"{'rows' if name == n else '0L'} AS {n}" for n in ("staged_rows", "quarantine_rows", "fact_rows")])
        for df, name in ((staged, "staged_rows"), (quarantine, "quarantine_rows"), (facts, "fact_rows"))]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("month").agg(*exprs(
        "sum(staged_rows) AS staged_rows", "sum(quarantine_rows) AS quarantine_rows",
        "sum(fact_rows) AS fact_rows")).selectExpr(
        "*", "staged_rows = quarantine_rows + fact_rows AS ok")


def require_conservation(conservation: DataFrame) -> None:
    if not conservation.where("NOT ok").isEmpty():
        raise ContractAbort("row conservation broken: written rows differ from what was promised")


def integrity_checks(counts: DataFrame, provenance: DataFrame, contract: Contract) -> DataFrame:
    """Was each period retrieved whole, and are its duplicates within the allowance?

    The stored counts are compared again rather than trusting a stored verdict.
    """
    duplicate_rate = rounded_decimal(ratio("composite_key_duplicates", "total_rows"), 8)
    return _with_provenance(counts, provenance).selectExpr(
        "month", "api_count", "total_rows AS rows_staged",
        f"{_RECONCILED} AS api_count_reconciled", "composite_key_duplicates",
        f"{duplicate_rate} AS duplicate_rate", f"{_retrieved(contract)} AS ok")


# fixed values: the reasons a report is held for
SCHEMA_REASON = "schema conformance FAIL"
CONSERVATION_REASON = "row conservation broken (staged != manifest)"
INTEGRITY_REASON = "retrieval integrity check failed (API reconciliation or duplicates)"
COVERAGE_REASON = "valid coverage %.3f < min {minimum}"
RULE_REASON = "rule {id} ({name}) FAIL rate=%.4f"


# --- gate --------------------------------------------------------------------------------
def publish_gate(counts: DataFrame, manifest: DataFrame, provenance: DataFrame,
                 contract: Contract, rules: Sequence[Rule] = RULES,
                 schema_ok: bool = True) -> DataFrame:
    """One row: PUBLISH or HOLD and why. Any reason holds, flag rules included.

    Everything is decided on the per-period counts joined with manifest and provenance, so
    the staged rows are read once for the whole decision.
    """
    executable = _executable(rules)
    per_period = _with_manifest(_with_provenance(counts, provenance), manifest)
    staged_only = f"CASE WHEN total_rows IS NOT NULL THEN {_retrieved(contract)} END"
    one = _rule_sums(
        per_period, executable,
        f"coalesce(bool_and({_CONSERVED}), true) AS conserved",
        f"coalesce(bool_and({staged_only}), true) AS retrieved")
    coverage = f"coalesce({ratio('valid_rows', 'raw_rows')}, 0D)"
    minimum = contract.min_valid_coverage
    low_coverage = COVERAGE_REASON.format(minimum=minimum)
    reasons = [
        (f"NOT {str(schema_ok).lower()}", f"'{SCHEMA_REASON}'"),
        ("NOT conserved", f"'{CONSERVATION_REASON}'"),
        ("NOT retrieved", f"'{INTEGRITY_REASON}'"),
        (f"{coverage} < {number(minimum)}",
         f"format_string('{low_coverage}', {rounded_decimal(coverage, 3)})"),
    ]
    for r in executable:
        _, fail = contract.tolerances[r.id]
        reason = RULE_REASON.format(id=r.id, name=r.name)
        reasons.append((f"{_rate(r)} > {number(fail)}",
                        f"format_string('{reason}', {rounded_decimal(_rate(r), 4)})"))
    why = ", ".join(f"CASE WHEN {test} THEN {said} END" for test, said in reasons)
    return one.selectExpr(
        "raw_rows", "valid_rows", f"{rounded_decimal(coverage, 6)} AS coverage",
        f"array_compact(array({why})) AS why",
    ).selectExpr(
        f"CASE WHEN size(why) > 0 THEN {text(contract.hold_label)} "
        f"ELSE {text(contract.publish_label)} END AS status",
        "raw_rows", "valid_rows", "coverage", "CAST(size(why) AS BIGINT) AS n_reasons",
        "concat_ws('; ', why) AS reasons")
