"""The whole run: raw months -> staged, quarantine, facts -> gate -> metrics and slices.

Each layer is a table partitioned by month, written once and read back, so a lost executor
costs a task and not the lineage behind it. All months go through one job per layer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.contract import Contract, ContractAbort, require_publish
from tripgauge.operators import facts as facts_op
from tripgauge.operators import metrics, quality, ruler, rules, slices
from tripgauge.operators.integrity import require_files
from tripgauge.sources import reports
from tripgauge.sources.files import describe_files, require_file_schemas, schema_by_file
from tripgauge.sources.fingerprint import build_manifest
from tripgauge.sources.tables import pointers, read_months, replace_months, write_report_csv


@dataclass(frozen=True)
class RunResult:
    gate_status: str
    gate_reasons: str
    raw_rows: int
    valid_rows: int


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """A small result table, written as one file and read back."""
    df.repartition(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def together(jobs: Sequence[Callable[[], object]]) -> list:
    """Jobs that do not need each other, submitted side by side: small ones wait for no other's last task."""
    with ThreadPoolExecutor(max_workers=min(8, len(jobs))) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def validate(spark: SparkSession, raw: DataFrame, provenance: DataFrame, out: str, contract: Contract,
             months: Sequence[str] | None = None) -> dict:
    """Staged, quarantine and fact tables and the report tables.

    ``raw`` is a month table read from files, of these ``months`` if they are given. Aborts on a file without a contract column, on
    contradicting provenance and on lost rows. Every layer's months of this run are replaced, also by
    nothing, and each month of a layer changes at once.
    """
    quality.require_schema(raw)
    found = raw.inputFiles()
    if not found:
        raise ContractAbort("no input files: retrieve the pages first")
    files = _written(spark, describe_files(spark, found, hashed=True, months=months), f"{out}/manifest_files")
    schemas = schema_by_file(files)
    require_file_schemas(schemas)
    manifest = require_files(_written(
        spark, build_manifest(files, reports.one_per_month(provenance)), f"{out}/manifest"))
    months = [r.month for r in manifest.select("month").collect()]  # bounded by the calendar

    staged = replace_months(rules.stage(raw, contract), f"{out}/staged", months)
    # of the counts there is one row per month: every report below starts from that table
    _, facts, counts = together([
        lambda: replace_months(rules.quarantined(staged), f"{out}/quarantine", months),
        lambda: replace_months(facts_op.fact_trips(staged, contract), f"{out}/facts", months),
        lambda: _written(spark, quality.period_counts(staged), f"{out}/counts")])
    conservation = quality.row_conservation(counts, manifest)
    quality.require_conservation(conservation)
    layers = [pointers(spark, f"{out}/{layer}").where(F.col("month").isin(*months)) for layer in ("staged", "quarantine", "facts")]
    outputs = _written(spark, quality.conservation_of_counts(*layers), f"{out}/report/conservation_of_outputs")
    quality.require_conservation(outputs)
    results = quality.rule_results(counts, contract)
    tables = {
        "rule_results": results,
        "schema": quality.schema_table(raw),
        "schema_by_file": schemas,
        "totals": quality.contract_totals(counts),
        "status_tally": quality.status_tally(results),
        "row_conservation": conservation,
        "integrity_checks": quality.integrity_checks(counts, manifest, contract),
        "gate": quality.publish_gate(counts, manifest, manifest, contract),
    }
    together([partial(_written, spark, df, f"{out}/report/{name}") for name, df in tables.items()])
    return {"staged": staged, "counts": counts, "facts": facts}


def compute_metrics(spark: SparkSession, counts: DataFrame, facts: DataFrame, lookup: DataFrame,
                    out: str, baseline: str, contract: Contract,
                    baseline_facts: DataFrame | None = None) -> None:
    """The scope applies to what is scored; the ruler comes from the whole baseline period.

    The facts are read twice: once for the ruler, of the baseline alone, and once for all tables.
    """
    learnt = facts if baseline_facts is None else baseline_facts
    cells = _written(spark, ruler.build_ruler(learnt, baseline, contract), f"{out}/ruler")
    if cells.isEmpty():
        raise ContractAbort(f"no valid trips in the baseline period {baseline}")
    facts = facts_op.scoped_to(facts, counts)
    one_pass = _written(spark, slices.all_slices(facts, cells, contract), f"{out}/metrics/slices")
    found = slices.slice_tables(one_pass, lookup, contract)
    wide = _written(spark, metrics.wide_of(counts, found["monthly"]), f"{out}/metrics/monthly_wide")
    exports = {
        "expected_duration_baseline": (cells, ["distance_band", "time_bucket"]),
        "metrics_monthly_wide": (wide, ["month"]),
        "metrics_monthly": (metrics.metrics_long(wide), ["month", "metric_id"]),
        "metrics_hourly_detail": (found["hourly"], ["month", "hour"]),
        "metrics_zone_detail": (found["zones"], ["month", "pickup_zone_id"]),
        "metrics_segments": (found["segments"], ["month", "segment"]),
    }
    together([partial(write_report_csv, df, f"{out}/csv/{name}", *keys) for name, (df, keys) in exports.items()])


def run(spark: SparkSession, raw_base: str, provenance: DataFrame, lookup: DataFrame, out: str,
        baseline: str, contract: Contract = Contract(), months: Sequence[str] | None = None,
        publish_required: bool = False) -> RunResult:
    done = validate(spark, read_months(spark, raw_base, months), provenance, out, contract, months)
    baseline_facts = None
    if months is not None and baseline not in months:
        whole = rules.stage(read_months(spark, raw_base, [baseline]), contract)
        baseline_facts = facts_op.fact_trips(whole, contract)
    compute_metrics(spark, done["counts"], done["facts"], lookup, out, baseline, contract, baseline_facts)
    gate = spark.read.parquet(f"{out}/report/gate").first()
    if publish_required:
        require_publish(gate.status, contract)
    return RunResult(gate.status, gate.reasons, gate.raw_rows, gate.valid_rows)
