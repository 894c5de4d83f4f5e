"""Times the headline queries and prints one JSON line.

Every query runs once to warm up the JVM, then the better of two runs counts. A run ends when
all result rows have been produced (a ``noop`` write), so nothing is cut short by a limit.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripgauge.plans import pipeline, registry
from tripgauge.plans.bindings import Fulfilment
from tripgauge.session import SETTINGS, scratch_dir
from tripgauge.sources.tables import read_months, write_sorted_months

HEADLINE = (
    "month_rule_counts", "rule_results", "publish_gate", "duplicate_audit",
    "count_reconciliation", "quarantine_rows", "fact_projection", "duration_quantiles",
    "ruler_p80", "m2_reliability", "m5_slow_share", "monthly_facts", "hourly_detail",
    "zone_detail", "segments", "mix_adjusted_reliability",
)


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stages(spark: SparkSession, sf_dir: str, copies: int, rounds: int) -> dict[str, float]:
    """The pipeline's own stages over the order lines, each taken `copies` times: land once, then
    validate (all tables and reports) and the month metrics. The last round is reported."""
    out = scratch_dir(spark, f"bench-{copies}")
    b = Fulfilment(spark, sf_dir)
    # copies differ in their durations, so that they do not collapse when equal values are counted
    later = "CAST(CAST(tpep_dropoff_datetime AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, 0, (copy - 1) * 61 + order_key % 59) AS STRING)"
    spread = b.raw.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumn("tpep_dropoff_datetime", F.expr(later))
    write_sorted_months(spread.drop("copy"), f"{out}/raw")
    raw = read_months(spark, f"{out}/raw")
    provenance = raw.groupBy("month").count().selectExpr(
        "month", "count AS api_count", "count AS rows_stored", "true AS count_reconciled",
        "1L AS pages", "0L AS composite_key_duplicates")
    lookup = b.table("nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS pickup_zone_id", "n_name AS pickup_zone",
        "n_name AS borough")
    took: dict[str, float] = {}
    for _ in range(rounds):
        done: dict = {}
        took["validate"] = timed(lambda: done.update(
            pipeline.validate(spark, raw, provenance, out, b.contract)))
        took["metrics"] = timed(lambda: pipeline.compute_metrics(
            spark, done["counts"], done["facts"], lookup, out, "1996-01", b.contract))
    return took | {"rows": raw.count(), "valid_rows": done["facts"].count()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries = registry.build()
    seconds = {}
    for name in HEADLINE:
        run = lambda: drain(queries[name](spark, sf_dir))
        run()
        seconds[name] = round(min(timed(run), timed(run)), 3)
    small, large = stages(spark, sf_dir, 1, 2), stages(spark, sf_dir, 4, 1)
    per_row = {k: (large[k] - small[k]) / (large["rows"] - small["rows"]) for k in ("validate", "metrics")}
    seconds.update({f"stage_{k}": round(small[k], 3) for k in per_row})
    print(json.dumps({
        "metric": "headline queries and pipeline stages, total",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "pipeline_rows": small["rows"], "pipeline_valid_rows": small["valid_rows"],
        "pipeline_4x": {f"stage_{k}": round(large[k], 3) for k in per_row},
        "pipeline_us_per_row": {k: round(v * 1e6, 3) for k, v in per_row.items()},
        "pipeline_fixed_s": {k: round(small[k] - v * small["rows"], 3) for k, v in per_row.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
