"""Trips made for the tests: one crafted row per case, and plain sample months."""

from __future__ import annotations

from tripgauge.contract import TRIP_COLUMNS

COLUMNS = list(TRIP_COLUMNS)
MONTHS = ("2021-06", "2021-07")
MONTH = MONTHS[0]
PER_MONTH, MINUTES = 48, 24.0

PLAIN = dict(zip(COLUMNS, (
    "1", "2021-06-17 14:05:00", "2021-06-17 14:33:00", "2", "6.25", "3", "Y", "4", "21.40", "1.25", "0.30", "2.05",
    "0.75", "0.25", "1.50", "2.50", "30.00", "77", "12")))


def _times(pickup: str, dropoff: str) -> dict[str, str]:
    return {"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": dropoff}


# case -> (cells that differ from the plain trip, rules that fail)
CASES: dict[str, tuple[dict, str]] = {
    "plain": ({}, ""),
    "distance above the limit": ({"trip_distance": "200.01"}, "R06"),
    "distance at the limit": ({"trip_distance": "200"}, ""),
    "distance below zero": ({"trip_distance": "-1"}, "R06"),
    "distance not a number": ({"trip_distance": "NaN"}, "R06"),
    "distance missing": ({"trip_distance": None}, "R06"),
    "one second over a day": (_times("2021-06-20 00:00:00", "2021-06-21 00:00:01"), "R02"),
    "a whole day": (_times("2021-06-20 00:00:00", "2021-06-21 00:00:00"), ""),
    "no time passes": (_times("2021-06-03 23:59:59", "2021-06-03 23:59:59"), "R01"),
    "time runs back": (_times("2021-06-03 12:00:01", "2021-06-03 12:00:00"), "R01"),
    "last second of the month before": (_times("2021-05-31 23:59:59", "2021-06-01 00:20:00"), "R03"),
    "ends in the next month": (_times("2021-06-30 23:50:00", "2021-07-01 00:10:00"), ""),
    "no readable times": (_times("no time", "-"), "R00 R01 R02 R03"),
    "year only": ({"tpep_pickup_datetime": "2021"}, "R00 R01 R02 R03"),
    "dropoff unreadable": ({"tpep_dropoff_datetime": "later"}, "R00 R01 R02"),
    "pickup zone zero": ({"pulocationid": "0"}, "R04"),
    "pickup zone beyond": ({"pulocationid": "266"}, "R04"),
    "pickup zone missing": ({"pulocationid": None}, "R04 R14"),
    "dropoff zone beyond": ({"dolocationid": "400"}, "R05"),
    "dropoff zone missing": ({"dolocationid": None}, "R05 R15"),
    "pickup placeholder": ({"pulocationid": "265"}, "R14"),
    "dropoff placeholder": ({"dolocationid": "264"}, "R15"),
    "no passenger": ({"passenger_count": "0"}, "R07"),
    "seven passengers": ({"passenger_count": "7"}, "R07"),
    "six passengers as a decimal": ({"passenger_count": "6.0"}, ""),
    "negative total": ({"fare_amount": "-40.00", "total_amount": "-31.40"}, "R08"),
    "parts off by more than five": ({"total_amount": "35.01"}, "R09"),
    "parts off by five": ({"total_amount": "35.00"}, ""),
    "tip missing": ({"tip_amount": None}, "R09"),
    "late fees missing": ({"airport_fee": None, "congestion_surcharge": None}, ""),
    "rate code beyond": ({"ratecodeid": "7"}, "R10"),
    "no metadata": ({"ratecodeid": None, "passenger_count": None, "store_and_fwd_flag": None}, "R07 R10 R11"),
    "flag unknown": ({"store_and_fwd_flag": "?"}, "R11"),
    "flag in lower case": ({"store_and_fwd_flag": "n"}, ""),
    "vendor unknown": ({"vendorid": "3"}, "R12"),
    "vendor six": ({"vendorid": "6"}, ""),
    "payment zero": ({"payment_type": "0"}, "R13"),
    "several at once": ({"vendorid": "8", "trip_distance": "0", "pulocationid": "999", "payment_type": "11"}, "R04 R06 R12 R13"),
}
NAMES = list(CASES)
CRAFTED: list[tuple[dict, set[str]]] = [({**PLAIN, **cells}, set(failed.split())) for cells, failed in CASES.values()]


def crafted_frame(spark):
    rows = [tuple(r[c] for c in COLUMNS) + (MONTH, i) for i, (r, _) in enumerate(CRAFTED)]
    schema = ", ".join(f"{c} string" for c in COLUMNS) + ", month string, i int"
    return spark.createDataFrame(rows, schema)


def sample_months(spark, months=MONTHS):
    """Per month PER_MONTH valid trips of MINUTES each; every zone has one trip."""
    parts = {"extra": 0.25, "mta_tax": 0.3, "tip_amount": 1.2, "tolls_amount": 0.0, "improvement_surcharge": 0.3,
             "airport_fee": 0.0, "congestion_surcharge": 2.75}
    fare = "6.5D + 0.25D * (k % 17)"
    chosen = " UNION ALL ".join(f"SELECT '{m}' AS month" for m in months)
    pickup = "CAST(month || '-01' AS DATE) + CAST(k % 27 AS INT)"
    return spark.sql(f"""
      SELECT m.month, 6L AS vendorid,
        CAST({pickup} AS TIMESTAMP_NTZ) + make_dt_interval(0, CAST((k * 5) % 24 AS INT), 7) AS tpep_pickup_datetime,
        CAST({pickup} AS TIMESTAMP_NTZ) + make_dt_interval(0, CAST((k * 5) % 24 AS INT), {7 + int(MINUTES)}) AS tpep_dropoff_datetime,
        5 - k % 3 AS passenger_count, 0.6D + 1.7D * (k % 11) AS trip_distance, 2L AS ratecodeid, 'Y' AS store_and_fwd_flag,
        2L AS payment_type, {fare} AS fare_amount, {', '.join(f'{v}D AS {n}' for n, v in parts.items())},
        {fare} + {sum(parts.values())}D AS total_amount, 1 + (11 * k) % 263 AS pulocationid, 263 - k AS dolocationid
      FROM (SELECT id AS k FROM range({PER_MONTH})) CROSS JOIN ({chosen}) m""")
