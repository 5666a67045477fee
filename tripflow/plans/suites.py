"""The checks each layer has to pass."""

from __future__ import annotations

from tripflow.contracts import BRONZE, PAYMENT_TYPES
from tripflow.operators.quality import (
    ModelTest,
    Rule,
    between,
    exists,
    in_set,
    not_null,
    row_count,
)

# Bronze columns that must be filled, and tolerant ranges.
BRONZE_REQUIRED = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "PULocationID",
    "DOLocationID",
]
BRONZE_RANGES = {
    "fare_amount": (-500, 500),
    "trip_distance": (0, 100),
    "total_amount": (-1000, 1000),
}
BRONZE_MOSTLY = 0.99
BRONZE_MIN_ROWS = 1000


def bronze_columns() -> list[Rule]:
    return [exists(name) for name in BRONZE.names]


def bronze_values(max_rows: int | None = None) -> list[Rule]:
    return [
        *[not_null(name) for name in BRONZE_REQUIRED],
        *[between(name, low, high, BRONZE_MOSTLY) for name, (low, high) in BRONZE_RANGES.items()],
        in_set("payment_type", PAYMENT_TYPES, BRONZE_MOSTLY),
        row_count(BRONZE_MIN_ROWS, max_rows),
    ]


def bronze_suite(max_rows: int | None = None) -> list[Rule]:
    return bronze_columns() + bronze_values(max_rows)


# Tests of the built tables.
NOT_NULL = {
    "silver_trips": [
        "trip_id",
        "pickup_zone_id",
        "dropoff_zone_id",
        "pickup_datetime",
        "total_amount",
    ],
    "silver_zones": ["zone_id", "borough", "zone_name"],
    "fact_trips": [
        "trip_id",
        "pickup_location_id",
        "dropoff_location_id",
        "pickup_datetime",
        "total_amount",
    ],
    "dim_zones": ["zone_id", "borough", "zone_name"],
    "dim_datetime": ["datetime_hour"],
}
UNIQUE = {"silver_zones": "zone_id", "dim_zones": "zone_id", "dim_datetime": "datetime_hour"}
ACCEPTED = {"silver_trips": "payment_type", "fact_trips": "payment_type"}
ZONE_REFERENCES = ["pickup_location_id", "dropoff_location_id"]


def model_tests(unique_trips: bool = True) -> list[ModelTest]:
    """The 24 tests of the built tables, plus uniqueness of the fact's key on request."""
    tests = [ModelTest(t, "not_null", c) for t, columns in NOT_NULL.items() for c in columns]
    tests += [ModelTest(table, "unique", column) for table, column in UNIQUE.items()]
    tests += [
        ModelTest(table, "accepted_values", column, values=tuple(PAYMENT_TYPES))
        for table, column in ACCEPTED.items()
    ]
    tests += [
        ModelTest("fact_trips", "relationships", column, parent="dim_zones", key="zone_id")
        for column in ZONE_REFERENCES
    ]
    if unique_trips:
        tests.append(ModelTest("fact_trips", "unique", "trip_id"))
    return tests
