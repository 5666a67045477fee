"""Table contracts and the fixed values every layer agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(text: str) -> T.StructType:
    fields = (line.split() for line in text.strip().splitlines())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Column names, order and types of the stored tables.
RAW = _schema("""
VendorID int
tpep_pickup_datetime timestamp_ntz
tpep_dropoff_datetime timestamp_ntz
passenger_count bigint
trip_distance double
RatecodeID bigint
store_and_fwd_flag string
PULocationID int
DOLocationID int
payment_type bigint
fare_amount double
extra double
mta_tax double
tip_amount double
tolls_amount double
improvement_surcharge double
total_amount double
congestion_surcharge double
Airport_fee double
""")

LINEAGE = _schema("""
_ingested_at timestamp_ntz
_source_file string
_year int
_month int
""")

BRONZE = T.StructType(RAW.fields + LINEAGE.fields)

SILVER = _schema("""
trip_id string
vendor_id int
pickup_zone_id int
dropoff_zone_id int
pickup_datetime timestamp_ntz
dropoff_datetime timestamp_ntz
passenger_count int
trip_distance double
rate_code_id int
store_and_fwd_flag string
payment_type int
fare_amount double
extra double
mta_tax double
tip_amount double
tolls_amount double
improvement_surcharge double
congestion_surcharge double
airport_fee double
total_amount double
_ingested_at timestamp_ntz
_source_file string
_year int
_month int
""")

FACT = _schema("""
trip_id string
vendor_id int
pickup_location_id int
dropoff_location_id int
pickup_datetime timestamp_ntz
dropoff_datetime timestamp_ntz
pickup_month timestamp_ntz
pickup_date timestamp_ntz
pickup_hour int
pickup_day_of_week int
passenger_count int
trip_distance double
trip_duration_minutes bigint
rate_code_id int
store_and_fwd_flag string
payment_type int
fare_amount double
extra double
mta_tax double
tip_amount double
tolls_amount double
improvement_surcharge double
congestion_surcharge double
airport_fee double
total_amount double
fare_per_mile double
tip_percentage double
_ingested_at timestamp_ntz
_source_file string
_updated_at timestamp
""")

ZONE_SEED = _schema("""
LocationID int
Borough string
Zone string
service_zone string
""")

BRONZE_PARTITIONS = ["_year", "_month"]
FACT_PARTITIONS = ["pickup_month"]
AUDIT = "_updated_at"

# Raw column -> cleaned column, where the name changes.
CLEAN_NAMES = {
    "VendorID": "vendor_id",
    "PULocationID": "pickup_zone_id",
    "DOLocationID": "dropoff_zone_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "Airport_fee": "airport_fee",
}
ZONE_NAMES = {
    "LocationID": "zone_id",
    "Borough": "borough",
    "Zone": "zone_name",
    "service_zone": "service_zone",
}

# Identity of a trip. The same four columns, in this order, feed the surrogate key.
TRIP_KEY = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_zone_id"]

# Order that decides between copies with the same ingestion stamp. Any fixed order
# will do; it must only be total, so that a re-run keeps the same row.
TIE_BREAK = [
    "dropoff_zone_id",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
    "passenger_count",
    "rate_code_id",
    "store_and_fwd_flag",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "_source_file",
    "_year",
    "_month",
]

# Inclusive ranges a trip must satisfy to reach silver.
SILVER_RANGES = {
    "trip_distance": (0.0, 500.0),
    "fare_amount": (0.0, 1000.0),
    "total_amount": (0.0, 2000.0),
}

# Known payment codes.
PAYMENT_TYPES = [0, 1, 2, 3, 4, 5, 6]

# Borough text -> reporting group; anything else is UNKNOWN_GROUP.
BOROUGH_GROUPS = {
    "Manhattan": "Manhattan",
    "Brooklyn": "Brooklyn",
    "Queens": "Queens",
    "Bronx": "Bronx",
    "Staten Island": "Staten Island",
    "EWR": "Airport",
}
UNKNOWN_GROUP = "Unknown"
AIRPORT_BOROUGH = "EWR"
AIRPORT_WORD = "Airport"

# Calendar range, weekend days (Sunday = 0) and hour bands, all inclusive.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"
WEEKEND_DAYS = [0, 6]
RUSH_HOURS = [(7, 9), (16, 19)]
DAYPARTS = [("Morning", 6, 11), ("Afternoon", 12, 16), ("Evening", 17, 20)]
OTHER_DAYPART = "Night"

# Landing rules and the reporting lag.
FIRST_YEAR = 2009
LAG_MONTHS = 13
MIN_FILE_BYTES = 10_000_000
DATASETS = ["yellow", "green", "fhv", "fhvhv"]
