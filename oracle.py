"""DuckDB statements with the same results as the registered queries.

Each statement is put together from the relations it needs; they are written against the
table contracts, not derived from the Spark code.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong one on the other side shows.
AUDIT = "_updated_at"
BRONZE = """VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance RatecodeID
    store_and_fwd_flag PULocationID DOLocationID payment_type fare_amount extra mta_tax tip_amount tolls_amount
    improvement_surcharge total_amount congestion_surcharge Airport_fee
    _ingested_at _source_file _year _month""".split()
SILVER = """trip_id vendor_id pickup_zone_id dropoff_zone_id pickup_datetime dropoff_datetime passenger_count
    trip_distance rate_code_id store_and_fwd_flag payment_type fare_amount extra mta_tax tip_amount tolls_amount
    improvement_surcharge congestion_surcharge airport_fee total_amount
    _ingested_at _source_file _year _month""".split()
FACT = """trip_id vendor_id pickup_location_id dropoff_location_id pickup_datetime dropoff_datetime pickup_month
    pickup_date pickup_hour pickup_day_of_week passenger_count trip_distance trip_duration_minutes rate_code_id
    store_and_fwd_flag payment_type fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge
    congestion_surcharge airport_fee total_amount fare_per_mile tip_percentage
    _ingested_at _source_file _updated_at""".split()
CLEAN_NAMES = {
    "VendorID": "vendor_id",
    "PULocationID": "pickup_zone_id",
    "DOLocationID": "dropoff_zone_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "Airport_fee": "airport_fee",
}
TRIP_KEY = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_zone_id"]
TIE_BREAK = """dropoff_zone_id trip_distance fare_amount tip_amount total_amount payment_type passenger_count
    rate_code_id store_and_fwd_flag extra mta_tax tolls_amount improvement_surcharge congestion_surcharge
    airport_fee _source_file _year _month""".split()
PAYMENT_TYPES = [0, 1, 2, 3, 4, 5, 6]
BOROUGH_GROUPS = {
    "Manhattan": "Manhattan",
    "Brooklyn": "Brooklyn",
    "Queens": "Queens",
    "Bronx": "Bronx",
    "Staten Island": "Staten Island",
    "EWR": "Airport",
}
DAYPARTS = [("Morning", 6, 11), ("Afternoon", 12, 16), ("Evening", 17, 20)]
BRONZE_REQUIRED = """tpep_pickup_datetime tpep_dropoff_datetime trip_distance fare_amount total_amount
    PULocationID DOLocationID""".split()
BRONZE_RANGES = {"fare_amount": (-500, 500), "trip_distance": (0, 100), "total_amount": (-1000, 1000)}
BRONZE_MOSTLY = 0.99
BRONZE_MIN_ROWS = 1000
NOT_NULL = {
    "silver_trips": ["trip_id", "pickup_zone_id", "dropoff_zone_id", "pickup_datetime", "total_amount"],
    "silver_zones": ["zone_id", "borough", "zone_name"],
    "fact_trips": ["trip_id", "pickup_location_id", "dropoff_location_id", "pickup_datetime", "total_amount"],
    "dim_zones": ["zone_id", "borough", "zone_name"],
    "dim_datetime": ["datetime_hour"],
}
UNIQUE = {"silver_zones": "zone_id", "dim_zones": "zone_id", "dim_datetime": "datetime_hour"}
ACCEPTED = {"silver_trips": "payment_type", "fact_trips": "payment_type"}
ZONE_REFERENCES = ["pickup_location_id", "dropoff_location_id"]


def commas(items) -> str:
    return ", ".join(str(item) for item in items)


def delivery(batch: int, tip: str, day: str, condition: str) -> str:
    ride = "l_partkey % 1440 + cast(l_quantity as bigint) - 2"
    return f"""
    SELECT cast(l_linenumber AS int) AS "VendorID",
      l_shipdate + to_minutes(l_partkey % 1440) + to_seconds(l_orderkey % 60) AS tpep_pickup_datetime,
      l_shipdate + to_minutes({ride}) + to_seconds(l_orderkey % 60 + l_suppkey % 97) AS tpep_dropoff_datetime,
      cast(l_quantity AS bigint) % 7 AS passenger_count,
      l_quantity * 11.0E0 - 20.0E0 AS trip_distance,
      l_orderkey % 6 + 1 AS "RatecodeID",
      CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
      cast(l_suppkey % 27 AS int) AS "PULocationID",
      cast(l_partkey % 27 AS int) AS "DOLocationID",
      l_partkey % 8 AS payment_type,
      l_extendedprice / 100.0E0 AS fare_amount,
      l_tax * 10.0E0 AS extra,
      0.5E0 AS mta_tax,
      l_extendedprice / 100.0E0 * l_discount + {tip} AS tip_amount,
      0.0E0 AS tolls_amount,
      1.0E0 AS improvement_surcharge,
      l_extendedprice / 100.0E0 * (1.0E0 + l_discount) + l_tax * 10.0E0 + 1.5E0 + {tip} AS total_amount,
      2.5E0 AS congestion_surcharge,
      CASE WHEN l_suppkey % 27 IN (1, 24) THEN 1.75E0 ELSE 0.0E0 END AS "Airport_fee",
      TIMESTAMP '{day} 00:00:00' AS _ingested_at,
      'batch{batch}.parquet' AS _source_file,
      cast(year(l_shipdate) AS int) AS _year,
      cast(month(l_shipdate) AS int) AS _month
    FROM lineitem WHERE {condition}"""


BATCH_1 = delivery(1, "0.0E0", "2026-01-01", "true")
BATCH_2 = delivery(2, "1.0E0", "2026-01-02", "l_orderkey % 10 = 0")


def clean(source: str) -> str:
    types = {"passenger_count": "int", "RatecodeID": "int", "payment_type": "int"}
    columns = []
    for raw in BRONZE:
        value = f'cast("{raw}" AS {types[raw]})' if raw in types else f'"{raw}"'
        columns.append(f"{value} AS {CLEAN_NAMES.get(raw, raw)}")
    return f"SELECT {commas(columns)} FROM {source}"


VALID = """pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND trip_distance BETWEEN 0 AND 500 AND fare_amount BETWEEN 0 AND 1000
    AND total_amount BETWEEN 0 AND 2000"""

NEWEST = f"""row_number() OVER (PARTITION BY {commas(TRIP_KEY)}
    ORDER BY _ingested_at DESC, {commas(TIE_BREAK)}) = 1"""

TRIP_ID = "md5({})".format(
    " || '-' || ".join(f"coalesce(cast({name} AS varchar), '')" for name in TRIP_KEY)
)


def silver_of(source: str) -> str:
    columns = [f"{TRIP_ID} AS trip_id", *SILVER[1:]]
    return f"SELECT {commas(columns)} FROM (SELECT * FROM ({clean(source)}) WHERE {VALID} QUALIFY {NEWEST})"


def fact_of(source: str) -> str:
    made = {
        "pickup_location_id": "pickup_zone_id",
        "dropoff_location_id": "dropoff_zone_id",
        "pickup_month": "cast(date_trunc('month', pickup_datetime) AS timestamp)",
        "pickup_date": "cast(date_trunc('day', pickup_datetime) AS timestamp)",
        "pickup_hour": "cast(hour(pickup_datetime) AS int)",
        "pickup_day_of_week": "cast(dayofweek(pickup_datetime) AS int)",
        "trip_duration_minutes": "date_diff('minute', pickup_datetime, dropoff_datetime)",
        "fare_per_mile": "CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance ELSE 0.0E0 END",
        "tip_percentage": "CASE WHEN total_amount > 0 THEN tip_amount / total_amount ELSE 0.0E0 END",
    }
    columns = [f"{made.get(name, name)} AS {name}" for name in FACT if name != AUDIT]
    return f"SELECT {commas(columns)} FROM {source}"


SEED = """
    SELECT n_nationkey AS "LocationID",
      CASE r_name WHEN 'AFRICA' THEN 'Manhattan' WHEN 'AMERICA' THEN 'Brooklyn'
        WHEN 'ASIA' THEN 'Queens' WHEN 'EUROPE' THEN 'EWR' ELSE 'Unknown' END AS "Borough",
      CASE WHEN n_nationkey IN (2, 7) THEN n_name || ' Airport' ELSE n_name END AS "Zone",
      CASE WHEN n_nationkey % 3 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey"""

STG_ZONES = """SELECT "LocationID" AS zone_id, "Borough" AS borough, "Zone" AS zone_name,
    service_zone FROM seed"""

GROUPS = " ".join(f"WHEN '{name}' THEN '{group}'" for name, group in BOROUGH_GROUPS.items())
DIM_ZONES = f"""SELECT *, CASE borough {GROUPS} ELSE 'Unknown' END AS borough_group,
    coalesce(contains(zone_name, 'Airport') OR borough = 'EWR', false) AS is_airport
    FROM stg_zones"""

VALID_1 = f"(SELECT * FROM ({clean('batch_1')}) WHERE {VALID})"

SPINE = f"""SELECT date_day + to_hours(hour_of_day) AS datetime_hour, cast(date_day AS date) AS date_day,
      cast(hour_of_day AS int) AS hour_of_day
    FROM (SELECT unnest(generate_series(min(pickup_datetime)::date::timestamp,
        max(pickup_datetime)::date::timestamp, INTERVAL 1 DAY)) AS date_day FROM {VALID_1}),
      range(24) AS hours(hour_of_day)"""

BANDS = " ".join(f"WHEN hour_of_day BETWEEN {a} AND {b} THEN '{name}'" for name, a, b in DAYPARTS)
CALENDAR = f"""SELECT datetime_hour, date_day, hour_of_day,
      cast(year(date_day) AS int) AS year, cast(month(date_day) AS int) AS month,
      cast(day(date_day) AS int) AS day_of_month, cast(dayofweek(date_day) AS int) AS day_of_week,
      cast(dayofyear(date_day) AS int) AS day_of_year, cast(week(date_day) AS int) AS week_of_year,
      cast(quarter(date_day) AS int) AS quarter,
      dayname(date_day) AS day_name, monthname(date_day) AS month_name,
      strftime(date_day, '%Y-%m') AS year_month,
      dayofweek(date_day) IN (0, 6) AS is_weekend,
      (hour_of_day >= 7 AND hour_of_day <= 9) OR (hour_of_day >= 16 AND hour_of_day <= 19) AS is_rush_hour,
      CASE {BANDS} ELSE 'Night' END AS time_of_day
    FROM spine"""

RELATIONS = {
    "batch_1": BATCH_1,
    "batch_2": BATCH_2,
    "bronze": "SELECT * FROM batch_1 UNION ALL SELECT * FROM batch_2",
    "silver": silver_of("bronze"),
    "fact": fact_of("silver"),
    "fact_1": fact_of(f"({silver_of('batch_1')})"),
    "fact_2": fact_of(f"({silver_of('batch_2')})"),
    "seed": SEED,
    "stg_zones": STG_ZONES,
    "zones": DIM_ZONES,
    "spine": SPINE,
    "calendar": CALENDAR,
}


def statement(body: str) -> str:
    """The body with all shared relations in front; unused ones cost nothing."""
    shared = ",\n".join(f"{name} AS ({sql})" for name, sql in RELATIONS.items())
    return f"WITH {shared}\n{body}"


def stored_month(stamp: str) -> str:
    """Batch 1 as it looks after being delivered as monthly files."""
    return f"""(SELECT * REPLACE (TIMESTAMP '{stamp}' AS _ingested_at,
      'yellow_tripdata_' || strftime(make_date(_year, _month, 1), '%Y-%m') || '.parquet' AS _source_file)
      FROM batch_1)"""


STORED = stored_month("2026-01-01 00:00:00")


def outcome(check: str, column: str, evaluated: str, failed: str, success: str, source: str) -> str:
    return f"""SELECT '{check}' AS "check", '{column}' AS "column",
      cast({evaluated} AS bigint) AS evaluated, cast({failed} AS bigint) AS failed,
      {success} AS success FROM {source}"""


def value_rule(check: str, column: str, good: str, source: str) -> str:
    failed = f"count(*) FILTER (NOT ({good}))"
    success = f"coalesce((count({column}) - {failed}) / nullif(count({column}), 0) >= {BRONZE_MOSTLY}, true)"
    return outcome(check, column, f"count({column})", failed, success, source)


def bronze_values(source: str = "bronze") -> str:
    rules = []
    for column in BRONZE_REQUIRED:
        nulls = f'count(*) FILTER ("{column}" IS NULL)'
        rules.append(outcome("not_null", column, "count(*)", nulls, f"{nulls} = 0", source))
    for column, (low, high) in BRONZE_RANGES.items():
        rules.append(value_rule("between", column, f"{column} BETWEEN {low} AND {high}", source))
    rules.append(value_rule("in_set", "payment_type", f"payment_type IN ({commas(PAYMENT_TYPES)})", source))
    enough = f"count(*) >= {BRONZE_MIN_ROWS}"
    short = f"CASE WHEN {enough} THEN 0 ELSE 1 END"
    rules.append(outcome("row_count", "*", "count(*)", short, enough, source))
    return "\nUNION ALL ".join(rules)


def bronze_columns() -> str:
    wanted = commas(f"'{name}'" for name in BRONZE)
    described = "(SELECT column_name FROM (DESCRIBE SELECT * FROM bronze))"
    return f"""SELECT 'column_exists' AS "check", wanted AS "column", cast(1 AS bigint) AS evaluated,
      cast(CASE WHEN wanted IN {described} THEN 0 ELSE 1 END AS bigint) AS failed,
      wanted IN {described} AS success
    FROM (SELECT unnest([{wanted}]) AS wanted)"""


# Name of a built table in the checks -> relation above.
TABLES = {
    "silver_trips": "silver",
    "silver_zones": "stg_zones",
    "fact_trips": "fact",
    "dim_zones": "zones",
    "dim_datetime": "calendar",
}


def model_outcome(table: str, check: str, column: str, evaluated: str, failed: str, source: str) -> str:
    return f"""SELECT '{table}' AS "table", '{check}' AS "check", '{column}' AS "column",
      cast({evaluated} AS bigint) AS evaluated, cast({failed} AS bigint) AS failed,
      {failed} = 0 AS success FROM {source}"""


def model_not_null() -> str:
    parts = [
        model_outcome(t, "not_null", c, "count(*)", f"count(*) - count({c})", TABLES[t])
        for t, columns in NOT_NULL.items()
        for c in columns
    ]
    return "\nUNION ALL ".join(parts)


def counted(table: str, column: str) -> str:
    return f"""(SELECT {column} AS value, count(*) AS n FROM {TABLES[table]}
      WHERE {column} IS NOT NULL GROUP BY 1)"""


def model_unique() -> str:
    tests = [*UNIQUE.items(), ("fact_trips", "trip_id")]
    repeated = "count(*) FILTER (n > 1)"
    return "\nUNION ALL ".join(
        model_outcome(t, "unique", c, "coalesce(sum(n), 0)", repeated, counted(t, c)) for t, c in tests
    )


def model_accepted() -> str:
    outside = f"count(*) FILTER (value NOT IN ({commas(PAYMENT_TYPES)}))"
    return "\nUNION ALL ".join(
        model_outcome(t, "accepted_values", c, "coalesce(sum(n), 0)", outside, counted(t, c))
        for t, c in ACCEPTED.items()
    )


def model_relationships() -> str:
    parts = []
    for column in ZONE_REFERENCES:
        orphans = f"count(*) FILTER ({column} NOT IN (SELECT zone_id FROM zones))"
        parts.append(
            model_outcome("fact_trips", "relationships", column, f"count({column})", orphans, "fact")
        )
    return "\nUNION ALL ".join(parts)


def reload_year(year: int) -> str:
    renewed = stored_month("2026-01-02 00:00:00")
    return f"""SELECT _year, _month, count(*) AS trips, min(_ingested_at) AS first_stamp,
      max(_ingested_at) AS last_stamp, round(sum(total_amount), 2) AS total_amount
    FROM (SELECT * FROM {STORED} WHERE _year <> {year}
      UNION ALL SELECT * FROM {renewed} WHERE _year = {year})
    GROUP BY _year, _month"""


NEW_TRIPS = f"""{fact_of('silver')} WHERE pickup_datetime >
    (SELECT max(pickup_datetime) FROM fact WHERE pickup_datetime < TIMESTAMP '1998-01-01')"""

UPSERT = """SELECT * FROM fact_1 WHERE trip_id NOT IN (SELECT trip_id FROM fact_2)
    UNION ALL SELECT * FROM fact_2"""

REBUILT = """SELECT pickup_month, _source_file, count(*) AS trips, round(sum(tip_amount), 2) AS tip_amount
    FROM (
      SELECT pickup_month, _source_file, tip_amount FROM fact_1 WHERE pickup_month NOT IN (SELECT * FROM months)
      UNION ALL
      SELECT pickup_month, _source_file, tip_amount FROM fact WHERE pickup_month IN (SELECT * FROM months))
    GROUP BY 1, 2"""
TOUCHED = """(SELECT DISTINCT cast(date_trunc('month', tpep_pickup_datetime) AS timestamp)
    FROM batch_2 WHERE _year = 1997)"""

AUDITED = f"""SELECT coalesce(d._source_file, o._source_file) AS _source_file,
    coalesce(loaded, false) AS already_loaded, loaded IS NULL AS is_empty,
    loaded IS NULL AS below_minimum,
    CASE loaded WHEN true THEN 'skip' WHEN false THEN 'load' ELSE 'fetch' END AS action
    FROM (SELECT DISTINCT _source_file, _year = 1997 AS loaded FROM {STORED}) d
    FULL JOIN (SELECT DISTINCT 'yellow_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.parquet'
      AS _source_file FROM orders) o ON d._source_file = o._source_file"""

TARGETS = """SELECT cast(year(target) AS int) AS year, cast(month(target) AS int) AS month, count(*) AS runs
    FROM (SELECT date_trunc('month', o_orderdate) - INTERVAL 13 MONTH AS target FROM orders)
    WHERE year(target) >= 1995 GROUP BY 1, 2"""

ZONE_COUNTS = """SELECT pickup_location_id, zone_name, borough, count(*) AS trips
    FROM fact LEFT JOIN zones ON pickup_location_id = zone_id GROUP BY ALL"""

WITH_ZONES = """SELECT trip_id, pickup_location_id, dropoff_location_id,
      p.borough_group AS pickup_borough_group, p.zone_name AS pickup_zone_name,
      p.is_airport AS pickup_is_airport, d.borough_group AS dropoff_borough_group,
      d.zone_name AS dropoff_zone_name, d.is_airport AS dropoff_is_airport
    FROM fact LEFT JOIN zones p ON pickup_location_id = p.zone_id
      LEFT JOIN zones d ON dropoff_location_id = d.zone_id"""

ON_HOUR = "date_trunc('hour', pickup_datetime) = datetime_hour"

GRID = commas(f"count(*) FILTER (pickup_hour = {h}) AS hour_{h:02d}" for h in range(24))

CALENDAR_TEXT = "SELECT * REPLACE (cast(date_day AS varchar) AS date_day) FROM {}"


# The trips as three deliveries that pass the checks, once corrected.
PERIOD = """CASE WHEN tpep_pickup_datetime < TIMESTAMP '1994-07-01' THEN 1
    WHEN tpep_pickup_datetime < TIMESTAMP '1996-07-01' THEN 2 ELSE 3 END"""
DELIVERED = f"""SELECT * REPLACE (cast(2024 AS int) AS _year, cast({PERIOD} AS int) AS _month,
      'yellow_tripdata_2024-0' || {PERIOD} || '.parquet' AS _source_file)
    FROM ({BATCH_1.replace('l_quantity * 11.0E0 - 20.0E0 AS trip_distance', 'l_quantity * 1.0E0 AS trip_distance')
      .replace('l_suppkey % 27 AS int) AS "PULocationID"', 'l_suppkey % 25 AS int) AS "PULocationID"')
      .replace('l_partkey % 27 AS int)', 'l_partkey % 25 AS int)')
      .replace('l_partkey % 8 AS payment_type', 'l_partkey % 7 AS payment_type')
      .replace('l_extendedprice / 100.0E0 AS fare_amount', 'l_extendedprice / 1000.0E0 AS fare_amount')
      .replace('l_extendedprice / 100.0E0 * (1.0E0 + l_discount) + l_tax * 10.0E0 + 1.5E0 + 0.0E0 AS total_amount',
               'l_extendedprice / 1000.0E0 + 4.0E0 AS total_amount')})"""


def fact_after(phase: str, condition: str, delivered: str = DELIVERED) -> str:
    silver = silver_of(f"(SELECT * FROM ({delivered}) WHERE {condition})")
    return f"""SELECT '{phase}' AS phase, _source_file, pickup_month, count(*) AS trips,
      cast(sum(cast(fare_amount AS decimal(24, 9))) AS double) AS fares FROM ({fact_of(f'({silver})')}) GROUP BY ALL"""


# The same trips as three deliveries that each have all pickup months.
MIXED = DELIVERED.replace(PERIOD, '(("RatecodeID" - 1) % 3 + 1)')


def failing(check: str, column: str, bad: str) -> str:
    return f"""SELECT '{check}' AS "check", '{column}' AS "column", cast({column} AS double) AS value,
      count(*) AS rows, round(count(*) / (SELECT count({column}) FROM bronze), 9) AS share
    FROM bronze WHERE {bad} GROUP BY {column}"""


def failures() -> str:
    parts = [failing("between", c, f"NOT {c} BETWEEN {a} AND {b}") for c, (a, b) in BRONZE_RANGES.items()]
    parts.append(failing("in_set", "payment_type", f"payment_type NOT IN ({commas(PAYMENT_TYPES)})"))
    for column in ZONE_REFERENCES:
        parts.append(f"""SELECT 'relationships', '{column}', cast({column} AS double), count(*), NULL
          FROM fact WHERE {column} NOT IN (SELECT zone_id FROM zones) GROUP BY {column}""")
    return "\nUNION ALL ".join(parts)


def top_failures(k: int) -> str:
    parts = [failing("between", c, f"NOT {c} BETWEEN {a} AND {b}") for c, (a, b) in BRONZE_RANGES.items()]
    parts.append(failing("in_set", "payment_type", f"payment_type NOT IN ({commas(PAYMENT_TYPES)})"))
    every = "\nUNION ALL ".join(parts)
    place = 'cast(row_number() OVER (PARTITION BY "check", "column" ORDER BY rows DESC, value) AS int)'
    return f"""SELECT "check", "column", {place} AS place, value, rows, share FROM ({every}) QUALIFY place <= {k}"""


LOADED = f"""SELECT cast(2024 AS int) AS year, cast(month AS int) AS month,
      (SELECT count(*) FROM ({DELIVERED}) WHERE _month = month) AS input_count,
      (SELECT count(*) FROM ({DELIVERED}) WHERE _month = month) AS output_count,
      (SELECT count(*) FROM lineitem) AS stored
    FROM (SELECT unnest([1, 2, 3, 3]) AS month)"""


def statements() -> dict[str, str]:
    bodies = {
        "bronze_load": f"SELECT * FROM {STORED}",
        "bronze_write": reload_year(1997),
        "bronze_reconcile": """SELECT _year AS year, _month AS month, count(*) AS input_count,
            count(*) AS output_count, cast(0 AS bigint) AS difference, true AS reconciled
            FROM batch_1 GROUP BY ALL""",
        "bronze_filled": f"""SELECT _year, _month, count(*) AS rows,
            {", ".join(f'count("{name}") AS "{name}"' for name in BRONZE[:19])} FROM batch_1 GROUP BY ALL""",
        "bronze_view": "SELECT _year, _month, count(*) AS trips FROM batch_1 GROUP BY ALL",
        "bronze_preview": """SELECT "VendorID", tpep_pickup_datetime, total_amount FROM batch_1
            ORDER BY ALL LIMIT 5""",
        "bronze_sample": """SELECT least(count(*), 10000) AS sampled, least(count(*), 10000) AS found
            FROM batch_1""",
        "landing_audit": AUDITED,
        "zone_seed": "SELECT * FROM seed",
        "target_period": TARGETS,
        "silver_filter": f"SELECT * FROM ({clean('bronze')}) WHERE {VALID}",
        "silver_dedup": f"SELECT * FROM ({clean('bronze')}) QUALIFY {NEWEST}",
        "surrogate_key": f"SELECT {TRIP_ID} AS trip_id, {commas(TRIP_KEY)} FROM ({clean('bronze')})",
        "silver_trips": "SELECT * FROM silver",
        "stg_zones": "SELECT * FROM stg_zones",
        "fact_trips": "SELECT * FROM fact",
        "fact_incremental": NEW_TRIPS,
        "fact_append": "SELECT * FROM fact",
        "fact_upsert": UPSERT,
        "fact_upsert_stored": UPSERT,
        "fact_upsert_files": UPSERT,
        "fact_upsert_bucketed": UPSERT,
        "fact_rebuild": REBUILT.replace("(SELECT * FROM months)", TOUCHED),
        "trip_duration": "SELECT trip_id, trip_duration_minutes FROM fact",
        "fact_ratios": "SELECT trip_id, fare_per_mile, tip_percentage FROM fact",
        "date_spine": CALENDAR_TEXT.format("spine"),
        "dim_datetime": CALENDAR_TEXT.format("calendar"),
        "dim_zones": "SELECT * FROM zones",
        "kpi_summary": """SELECT round(sum(total_amount), 2) AS total_revenue, count(*) AS total_trips,
            round(sum(total_amount) / nullif(sum(trip_distance), 0), 6) AS revenue_per_mile FROM fact""",
        "monthly_revenue": """SELECT pickup_month, round(sum(total_amount), 2) AS revenue FROM fact
            GROUP BY pickup_month ORDER BY pickup_month""",
        "trips_by_zone": ZONE_COUNTS,
        "top_pickup_zones": f"""SELECT * FROM ({ZONE_COUNTS})
            ORDER BY trips DESC, pickup_location_id LIMIT 10""",
        "trips_between_boroughs": f"""SELECT pickup_borough_group, dropoff_borough_group,
            count(*) AS trips FROM ({WITH_ZONES}) GROUP BY ALL""",
        "fact_with_zones": WITH_ZONES,
        "fact_with_calendar": f"""SELECT trip_id, pickup_datetime, datetime_hour, time_of_day,
            is_rush_hour, is_weekend FROM fact LEFT JOIN calendar ON {ON_HOUR}""",
        "hourly_heatmap": """SELECT pickup_day_of_week, pickup_hour, count(*) AS trips FROM fact
            GROUP BY ALL""",
        "heatmap_grid": f"SELECT pickup_day_of_week, {GRID} FROM fact GROUP BY pickup_day_of_week",
        "trips_by_daypart": f"""SELECT time_of_day, is_rush_hour, is_weekend, count(*) AS trips,
            round(sum(total_amount), 2) AS revenue
            FROM fact LEFT JOIN calendar ON {ON_HOUR} GROUP BY ALL""",
        "dq_columns": bronze_columns(),
        "dq_bronze_suite": bronze_values(),
        "dq_stored_suite": bronze_values("batch_1"),
        "dq_gate": f"""SELECT count(*) AS evaluated, count(*) FILTER (success) AS successful,
            count(*) FILTER (NOT success) AS unsuccessful, bool_and(success) AS success
            FROM ({bronze_columns()} UNION ALL {bronze_values()})""",
        "dq_not_null": model_not_null(),
        "dq_unique": model_unique(),
        "dq_accepted_values": model_accepted(),
        "dq_relationships": model_relationships(),
        "dq_unaccepted_values": f"""SELECT payment_type AS value, count(*) AS rows FROM fact
            WHERE payment_type NOT IN ({commas(PAYMENT_TYPES)}) GROUP BY 1""",
        "dq_failures": failures(),
        "dq_top_failures": top_failures(5),
        "dq_model_tests": "\nUNION ALL ".join((model_not_null(), model_unique(), model_accepted(), model_relationships())),
        "dq_row_count": "\nUNION ALL ".join(
            outcome("row_count", "*", "count(*)", f"CASE WHEN {inside} THEN 0 ELSE 1 END", inside, "bronze")
            for inside in (f"count(*) BETWEEN {BRONZE_MIN_ROWS} AND {10**12}", f"count(*) BETWEEN {BRONZE_MIN_ROWS} AND 1001")
        ),
        "month_run": f"{fact_after('without', '_month <> 2')}\nUNION ALL {fact_after('with', 'true')}",
        "month_redelivery": fact_after("refused 3", "_month <> 2", MIXED),
        "fact_late_rows": fact_of(f"({silver_of(f'({MIXED})')})"),
        "bronze_load_month": LOADED,
        "bronze_load_drift": DELIVERED,
        "catalog_tables": "SELECT _year, _month, count(*) AS trips FROM batch_1 GROUP BY ALL",
        "dq_duplicate_keys": f"""SELECT {TRIP_ID} AS value, count(*) AS rows
            FROM ({clean('bronze')}) GROUP BY 1 HAVING count(*) > 1""",
    }
    return {name: statement(body) for name, body in bodies.items()}
