from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.trips import at, bronze, raw, write_month
from tripflow.contracts import BRONZE, BRONZE_PARTITIONS, FACT
from tripflow.operators.fact import fact_trips, later_than
from tripflow.operators.merge import delete_insert
from tripflow.operators.silver import silver_trips
from tripflow.sinks.bronze import count_rows, load_landing, load_month, reconcile
from tripflow.sinks.fact import (
    append_new_trips,
    picked_up_in,
    rebuild_months,
    touched_months,
    upsert_fact,
    write_fact,
)
from tripflow.sinks.tables import create_table, ensure_table
from tripflow.sources.landing import audit_landing, bronze_manifest, landing_name
from tripflow.sources.tables import read_bronze, read_fact

NO_AUDIT = [name for name in FACT.names if name != "_updated_at"]


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def load(spark, tmp_path, month=1, stamp="2025-02-05 06:00:00"):
    return load_month(
        spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), 2024, month, ingested_at=stamp
    )


def stored(spark, tmp_path):
    return read_bronze(spark, str(tmp_path / "bronze"))


def test_load_month_stores_the_contract(spark, tmp_path):
    write_month(tmp_path / "raw", 2024, 1, [raw(), raw(VendorID=2)])
    stats = load(spark, tmp_path)
    assert (stats.input_count, stats.output_count, stats.reconciled) == (2, 2, True)
    assert stats.to_frame(spark).first()["input_count"] == 2
    table = stored(spark, tmp_path)
    assert table.schema == BRONZE
    row = table.filter("VendorID = 2").first()
    assert row["_ingested_at"] == at("2025-02-05 06:00:00")
    assert (row["_source_file"], row["_year"], row["_month"]) == ("yellow_tripdata_2024-01.parquet", 2024, 1)


def test_loading_twice_equals_once_and_leaves_other_months(spark, tmp_path):
    write_month(tmp_path / "raw", 2024, 1, [raw(), raw()])
    write_month(tmp_path / "raw", 2024, 2, [raw(VendorID=7)])
    load(spark, tmp_path, 1)
    load(spark, tmp_path, 2)
    once = rows_of(stored(spark, tmp_path))
    load(spark, tmp_path, 1)
    assert rows_of(stored(spark, tmp_path)) == once
    write_month(tmp_path / "raw", 2024, 1, [raw(VendorID=3)])
    load(spark, tmp_path, 1, "2025-03-05 06:00:00")
    assert sorted(r["VendorID"] for r in stored(spark, tmp_path).collect()) == [3, 7]


def test_empty_delivery_empties_its_month(spark, tmp_path):
    for month in (1, 2):
        write_month(tmp_path / "raw", 2024, month, [raw()])
        load(spark, tmp_path, month)
    write_month(tmp_path / "raw", 2024, 1, [])
    stats = load(spark, tmp_path, 1)
    assert (stats.input_count, stats.output_count) == (0, 0)
    assert [r["_month"] for r in stored(spark, tmp_path).collect()] == [2]


def test_type_drift_is_cast_and_doubles_round_half_to_even(spark, tmp_path):
    rows = [raw(passenger_count=n, VendorID=1, note="x") for n in (1.5, 2.5, 2.4, None)]
    write_month(
        tmp_path / "raw", 2024, 1, rows, passenger_count=pa.float64(), VendorID=pa.int64()
    )
    load(spark, tmp_path)
    table = stored(spark, tmp_path)
    assert table.columns == BRONZE.names
    assert sorted(r["passenger_count"] or 0 for r in table.collect()) == [0, 2, 2, 2]


def test_bad_deliveries_fail(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load(spark, tmp_path, 5)
    with pytest.raises(ValueError, match="unknown dataset"):
        landing_name(2024, 1, "bikes")
    path = write_month(tmp_path / "raw", 2024, 1, [raw()])
    import pyarrow.parquet as pq

    pq.write_table(pq.read_table(path).drop_columns(["tip_amount"]), path)
    with pytest.raises(ValueError, match="tip_amount"):
        load(spark, tmp_path)
    with pytest.raises(ValueError, match="month"):
        load(spark, tmp_path, 13)


def test_load_landing_equals_month_by_month(spark, tmp_path):
    for month, rows in ((1, [raw(), raw()]), (2, []), (3, [raw(VendorID=9)])):
        write_month(tmp_path / "raw", 2024, month, rows)
        load(spark, tmp_path, month)
    other = str(tmp_path / "bulk")
    ensure_table(spark, other, BRONZE, BRONZE_PARTITIONS)
    old = bronze(spark, {"_month": 2}, {"_month": 6})
    old.write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(other)
    files = f"{tmp_path}/raw/yellow/*"
    result = load_landing(spark, other, files, ingested_at="2025-02-05 06:00:00")
    assert sorted((r["month"], r["input_count"], r["difference"]) for r in result.collect()) == [
        (1, 2, 0),
        (2, 0, 0),
        (3, 1, 0),
    ]
    seen = spark.createDataFrame([(2024, 1, 5), (2024, 2, 1)], "_year int, _month int, input_count bigint")
    assert sorted(map(tuple, reconcile(seen, count_rows(read_bronze(spark, other), "output_count")).collect())) == [
        (2024, 1, 5, 2, 3, False),
        (2024, 2, 1, 0, 1, False),
        (2024, 3, 0, 1, -1, False),
        (2024, 6, 0, 1, -1, False),
    ]
    bulk = read_bronze(spark, other)
    assert rows_of(bulk.filter("_month <> 6")) == rows_of(stored(spark, tmp_path))
    assert bulk.filter("_month = 6").count() == 1


def test_landing_audit(spark, tmp_path):
    big = write_month(tmp_path / "raw", 2024, 1, [raw()])
    write_month(tmp_path / "raw", 2024, 2, [raw()])
    size = big.stat().st_size
    (big.parent / landing_name(2024, 3)).write_bytes(b"")
    (big.parent / landing_name(2024, 4)).write_bytes(b"cut off")
    (big.parent / "notes.txt").write_bytes(b"x")
    loaded = bronze(spark, {"_source_file": landing_name(2024, 2)})
    expected = bronze(spark, *[{"_source_file": landing_name(2024, m)} for m in (1, 3, 5)])
    audit = audit_landing(
        spark, str(big.parent), loaded=loaded, expected=expected, min_bytes=size
    )
    found = {r["_source_file"][-10:-8]: tuple(r)[1:] for r in audit.collect()}
    assert found["01"] == (size, False, False, False, "load")
    assert found["02"][1:] == (True, False, False, "skip")
    assert found["03"] == (0, False, True, True, "fetch")
    assert found["04"] == (7, False, False, True, "fetch")
    assert found["05"] == found["03"]
    assert len(found) == 5
    assert {r["action"] for r in audit_landing(spark, str(big.parent)).collect()} == {"fetch"}


def fact(spark, *rows):
    return fact_trips(silver_trips(bronze(spark, *rows)))


JAN = {"tpep_pickup_datetime": at("2024-01-31 23:00:00"), "tpep_dropoff_datetime": at("2024-02-01 00:10:00")}
FEB = {"tpep_pickup_datetime": at("2024-02-10 10:00:00"), "tpep_dropoff_datetime": at("2024-02-10 10:30:00")}


def test_delete_insert(spark):
    target = spark.createDataFrame([(1, "old"), (1, "old2"), (2, "old"), (None, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (1, "new"), (3, "new"), (None, "new")], "k int, v string")
    found = sorted(map(tuple, delete_insert(target, batch, ["k"]).collect()), key=str)
    expected = [(1, "new"), (1, "new"), (2, "old"), (3, "new"), (None, "new"), (None, "old")]
    assert found == sorted(expected, key=str)


def test_fact_table_round_trip_and_upsert(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = [{"VendorID": v} | when for v in (1, 2) for when in (JAN, FEB)]
    write_fact(fact(spark, *first), path)
    table = read_fact(spark, path)
    assert table.schema == FACT
    assert rows_of(table.select(*NO_AUDIT)) == rows_of(fact(spark, *first).select(*NO_AUDIT))
    assert {f.name for f in (tmp_path / "fact").iterdir() if f.is_dir()} == {
        "pickup_month=2024-01-01 00%3A00%3A00",
        "pickup_month=2024-02-01 00%3A00%3A00",
    }
    january = {f: f.stat().st_mtime_ns for f in (tmp_path / "fact").glob("*2024-01-01*/*.parquet")}
    batch = fact(spark, FEB | {"VendorID": 2, "tip_amount": 9.0}, FEB | {"VendorID": 3})
    for _ in range(2):
        upsert_fact(spark, path, batch)
        tips = {(r["vendor_id"], r["pickup_month"].month): r["tip_amount"] for r in read_fact(spark, path).collect()}
        assert tips == {(1, 1): 5.0, (2, 1): 5.0, (1, 2): 5.0, (2, 2): 9.0, (3, 2): 5.0}
        assert read_fact(spark, path).count() == 5
    assert january == {f: f.stat().st_mtime_ns for f in january}


def test_high_water_mark(spark):
    silver = silver_trips(bronze(spark, JAN, FEB, FEB | {"VendorID": 2}))
    target = fact(spark, FEB)
    mark = target.agg(F.max("pickup_datetime")).scalar()
    assert later_than(silver, mark).count() == 0
    empty = target.limit(0).agg(F.max("pickup_datetime")).scalar()
    assert later_than(silver, empty).count() == 3


def test_append_starts_from_nothing_and_repeats_as_a_no_op(spark, tmp_path):
    path = str(tmp_path / "fact")
    ensure_table(spark, path, FACT, ["pickup_month"])
    assert append_new_trips(spark, path, silver_trips(bronze(spark, JAN))) is None
    both = silver_trips(bronze(spark, JAN, FEB, JAN | {"VendorID": 2}))
    assert append_new_trips(spark, path, both) == JAN["tpep_pickup_datetime"]
    once = rows_of(read_fact(spark, path))
    assert len(once) == 2  # the late trip of vendor 2 does not pass the mark
    assert append_new_trips(spark, path, both) == FEB["tpep_pickup_datetime"]
    assert rows_of(read_fact(spark, path)) == once


def test_rebuild_takes_late_corrected_and_withdrawn_rows(spark, tmp_path):
    path = str(tmp_path / "fact")
    dec = {"tpep_pickup_datetime": at("2023-12-31 23:00:00"), "tpep_dropoff_datetime": at("2024-01-01 00:10:00")}
    february = {"_month": 2, "_source_file": "yellow_tripdata_2024-02.parquet"}
    old = [JAN, dec, JAN | {"VendorID": 4}, FEB | february]
    write_fact(fact(spark, *old), path)
    # January comes again: the December trip is withdrawn, one is corrected, one is late.
    new = [JAN | {"tip_amount": 9.0}, JAN | {"VendorID": 5}, FEB | february]
    source = bronze(spark, *new)
    months = touched_months(spark, source.filter("_month = 1"), path)
    assert months == [at("2023-12-01"), at("2024-01-01")]
    for _ in range(2):
        rebuild_months(spark, path, source, months)
        assert rows_of(read_fact(spark, path).select(*NO_AUDIT)) == rows_of(
            fact(spark, *new).select(*NO_AUDIT)
        )


def test_upsert_keeps_stored_trips_without_a_month(spark, tmp_path):
    path = str(tmp_path / "fact")
    stored = fact(spark, FEB, JAN).withColumns(
        {name: F.expr(f"if(pickup_month = timestamp_ntz'2024-01-01', NULL, {name})") for name in ("pickup_datetime", "pickup_month")}
    ).select(*FACT.names)
    write_fact(stored, path)
    batch = fact(spark, JAN | {"VendorID": 9}).withColumns(
        {name: F.lit(None).cast("timestamp_ntz") for name in ("pickup_datetime", "pickup_month")}
    ).select(*FACT.names)
    for _ in range(2):
        upsert_fact(spark, path, batch)
        assert sorted(row["vendor_id"] for row in read_fact(spark, path).collect()) == [1, 1, 9]


def test_backfill_names_the_delivery_that_lacks_a_column(spark, tmp_path):
    write_month(tmp_path / "raw", 2024, 1, [raw()])
    path = write_month(tmp_path / "raw", 2024, 2, [raw()])
    import pyarrow.parquet as pq

    pq.write_table(pq.read_table(path).drop_columns(["tip_amount"]), path)
    with pytest.raises(ValueError, match=r"tip_amount.*2024-02"):
        load_landing(spark, str(tmp_path / "bulk"), f"{tmp_path}/raw/yellow/*")
    assert not (tmp_path / "bulk").exists()


def test_backfill_of_drifting_types_equals_month_by_month(spark, tmp_path):
    write_month(tmp_path / "raw", 2024, 1, [raw()], passenger_count=pa.int64())
    write_month(tmp_path / "raw", 2024, 2, [raw(passenger_count=2.5)], passenger_count=pa.float64(), VendorID=pa.int64())
    for month in (1, 2):
        load(spark, tmp_path, month)
    load_landing(spark, str(tmp_path / "bulk"), f"{tmp_path}/raw/yellow/*", ingested_at="2025-02-05 06:00:00")
    assert rows_of(read_bronze(spark, str(tmp_path / "bulk"))) == rows_of(stored(spark, tmp_path))


def test_manifest_comes_from_partitions(spark, tmp_path):
    write_month(tmp_path / "raw", 2024, 3, [raw()])
    load(spark, tmp_path, 3)
    manifest = bronze_manifest(stored(spark, tmp_path))
    assert [row[0] for row in manifest.collect()] == [landing_name(2024, 3)]
    assert "ReadSchema: struct<>" in manifest._jdf.queryExecution().toString()


def test_months_in_a_row_are_one_range(spark):
    months = [at(f"2024-{m:02d}-01") for m in (1, 2, 3, 7, 12)] + [at("2025-01-01")]
    plan = picked_up_in(bronze(spark, JAN), months)._jdf.queryExecution().analyzed().toString()
    assert plan.count(">=") == 3


def test_catalog_tables(spark, tmp_path):
    write_month(tmp_path / "raw", 2024, 1, [raw()])
    load(spark, tmp_path)
    for _ in range(2):
        create_table(spark, "bronze.trips_t", BRONZE, str(tmp_path / "bronze"), BRONZE_PARTITIONS)
    assert spark.table("bronze.trips_t").columns == BRONZE.names
    assert spark.sql("SELECT count(*) FROM bronze.trips_t WHERE _year = 2024").first()[0] == 1
