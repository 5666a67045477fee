from __future__ import annotations

from datetime import timedelta

import pytest

from tests.test_dimensions import SEED
from tests.trips import at, raw, write_month
from tripflow.contracts import AUDIT
from tripflow.operators.quality import QualityError
from tripflow.plans.month import Layout, check_bronze, register_tables, run_month
from tripflow.plans.star import fact_from_bronze
from tripflow.sources.tables import bronze_view, read_bronze, read_fact


def month_of(start: str, n: int = 1200, **values) -> list[dict]:
    first = at(start)
    return [
        raw(
            VendorID=i % 2 + 1,
            tpep_pickup_datetime=first + timedelta(minutes=i),
            tpep_dropoff_datetime=first + timedelta(minutes=i + 12),
            PULocationID=4,
            DOLocationID=132,
            **values,
        )
        for i in range(n)
    ]


@pytest.fixture
def layout(tmp_path):
    csv = tmp_path / "zones.csv"
    csv.write_text(SEED)
    return Layout(root=str(tmp_path / "lake"), landing=str(tmp_path / "raw"), zone_csv=str(csv))


def facts(frame):
    return sorted(map(str, frame.drop(AUDIT).collect()))


def test_two_months_then_a_corrected_one(spark, layout):
    write_month(layout.landing, 2024, 1, month_of("2024-01-05"))
    write_month(layout.landing, 2024, 2, month_of("2024-02-05"))
    for month in (1, 2):
        stats = run_month(spark, layout, 2024, month, ingested_at=f"2025-0{month}-05 06:00:00")
        assert stats.reconciled and stats.output_count == 1200
    assert read_fact(spark, layout.fact).count() == 2400
    write_month(layout.landing, 2024, 1, month_of("2024-01-05", 1300, tip_amount=1.0))
    run_month(spark, layout, 2024, 1, ingested_at="2025-03-05 06:00:00")
    assert read_fact(spark, layout.fact).count() == 2400  # behind the mark
    run_month(
        spark, layout, 2024, 1, mode="rebuild", scope="month", ingested_at="2025-04-05 06:00:00"
    )
    bronze = read_bronze(spark, layout.bronze)
    assert facts(read_fact(spark, layout.fact)) == facts(fact_from_bronze(bronze))
    assert read_fact(spark, layout.fact).filter("tip_amount = 1").count() == 1300
    register_tables(spark, layout)
    assert spark.table("gold.fact_trips").count() == 2500
    assert spark.table("gold.dim_datetime").count() == 96_432
    assert spark.sql("SELECT count(*) FROM silver_trips").first()[0] == 2500
    assert spark.table("silver_zones").count() == 6
    assert bronze_view(spark, layout.bronze, "b").filter("_month = 2").count() == 1200


def test_a_failed_gate_stops_the_transforms(spark, layout):
    write_month(layout.landing, 2024, 1, month_of("2024-01-05", 1200, fare_amount=900.0))
    with pytest.raises(QualityError, match="fare_amount"):
        run_month(spark, layout, 2024, 1)
    assert read_bronze(spark, layout.bronze).count() == 1200
    assert read_fact(spark, layout.fact).count() == 0


def test_orphan_zone_fails_the_model_tests(spark, layout):
    write_month(layout.landing, 2024, 1, [*month_of("2024-01-05"), raw(PULocationID=999)])
    with pytest.raises(QualityError, match="relationships.*pickup_location_id"):
        run_month(spark, layout, 2024, 1)


@pytest.mark.parametrize("scope", ["month", "table"])
@pytest.mark.parametrize("mode", ["append", "rebuild"])
def test_gold_takes_only_months_that_passed(spark, layout, mode, scope):
    write_month(layout.landing, 2024, 1, month_of("2024-01-05"))
    write_month(layout.landing, 2024, 2, month_of("2024-02-05", fare_amount=900.0))
    write_month(layout.landing, 2024, 3, month_of("2024-03-05"))
    run = lambda month, mode: run_month(spark, layout, 2024, month, mode=mode, scope=scope)
    run(1, mode)
    with pytest.raises(QualityError, match="fare_amount"):
        run(2, mode)
    run(3, mode)
    months = lambda: [row[0].month for row in read_fact(spark, layout.fact).select("pickup_month").distinct().sort("pickup_month").collect()]
    assert months() == [1, 3]
    write_month(layout.landing, 2024, 2, month_of("2024-02-05"))
    run(2, "rebuild")
    assert months() == [1, 2, 3]
    assert facts(read_fact(spark, layout.fact)) == facts(fact_from_bronze(read_bronze(spark, layout.bronze)))


def test_an_empty_delivery_withdraws_its_month(spark, layout):
    for month in (1, 2):
        write_month(layout.landing, 2024, month, month_of(f"2024-0{month}-05"))
        run_month(spark, layout, 2024, month)
    write_month(layout.landing, 2024, 1, [])
    run_month(spark, layout, 2024, 1, mode="rebuild")
    assert [row[0].month for row in read_fact(spark, layout.fact).select("pickup_month").distinct().collect()] == [2]


def test_checks_count_all_rows(spark, layout):
    write_month(layout.landing, 2024, 1, month_of("2024-01-05", 3000))
    run_month(spark, layout, 2024, 1)
    for bound, success in ((3000, True), (2999, False)):
        rows = check_bronze(read_bronze(spark, layout.bronze), bound).collect()
        counted = {r["check"]: r for r in rows}["row_count"]
        assert (counted["evaluated"], counted["success"]) == (3000, success)
    with pytest.raises(ValueError):
        run_month(spark, layout, 2024, 1, mode="other")
