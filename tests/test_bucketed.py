from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from tests.test_published import no_audit, trips
from tests.trips import bronze
from tripflow.operators.fact import fact_trips
from tripflow.operators.merge import delete_insert
from tripflow.operators.silver import silver_trips
from tripflow.sinks import bucketed

NAME = "gold_b.fact_by_key"


def fact(spark, *rows):
    return fact_trips(silver_trips(bronze(spark, *rows)))


@pytest.fixture
def stored(spark):
    rows = fact(spark, *trips(1, 0, 30), *trips(2, 0, 30))
    bucketed.write_bucketed(rows, NAME, 4)
    yield rows
    for each in bucketed.versions(spark, NAME):
        spark.sql(f"DROP TABLE {each}")
    spark.sql(f"DROP VIEW {NAME}")


def test_upsert_equals_delete_and_insert(spark, stored):
    assert no_audit(bucketed.read_bucketed(spark, NAME)) == no_audit(stored)
    batch = fact(spark, *trips(1, 5, 3, tip_amount=9.0), *trips(3, 0, 2))
    wanted = no_audit(delete_insert(stored, batch, ["trip_id"]))
    for number in (2, 3):
        bucketed.upsert_bucketed(spark, NAME, batch)
        assert no_audit(bucketed.read_bucketed(spark, NAME)) == wanted
        assert bucketed.current(spark, NAME) == f"{NAME}_v{number}"
    assert bucketed.drop_old(spark, NAME) == [f"{NAME}_v1", f"{NAME}_v2"]
    assert no_audit(bucketed.read_bucketed(spark, NAME)) == wanted
    assert bucketed.repeated_keys(spark, NAME).count() == 0


def test_the_stored_side_is_not_exchanged(spark, stored):
    """Of the joins an upsert needs only the batch is; deduplication needs none at all."""
    batch = fact(spark, *trips(1, 5, 3))
    text = plan(bucketed.merged(spark, NAME, batch))
    tree = text[: text.index("(1)")]
    stored_side = tree[: tree.index("BatchScan")] if "BatchScan" in tree else tree
    lines = tree.splitlines()
    scan = next(k for k, line in enumerate(lines) if "Scan parquet" in line and "fact_by_key_v" in line)
    join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    assert join < scan and not any("Exchange" in line for line in lines[join + 1 : scan + 1]), stored_side
    counted = plan(bucketed.repeated_keys(spark, NAME))
    assert "Exchange" not in counted[: counted.index("(1)")] and "Bucketed: true" in counted


def test_a_lost_job_leaves_the_version_shown(spark, stored):
    spark.table(f"{NAME}_v1").filter("vendor_id = 1").write.saveAsTable(f"{NAME}_v2")  # written, never shown
    assert no_audit(bucketed.read_bucketed(spark, NAME)) == no_audit(stored)
    bucketed.upsert_bucketed(spark, NAME, fact(spark, *trips(1, 0, 1, tip_amount=7.0)))
    rows = bucketed.read_bucketed(spark, NAME)
    assert rows.count() == 60 and rows.filter(F.col("tip_amount") == 7.0).count() == 1


def test_buckets_follow_the_size():
    assert [bucketed.buckets_for(size) for size in (0, 9 << 30, 100 << 40)] == [8, 9, 102_400]
