"""Facts that are deduplicated, merged and dealt with the one exchange that also places them for the write."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from tests.test_published import no_audit, trips
from tests.trips import bronze
from tripflow.operators.fact import fact_trips, packed, unpacked
from tripflow.operators.merge import delete_insert, delete_insert_facts
from tripflow.operators.silver import DEDUP_KEY, hot_keys, rename_trips, silver_trips
from tripflow.sinks import bucketed


def exchanges(frame) -> int:
    text = plan(frame)
    return text[: text.index("(1)")].count("Exchange")


def test_a_key_with_very_many_copies_is_cut_before_the_exchange(spark):
    rows = bronze(spark, *trips(1, 0, 20))
    copies = rows.limit(1).join(spark.range(3000)).withColumn("tip_amount", F.col("id") % 7 + 0.5).drop("id")
    rows = rows.unionByName(copies)
    assert len(hot_keys(rename_trips(rows), DEDUP_KEY)) == 1
    wanted = no_audit(fact_trips(silver_trips(rows)))
    assert no_audit(fact_trips(silver_trips(rows, by_time=True))) == wanted
    assert no_audit(fact_trips(silver_trips(rows, buckets=3))) == wanted


def test_facts_are_placed_and_merged_with_one_exchange(spark, tmp_path):
    one, two = (str(tmp_path / name) for name in ("one", "two"))
    bronze(spark, *trips(1, 0, 30)).write.parquet(one)
    rows = spark.read.parquet(one)
    assert exchanges(fact_trips(silver_trips(rows, by_time=True))) == 1
    fact_trips(silver_trips(rows)).write.parquet(two)
    stored = spark.read.parquet(two)
    assert exchanges(delete_insert_facts(stored, stored)) == 1


def test_merge_equals_delete_and_insert(spark):
    stored = fact_trips(silver_trips(bronze(spark, *trips(1, 0, 30), *trips(2, 0, 30))))
    nameless = stored.limit(2).withColumn("trip_id", F.lit(None).cast("string"))
    stored = stored.unionByName(nameless)
    batch = fact_trips(silver_trips(bronze(spark, *trips(1, 5, 3, tip_amount=9.0), *trips(3, 0, 2))))
    batch = batch.unionByName(batch.limit(1)).unionByName(nameless)  # a key twice, and none at all
    assert no_audit(delete_insert_facts(stored, batch)) == no_audit(delete_insert(stored, batch, ["trip_id"]))


def test_what_others_do_not_give_survives_packing(spark):
    fact = fact_trips(silver_trips(bronze(spark, *trips(1, 0, 5))))
    odd = fact.withColumn("fare_per_mile", F.lit(None).cast("double")).withColumn("trip_id", F.lit("x"))
    rows = fact.unionByName(odd)
    assert no_audit(unpacked(packed(rows))) == no_audit(rows)
    assert packed(rows).filter("trip_id IS NULL").count() == fact.count()


def test_an_upsert_deals_to_more_buckets_before_they_outgrow_memory(spark, monkeypatch):
    name = "gold_t.fact_by_key"
    stored = fact_trips(silver_trips(bronze(spark, *trips(1, 0, 30))))
    batch = fact_trips(silver_trips(bronze(spark, *trips(1, 5, 3, tip_amount=9.0))))
    bucketed.write_bucketed(stored, name, 2)
    monkeypatch.setattr(bucketed, "buckets_of", lambda rows: rows // 6)
    try:
        bucketed.upsert_bucketed(spark, name, batch)
        assert bucketed.bucket_count(spark, bucketed.current(spark, name)) == 5
        assert no_audit(bucketed.read_bucketed(spark, name)) == no_audit(delete_insert(stored, batch, ["trip_id"]))
    finally:
        for each in bucketed.versions(spark, name):
            spark.sql(f"DROP TABLE {each}")
        spark.sql(f"DROP VIEW {name}")


@pytest.mark.parametrize("rows, buckets", [(0, 8), (36_000_000, 18), (216_000_000, 103)])
def test_buckets_follow_the_rows(rows, buckets):
    assert bucketed.buckets_of(rows) == buckets
