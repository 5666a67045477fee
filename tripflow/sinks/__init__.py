from tripflow.sinks.bronze import LoadStats, load_landing, load_month, reconcile
from tripflow.sinks.fact import append_new_trips, rebuild_months, touched_months, upsert_fact, write_fact
from tripflow.sinks.tables import create_table, overwrite_table, replace_partitions

__all__ = [
    "LoadStats",
    "append_new_trips",
    "create_table",
    "load_landing",
    "load_month",
    "overwrite_table",
    "rebuild_months",
    "reconcile",
    "replace_partitions",
    "touched_months",
    "upsert_fact",
    "write_fact",
]
