from tripflow.operators.dimensions import calendar, date_spine, dim_datetime, dim_zones, stg_zones
from tripflow.operators.fact import fact_trips, later_than
from tripflow.operators.merge import delete_insert
from tripflow.operators.sample import sample_rows
from tripflow.operators.silver import keep_latest, rename_trips, silver_trips, valid_trips

__all__ = [
    "calendar",
    "date_spine",
    "delete_insert",
    "dim_datetime",
    "dim_zones",
    "fact_trips",
    "keep_latest",
    "later_than",
    "rename_trips",
    "sample_rows",
    "silver_trips",
    "stg_zones",
    "valid_trips",
]
