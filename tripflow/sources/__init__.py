from tripflow.sources.landing import audit_landing, landing_path, read_landing, scan_month
from tripflow.sources.seeds import read_zone_seed
from tripflow.sources.tables import bronze_view, read_bronze, read_bronze_month, read_fact

__all__ = [
    "audit_landing",
    "bronze_view",
    "landing_path",
    "read_bronze",
    "read_bronze_month",
    "read_fact",
    "read_landing",
    "read_zone_seed",
    "scan_month",
]
