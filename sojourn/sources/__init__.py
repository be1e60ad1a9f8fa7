from .scans import days_between, endpoint_events, point_events, range_predicate, scan_range
from .tables import events_in_range, read_table

__all__ = ["days_between", "endpoint_events", "events_in_range", "point_events", "range_predicate",
           "read_table", "scan_range"]
