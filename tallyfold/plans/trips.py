"""Trip records: de-duplicate, keep one month, attach zone centroids for both ends of a trip."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyfold.functions.scalars import rename
from tallyfold.operators.rowsets import between_half_open, dedup, join_roles
from tallyfold.operators.shapes import polygon_centroid

# Column names of the trip records.
RENAMES = {"VendorID": "vendor_id", "RatecodeID": "rate_code_id", "PULocationID": "pick_up_location_id",
           "DOLocationID": "drop_off_location_id", "Airport_fee": "airport_fee"}
ROLES = {"pick_up_location_id": {"geometry_x": "pick_up_x", "geometry_y": "pick_up_y"},
         "drop_off_location_id": {"geometry_x": "drop_off_x", "geometry_y": "drop_off_y"}}


def prepare_trips(trips: DataFrame, zones: DataFrame, start: str, end: str, ts: str = "tpep_pickup_datetime",
                  ring: str = "ring", zone_key: str = "OBJECTID") -> DataFrame:
    """Filter first (it reaches the scan), then remove copies, then join the zones once per role."""
    kept = dedup(between_half_open(rename(trips, RENAMES), ts, start, end))
    return join_roles(kept, polygon_centroid(zones, ring), zone_key, ROLES)
