"""Explicit schemas of the raw feeds and of the clean layers.

Raw files are read with these schemas instead of inference: CSV columns all
stay strings (dirt is kept for the silver stage), and JSON inference would
reorder columns and add ``_corrupt_record`` for a broken line.
"""

from pyspark.sql import types as T

RAW_SHIPMENT_COLUMNS = (
    "tracking_id", "pickup_raw", "delivery_raw", "city", "zip",
    "weight_raw", "status", "courier_id", "client_type", "amount_raw",
)
RAW_COURIER_COLUMNS = (
    "courier_id", "first_name", "last_name", "hire_date",
    "contract", "assigned_city", "vehicle", "phone",
)
AUDIT_COLUMNS = ("ingestion_timestamp", "source_file", "source_system")


def text_schema(names) -> T.StructType:
    """Every column a nullable string."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in names])


RAW_SHIPMENTS = text_schema(RAW_SHIPMENT_COLUMNS)
RAW_COURIERS = text_schema(RAW_COURIER_COLUMNS)

# Column order of the clean, enriched shipment table (without the two audit columns).
SILVER_SHIPMENT_COLUMNS = (
    "tracking_id", "courier_id", "pickup", "delivery", "city", "zip", "weight", "status",
    "client_type", "amount", "courier_first_name", "courier_last_name", "contract",
    "assigned_city", "vehicle", "transit_hours", "on_time",
)
SILVER_AUDIT_COLUMNS = ("bronze_ingestion_ts", "silver_processed_ts")

# Courier attributes carried into the shipment table by the enrichment join.
COURIER_DIMENSION = {
    "courier_id": "courier_id",
    "first_name": "courier_first_name",
    "last_name": "courier_last_name",
    "contract": "contract",
    "assigned_city": "assigned_city",
    "vehicle": "vehicle",
}
COURIER_KEYS = tuple(COURIER_DIMENSION.values())
