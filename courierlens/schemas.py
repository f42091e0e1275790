"""Declared schemas of the star. Every integer is a long, every measure a double."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "string": StringType(),
    "long": LongType(),
    "double": DoubleType(),
    "timestamp": TimestampNTZType(),
}


def _schema(columns: str, ids: str) -> StructType:
    """Parse ``name:type`` words; ``id`` stands for the key type in use."""
    fields = []
    for word in columns.split():
        name, kind = word.split(":")
        fields.append(StructField(name, _TYPES[ids if kind == "id" else kind]))
    return StructType(fields)


_ORDERS = """
    order_id:id customer_id:id captain_id:id restaurant_id:id district:string
    order_time:timestamp delivery_time_min:long prep_time_min:long weather:string
    traffic_level:string order_value_sar:double status:string hour_of_day:long
    day_of_week:string is_peak_hour:long is_delayed:long
"""
_CAPTAINS = """
    captain_id:id name:string rating:double avg_speed_kmh:long active_hours:long
    district:string total_deliveries:long on_time_rate:double
"""
_RESTAURANTS = """
    restaurant_id:id name:string cuisine_type:string avg_prep_time_min:long
    rating:double district:string total_orders:long
"""

FACT_ORDERS = "fact_orders"
DIM_CAPTAINS = "dim_captains"
DIM_RESTAURANTS = "dim_restaurants"

# raw landing-zone folder of each table
ENTITIES = {FACT_ORDERS: "orders", DIM_CAPTAINS: "captains", DIM_RESTAURANTS: "restaurants"}


def star_schemas(ids: str = "string") -> dict[str, StructType]:
    """Schemas of the three tables with text ids (``string``) or numeric ids (``long``)."""
    return {
        FACT_ORDERS: _schema(_ORDERS, ids),
        DIM_CAPTAINS: _schema(_CAPTAINS, ids),
        DIM_RESTAURANTS: _schema(_RESTAURANTS, ids),
    }


TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
STATUSES = ["delivered", "delayed", "cancelled"]
