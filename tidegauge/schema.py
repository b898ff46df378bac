"""Declared shape of a readings table.

Storage keeps the reading time as an ISO-8601 string; every operator works on
``event_time``, the same instant as a UTC wall-clock ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import types as T

PARTITION_KEYS = ("year", "month", "day")

LOCATION = T.StructType(
    [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
)

# Column names and types of the stored readings.
STORED_FIELDS = [
    T.StructField("device_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("location", LOCATION),
    T.StructField("battery", T.IntegerType()),
]

# The keys are declared as strings: inferred ones become integers and "08" turns into 8.
PARTITION_FIELDS = [T.StructField(k, T.StringType()) for k in PARTITION_KEYS]

STORED_SCHEMA = T.StructType(STORED_FIELDS)
TABLE_SCHEMA = T.StructType(STORED_FIELDS + PARTITION_FIELDS)

MEASURES = ("temperature", "humidity", "pressure")
