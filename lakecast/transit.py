"""The transit-ridership data set: columns, accepted values and code labels.

Fixed values: names, bounds and labels below must equal the published data set's.
The station list is no constant; pass it as a table (see ``operators.encoding``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakecast.operators.quality import Rule

REQUIRED_COLUMNS = (
    "transit_timestamp",
    "transit_mode",
    "station_complex_id",
    "station_complex",
    "borough",
    "payment_method",
    "fare_class_category",
    "ridership",
    "transfers",
    "latitude",
    "longitude",
    "georeference",
)

_GEOREFERENCE = T.StructType(
    [
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
        T.StructField("type", T.StringType()),
    ]
)


def _fact(time_type: T.DataType, measure_type: T.DataType) -> T.StructType:
    measures = ("ridership", "transfers", "latitude", "longitude")
    fields = []
    for name in REQUIRED_COLUMNS:
        if name == "transit_timestamp":
            fields.append(T.StructField(name, time_type))
        elif name == "georeference":
            fields.append(T.StructField(name, _GEOREFERENCE))
        else:
            fields.append(
                T.StructField(name, measure_type if name in measures else T.StringType())
            )
    return T.StructType(fields)


# As landed in Parquet: epoch nanoseconds and text measures.
RAW_SCHEMA = _fact(T.LongType(), T.StringType())
# As landed in JSON: ISO text.
JSON_SCHEMA = _fact(T.StringType(), T.StringType())
# As landed in the month lake: a timestamp, text measures.
LAKE_SCHEMA = _fact(T.TimestampType(), T.StringType())
# Validated fact.
SILVER_SCHEMA = _fact(T.TimestampType(), T.FloatType())

# Columns of a new-row check in the curated table.
GOLD_KEYS = ("transit_timestamp", "station_complex_id", "payment_method")

MODES = ("subway", "tram", "staten_island_railway")
BOROUGHS = ("Brooklyn", "Manhattan", "Bronx", "Queens", "Staten Island")
PAYMENTS = ("metrocard", "omny")
FARE_CLASSES = (
    "Metrocard - Fair Fare",
    "OMNY - Seniors & Disability",
    "Metrocard - Seniors & Disability",
    "Metrocard - Full Fare",
    "OMNY - Other",
    "OMNY - Full Fare",
    "Metrocard - Unlimited 7-Day",
    "Metrocard - Unlimited 30-Day",
    "Metrocard - Students",
    "Metrocard - Other",
    "OMNY - Students",
    "OMNY - Fair Fare",
)
RANGES = {
    "ridership": (1.0, 16217.0),
    "transfers": (0.0, 1450.0),
    "latitude": (40.576126, 40.903126),
    "longitude": (-74.07484, -73.7554),
}
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

# Published codes of the small label columns.
CODE_LABELS = {
    "payment_method": {1: "metrocard", 2: "omny"},
    "transit_mode": {1: "staten_island_railway", 2: "subway", 3: "tram"},
    "borough": {1: "Bronx", 2: "Brooklyn", 3: "Manhattan", 4: "Queens", 5: "Staten Island"},
}

LABEL_COLUMNS = ("transit_mode", "station_complex", "borough", "payment_method")


def rules(allowed_stations: DataFrame) -> list[Rule]:
    """The data set's rules; ``allowed_stations`` holds station_complex_id and station_complex."""
    return [
        *(Rule.exists(c) for c in REQUIRED_COLUMNS),
        Rule.regex("transit_timestamp", TIMESTAMP_SHAPE),
        Rule.in_set("transit_mode", MODES),
        Rule.in_table("station_complex_id", allowed_stations, "station_complex_id"),
        Rule.in_table("station_complex", allowed_stations, "station_complex"),
        Rule.in_set("borough", BOROUGHS),
        Rule.in_set("payment_method", PAYMENTS),
        Rule.in_set("fare_class_category", FARE_CLASSES),
        *(Rule.between(c, low, high) for c, (low, high) in RANGES.items()),
    ]
